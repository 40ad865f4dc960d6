"""Data-quality gates; each returns findings or counts as a table and never raises on bad data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .derive import pool_sites
from .groups import keyed_join
from .merge import without
from .windows import duplicate_primary

FINDING = ["study_id", "check_id", "severity", "subject_key", "message", "related"]


def findings(df: DataFrame, check_id: str, severity: str, message: Column, subject_key: Column | str | None = None,
             related: Column | None = None, study_id: Column | str | None = None) -> DataFrame:
    """Rows of ``df`` as findings in the common schema."""
    col = lambda c: F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")
    return df.select(
        col(study_id).alias("study_id"), F.lit(check_id).alias("check_id"), F.lit(severity).alias("severity"),
        col(subject_key).alias("subject_key"), message.alias("message"),
        (F.array().cast("array<string>") if related is None else related.cast("array<string>")).alias("related"))


def gate_n(adam: DataFrame, adsl: DataFrame, flag: str, where: str, arm: str = "ARM", subject: str = "USUBJID",
           expected: Mapping[str, int] | None = None) -> DataFrame:
    """Per arm: subjects in the analysis set against the population flag, and any expected count.

    Distinct subjects are formed before counting, so a subject with many records
    is one row early on.
    """
    have = adam.filter(where).select(subject, arm).distinct().groupBy(arm).agg(F.count(F.lit(1)).alias("n_analysis"))
    want = adsl.filter(F.col(flag) == "Y").groupBy(arm).agg(F.count(F.lit(1)).alias("n_flag"))
    out = want.join(have, arm, "full_outer").fillna(0, ["n_analysis", "n_flag"])
    if expected is not None:
        spec = adsl.sparkSession.createDataFrame(list(expected.items()), f"{arm} string, n_expected bigint")
        out = out.join(F.broadcast(spec), arm, "left")
        target = F.coalesce("n_expected", "n_flag")
    else:
        target = F.col("n_flag")
    return out.withColumn("shortfall", target - F.col("n_analysis")).withColumn(
        "status", F.when(F.col("shortfall") == 0, "OK").otherwise("FAILED"))


def gate_one_primary(df: DataFrame, endpoint: int, by: Sequence[str] = ("USUBJID", "PARAMCD")) -> DataFrame:
    """A finding per subject and parameter with more than one primary endpoint record."""
    dup = duplicate_primary(df.filter(F.col("AVISITN") == endpoint), by)
    return findings(dup, "one_primary", "error", F.format_string("%d primary records at the endpoint", "n"),
                    F.concat_ws("|", *by))


def gate_dropped(df: DataFrame, endpoint: int, by: Sequence[str] = ("USUBJID", "PARAMCD")) -> DataFrame:
    """A finding per group with baseline and post-baseline records but none at the endpoint."""
    facts = df.filter(F.col("ANL01FL") == "Y").groupBy(*by).agg(
        F.bool_or(F.col("BASE").isNotNull()).alias("b"), F.bool_or(F.col("AVISITN") > 0).alias("p"),
        F.bool_or(F.col("AVISITN") == endpoint).alias("e"))
    lost = facts.filter("b AND p AND NOT e")
    return findings(lost, "dropped_from_endpoint", "error", F.lit("missing from the endpoint analysis"), F.concat_ws("|", *by))


def gate_sites(adsl: DataFrame, arms: Sequence, threshold: int = 3, pooled: str = "900") -> DataFrame:
    """Site group counts as stored against those of the pooling rule worked out anew."""
    stored = adsl.groupBy("SITEGR1").agg(F.count(F.lit(1)).alias("n_stored"))
    fresh = pool_sites(adsl.drop("SITEGR1"), arms, threshold, pooled).groupBy("SITEGR1").agg(F.count(F.lit(1)).alias("n_rule"))
    return stored.join(fresh, "SITEGR1", "full_outer").fillna(0, ["n_stored", "n_rule"]).withColumn(
        "status", F.when(F.col("n_stored") == F.col("n_rule"), "OK").otherwise("FAILED"))


def assert_unique(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys, repeated keys and nulls in required columns, as one row."""
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in not_null])
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("__n") > 1).alias("repeated_keys"),
        *[F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null],
    ).withColumn("status", F.when(
        reduce(lambda a, b: a & b, [F.col("repeated_keys") == 0, *[F.col(f"null_{c}") == 0 for c in not_null]]), "OK").otherwise("FAILED"))


def check_variables(spark, schemas: Mapping[str, Mapping[str, str]] | DataFrame, spec: DataFrame) -> DataFrame:
    """Specified variables absent from the data or of another type, as findings.

    ``schemas`` maps a data set to its column types, or is a table of what is there (dataset, variable, have) for many data
    sets. ``spec`` has dataset, variable, type (integer, float, text or date).
    """
    if isinstance(schemas, DataFrame):
        data = schemas.select("dataset", "variable", "have")
    else:
        rows = [(d, v, _kind(t)) for d, cols in schemas.items() for v, t in cols.items()]
        data = spark.createDataFrame(rows, "dataset string, variable string, have string")
    joined = spec.join(data, ["dataset", "variable"], "left")
    bad = joined.filter(F.col("have").isNull() | (F.col("have") != F.col("type")))
    text = F.when(F.col("have").isNull(), F.lit("required variable is absent")).otherwise(
        F.format_string("type is %s, specified as %s", "have", "type"))
    return findings(bad, "variables", "error", text, F.concat_ws(".", "dataset", "variable"))


def undeclared_qualifiers(supp: DataFrame, qnams: Mapping[str | None, Sequence[str]]) -> DataFrame:
    """Supplemental qualifiers that ``combine_supp`` would leave out, one finding per identifying variable and name."""
    spark = supp.sparkSession
    known = spark.createDataFrame([(v or "", q) for v, names in qnams.items() for q in names], "idvar string, qnam string")
    have = supp.groupBy(F.coalesce("IDVAR", F.lit("")).alias("idvar"), F.col("QNAM").alias("qnam")).agg(F.count(F.lit(1)).alias("n"))
    left = have.join(known, ["idvar", "qnam"], "left_anti")
    return findings(left, "supplemental", "warning", F.format_string("%d records of an undeclared qualifier", "n"), F.concat_ws(".", F.nullif("idvar", F.lit("")), "qnam"))


def column_differences(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Names that one of two tables (``by``, variable) has and the other has not, with the side that has them."""
    key = [*by, "variable"]
    side = lambda df, n: df.select(*key, F.lit(n).alias("side"))
    seen = side(left, 1).unionByName(side(right, 2)).groupBy(*key).agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return seen.filter("lo = hi").select(*key, F.when(F.col("lo") == 1, "left").otherwise("right").alias("only_in"))


def _kind(spark_type: str) -> str:
    if spark_type in ("int", "bigint", "smallint", "tinyint"):
        return "integer"
    if spark_type in ("double", "float") or spark_type.startswith("decimal"):
        return "float"
    return "date" if spark_type == "date" else "text"


def check_ct(df: DataFrame, codelists: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values outside their codelist (variable, value), with the number of records."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "variable", "value")
    seen = long.filter(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(codelists.select("variable", "value"), ["variable", "value"], "left_anti")


def check_labels(df: DataFrame, max_code: int = 8, column: str = "PARAMCD") -> DataFrame:
    """Findings on parameter codes that are too long and columns without a label in their metadata."""
    spark = df.sparkSession
    codes = df.select(column).distinct().filter(F.length(column) > max_code)
    long = findings(codes, "code_length", "error", F.format_string("%s has more than " + str(max_code) + " characters", column), column)
    bare = [(f.name,) for f in df.schema.fields if not (f.metadata or {}).get("label")]
    names = spark.createDataFrame(bare, "name string")
    return long.unionByName(findings(names, "label_missing", "warning", F.lit("variable has no label"), "name"))


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Put labels into the column metadata of the columns that exist."""
    out = df
    for name, label in labels.items():
        if name in df.columns:
            out = out.withMetadata(name, {**(df.schema[name].metadata or {}), "label": label})
    return out


def sanity(df: DataFrame, flags: Sequence[str] = (), arm: str = "ARM", subject: str = "USUBJID", param: str = "PARAMCD") -> DataFrame:
    """Rows, subjects, parameters and arms, and a count per flag, as one row.

    Distinct combinations are counted from a pre-aggregated table, not from the records.
    """
    flag_cols = [F.count_if(F.col(f) == "Y").alias(f"__{f}") for f in flags]
    per = df.groupBy(subject, param, arm).agg(F.count(F.lit(1)).alias("__n"), *flag_cols)
    return per.agg(
        F.sum("__n").alias("rows"), F.count_distinct(F.col(subject)).alias("subjects"),
        F.count_distinct(F.col(param)).alias("params"), F.count_distinct(F.col(arm)).alias("arms"),
        *[F.sum(f"__{f}").alias(f"n_{f}") for f in flags])


def tally_findings(df: DataFrame, by: Sequence[str] = ("study_id",), severity: str = "severity") -> DataFrame:
    """Errors (error, reject, critical in any case) and the rest per group."""
    bad = F.lower(severity).rlike("error|reject|critical")
    return df.groupBy(*by).agg(
        F.count_if(F.coalesce(bad, F.lit(False))).alias("errors"),
        F.count_if(~F.coalesce(bad, F.lit(False))).alias("others"), F.count(F.lit(1)).alias("total"))


def gate_status(tally: DataFrame, attempt: Column | int, cap: int) -> DataFrame:
    """pass with no errors, give-up at the attempt cap, else fail."""
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    return tally.withColumn("gate", F.when(F.col("errors") == 0, "pass").when(attempt >= cap, "give-up").otherwise("fail"))


def required_fields(objects: DataFrame, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Findings on missing required fields.

    ``objects`` has study_id, kind, id and a map ``fields`` of the values present;
    ``rules`` maps a kind to the names it must have.
    """
    spark = objects.sparkSession
    table = spark.createDataFrame([(k, f) for k, fs in rules.items() for f in fs], "kind string, field string")
    joined = objects.join(F.broadcast(table), "kind")
    value = F.try_element_at("fields", F.col("field"))
    bad = joined.filter(value.isNull() | (F.trim(value) == ""))
    return findings(bad, "required_field", "error", F.format_string("%s needs %s", "kind", "field"), "id", study_id="study_id")
