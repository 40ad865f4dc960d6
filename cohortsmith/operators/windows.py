"""Analysis visits, extreme-record flags, baselines and carried-forward values.

A "group" here is usually subject x parameter and may be of any size. Every
operator therefore aggregates first and joins one row per group back; window
functions are used only over rows already reduced to one per visit, whose number
is set by the protocol.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .groups import extreme_rows, keyed_join, order_key

SUBJECT = ("USUBJID",)
PARAM = ("USUBJID", "PARAMCD")


@dataclass(frozen=True)
class Visit:
    """A scheduled analysis visit and its target study day."""

    label: str
    number: int
    target: int


def visit_table(spark, visits: Sequence[Visit]) -> DataFrame:
    """The visit schedule as a table, one row per visit."""
    return spark.createDataFrame(
        [(v.label, v.number, v.target) for v in visits], "AVISIT string, AVISITN int, ATARGDY int"
    )


def flag_extreme(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], new_var: str, mode: str = "last",
                 where: str | Column | None = None) -> DataFrame:
    """"Y" on the first or last record per group, null elsewhere and on records outside ``where``.

    ``order`` must identify a record within its group.
    """
    ok = F.lit(True) if where is None else (F.expr(where) if isinstance(where, str) else where)
    ok = F.coalesce(ok, F.lit(False))
    key = order_key(order)
    pick = F.min if mode == "first" else F.max
    marks = df.filter(ok).groupBy(*by).agg(pick(key).alias("__mark"))
    return keyed_join(df.drop(new_var), marks, by).withColumn(
        new_var, F.when(ok & (key == F.col("__mark")), F.lit("Y"))
    ).drop("__mark")


def flag_baseline(df: DataFrame, by: Sequence[str] = PARAM, date: str = "ADT", seq: str = "ASEQ",
                  ref: str = "TRTSDT") -> DataFrame:
    """ABLFL on the last valued record at or before the reference date."""
    ok = (F.col(date) <= F.col(ref)) & F.col("AVAL").isNotNull()
    return flag_extreme(df, by, [date, seq], "ABLFL", "last", ok)


def derive_base(df: DataFrame, by: Sequence[str] = PARAM, flag: str = "ABLFL", **columns: str) -> DataFrame:
    """Spread values of the flagged record over its group; ``columns`` maps new name to source."""
    columns = columns or {"BASE": "AVAL"}
    facts = df.filter(F.col(flag) == "Y").groupBy(*by).agg(
        *[F.max(F.col(src)).alias(new) for new, src in columns.items()]
    )
    return keyed_join(df.drop(*columns), facts, by)


def baseline(df: DataFrame, by: Sequence[str] = PARAM, date: str = "ADT", seq: str = "ASEQ",
             ref: str = "TRTSDT") -> DataFrame:
    """ABLFL, BASE and CHG in one pass: one aggregate, one join."""
    ok = F.coalesce((F.col(date) <= F.col(ref)) & F.col("AVAL").isNotNull(), F.lit(False))
    key = order_key([date, seq])
    facts = df.filter(ok).groupBy(*by).agg(F.max(key).alias("__mark"), F.max_by("AVAL", key).alias("BASE"))
    return (
        keyed_join(df.drop("BASE"), facts, by)
        .withColumn("ABLFL", F.when(ok & (key == F.col("__mark")), F.lit("Y")))
        .withColumn("CHG", F.col("AVAL") - F.col("BASE"))
        .drop("__mark")
    )


def window_visits(df: DataFrame, visits: Sequence[Visit], baseline_upper: int | None = 1, day: str = "ADY") -> DataFrame:
    """AVISIT, AVISITN and ATARGDY by study day; bounds lie midway between adjacent targets.

    A day on a bound goes to the earlier visit. ``baseline_upper`` closes the first
    visit early (None: use the midpoint). Only records without a day or value are
    dropped; the nominal visit never matters.
    """
    visits = sorted(visits, key=lambda v: v.target)
    d = F.col(day)
    label = number = target = None
    for i, v in enumerate(visits):
        last = i == len(visits) - 1
        bound = None if last else (v.target + visits[i + 1].target) / 2
        if i == 0 and baseline_upper is not None and not last:
            bound = baseline_upper
        vals = F.lit(v.label), F.lit(v.number), F.lit(v.target)
        if label is None:
            label, number, target = [F.when(F.lit(True) if last else d <= bound, x) for x in vals]
        elif last:
            label, number, target = [w.otherwise(x) for w, x in zip((label, number, target), vals)]
        else:
            label, number, target = [w.when(d <= bound, x) for w, x in zip((label, number, target), vals)]
    return df.filter(d.isNotNull() & F.col("AVAL").isNotNull()).withColumns(
        {"AVISIT": label, "AVISITN": number, "ATARGDY": target}
    )


def _nearest(day: str, seq: str) -> list[Column]:
    return [F.abs(F.col(day) - F.col("ATARGDY")), -F.col(day), F.col(seq)]


def pick_analysis_record(df: DataFrame, by: Sequence[str] = PARAM, day: str = "ADY", seq: str = "ASEQ") -> DataFrame:
    """ANL01FL on the record nearest to target per visit; ties go to the later day, then the lower sequence."""
    return flag_extreme(df, [*by, "AVISITN"], _nearest(day, seq), "ANL01FL", "first")


def analysis_records(df: DataFrame, by: Sequence[str] = PARAM, day: str = "ADY", seq: str = "ASEQ",
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Only the records ``pick_analysis_record`` would flag, without joining back to the rest."""
    return extreme_rows(df, [*by, "AVISITN"], _nearest(day, seq), "first", keep=keep or df.columns).withColumn(
        "ANL01FL", F.lit("Y")
    )


def locf_endpoint(df: DataFrame, endpoint: Visit, require_baseline: bool = True, by: Sequence[str] = PARAM,
                  first_post: int = 0) -> DataFrame:
    """Add a carried-forward record at the endpoint visit where none was observed.

    ``df`` holds records with ANL01FL, AVISITN, AVAL and BASE. For each group without
    an endpoint record, its last primary post-baseline record before that visit is
    copied with DTYPE LOCF and CHG computed anew; later visits are never carried back.
    """
    primary = F.col("ANL01FL") == "Y"
    source = primary & (F.col("AVISITN") > first_post) & (F.col("AVISITN") < endpoint.number)
    if require_baseline:
        source = source & F.col("BASE").isNotNull()
    # one aggregate finds the last source record and whether the endpoint was observed (with a baseline or not); the records then meet it once
    key = order_key(["AVISITN", "ADY", "ASEQ"])
    facts = df.groupBy(*by).agg(F.max(F.when(source, key)).alias("__last"), F.max(F.coalesce(primary & (F.col("AVISITN") == endpoint.number), F.lit(False))).alias("__seen"))
    out = df if "DTYPE" in df.columns else df.withColumn("DTYPE", F.lit(None).cast("string"))
    out = out if "CHG" in df.columns else out.withColumn("CHG", F.lit(None).cast("double"))
    marked = keyed_join(out, facts.filter("__last IS NOT NULL AND NOT __seen").drop("__seen"), by)
    changed = {"AVISIT": F.lit(endpoint.label), "AVISITN": F.lit(endpoint.number), "ATARGDY": F.lit(endpoint.target), "DTYPE": F.lit("LOCF"),
               "ANL01FL": F.lit("Y"), "CHG": F.col("AVAL") - F.col("BASE")}
    for name in changed:
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None))
    row = F.struct(*[F.col(c) for c in out.columns])
    copy = F.struct(*[changed[c].cast(out.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in out.columns])
    carries = source & (key == F.col("__last"))
    return marked.select(F.explode(F.when(carries, F.array(row, copy)).otherwise(F.array(row))).alias("__r")).select("__r.*")


def _visit_grid(df: DataFrame, visits: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per group and scheduled visit, with the values of the observed record if any.

    Spark puts the schedule next to the group list by its measured size.
    """
    groups = df.select(*by).distinct()
    grid = groups.crossJoin(visits)
    obs = df.select(*by, "AVISITN", *values, F.lit(True).alias("__seen"))
    return keyed_join(grid, obs, [*by, "AVISITN"])


def locf_all_visits(df: DataFrame, visits: DataFrame, by: Sequence[str] = PARAM,
                    values: Sequence[str] = ("AVAL",)) -> DataFrame:
    """Carry the last observed value to every later scheduled visit without one.

    ``df`` has at most one record per group and visit, so the running window spans
    no more rows than the schedule has visits.
    """
    grid = _visit_grid(df, visits, by, values)
    run = W.partitionBy(*by).orderBy("AVISITN").rowsBetween(W.unboundedPreceding, 0)
    row = F.last(F.when(F.col("__seen"), F.struct(*values)), ignorenulls=True).over(run)
    return (
        grid.withColumn("__row", row)
        .filter(F.col("__row").isNotNull())
        .withColumn("DTYPE", F.when(F.col("__seen").isNull(), F.lit("LOCF")))
        .withColumns({v: F.col(f"__row.{v}") for v in values})
        .drop("__row", "__seen")
    )


def wocf(df: DataFrame, visits: DataFrame, worst: str = "max", by: Sequence[str] = PARAM) -> DataFrame:
    """Carry the worst value so far to every later scheduled visit without one; ``worst`` is max or min."""
    grid = _visit_grid(df, visits, by, ["AVAL"])
    run = W.partitionBy(*by).orderBy("AVISITN").rowsBetween(W.unboundedPreceding, 0)
    extreme = F.max if worst == "max" else F.min
    return (
        grid.withColumn("__worst", extreme("AVAL").over(run))
        .withColumn("DTYPE", F.when(F.col("__seen").isNull(), F.lit("WOCF")))
        .withColumn("AVAL", F.coalesce(F.col("AVAL"), F.col("__worst")))
        .filter(F.col("AVAL").isNotNull())
        .drop("__worst", "__seen")
    )


OCCURRENCE_LEVELS = {
    "AOCCFL": ("USUBJID", "AESOC"),
    "AOCCSFL": ("USUBJID", "AESOC", "AEDECOD"),
    "AOCCPFL": ("USUBJID", "AEDECOD"),
}


def flag_first_occurrence(df: DataFrame, levels: dict[str, Sequence[str]] | None = None,
                          where: str = "TRTEMFL = 'Y'", order: Sequence[str] = ("ASTDT", "AESEQ")) -> DataFrame:
    """First-occurrence flags per level on the records meeting ``where``; undated records come last.

    All levels nest, so the finest is aggregated from the records and the others
    from it; the first record of a level is the least key below it.
    """
    levels = levels or OCCURRENCE_LEVELS
    ok = F.coalesce(F.expr(where), F.lit(False))
    lead = F.col(order[0])
    key = order_key([lead.isNull(), *order])
    finest = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    marks = df.filter(ok).groupBy(*finest).agg(F.min(key).alias("__first"))
    # the first of every level is put on the finest table, which has one row per distinct key, and the records meet that table once
    firsts = {name: "__first" if list(cols) == finest else f"__{name}" for name, cols in levels.items()}
    marks = marks.withColumns({firsts[name]: F.min("__first").over(W.partitionBy(*cols)) for name, cols in levels.items() if firsts[name] != "__first"})
    out = keyed_join(df, marks, finest)
    return out.withColumns({name: F.when(ok & (key == F.col(c)), F.lit("Y")) for name, c in firsts.items()}).drop("__first", *firsts.values())


def change_from_previous(df: DataFrame, by: Sequence[str] = PARAM) -> DataFrame:
    """PREV and CHGPREV against the previous scheduled visit with a record.

    Expects one record per group and visit, which bounds the window by the schedule.
    """
    w = W.partitionBy(*by).orderBy("AVISITN")
    return df.withColumn("PREV", F.lag("AVAL").over(w)).withColumn("CHGPREV", F.col("AVAL") - F.col("PREV"))


def max_severity(df: DataFrame, by: Sequence[str] = SUBJECT, severity: str = "AESEVN") -> DataFrame:
    """Greatest severity per group."""
    return df.groupBy(*by).agg(F.max(severity).alias(severity))


def duplicate_primary(df: DataFrame, by: Sequence[str] = (*PARAM, "AVISITN")) -> DataFrame:
    """Groups with more than one primary record."""
    return df.filter(F.col("ANL01FL") == "Y").groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def flag_eot(df: DataFrame, by: Sequence[str] = PARAM, new_var: str = "EOTFL") -> DataFrame:
    """Last valued post-baseline record on treatment."""
    ok = (F.col("ADT") > F.col("TRTSDT")) & (F.col("ADT") <= F.col("TRTEDT")) & F.col("AVAL").isNotNull()
    return flag_extreme(df, by, ["ADT", "ASEQ"], new_var, "last", ok)


def flag_variants(df: DataFrame, completers: str = "COMPLFL") -> DataFrame:
    """ANL02FL on observed primary records, ANL03FL on those of completers."""
    observed = (F.col("ANL01FL") == "Y") & F.col("DTYPE").isNull()
    return df.withColumns({
        "ANL02FL": F.when(observed, F.lit("Y")),
        "ANL03FL": F.when(observed & (F.col(completers) == "Y"), F.lit("Y")),
    })
