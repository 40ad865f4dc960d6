"""Readers for domains and study metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ..operators.groups import running_sums

FORMATS = ("json", "parquet", "csv")

# Data types of the row-array JSON format and the Spark type of each.
JSON_TYPES = {"string": "string", "integer": "bigint", "decimal": "double", "float": "double", "double": "double",
              "boolean": "boolean", "date": "date", "datetime": "timestamp", "time": "string", "URI": "string"}


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def _tidy(df: DataFrame) -> DataFrame:
    """Upper-case names; empty text becomes null."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c != "", c)
        cols.append(c.alias(f.name.upper(), metadata=f.metadata or {}))
    return df.select(*cols)


def read_domain(spark: SparkSession, folder: str, name: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """One domain by name; the first format found wins, names are upper-cased, empty text is null.

    Parquet may be a folder of many files, so a domain of any size is read by many tasks.
    """
    for fmt in formats:
        for stem in (name.lower(), name.upper()):
            path = f"{folder.rstrip('/')}/{stem}.{fmt}"
            if _exists(spark, path):
                if fmt == "parquet":
                    return _tidy(spark.read.parquet(path))
                if fmt == "csv":
                    return _tidy(spark.read.csv(path, header=True, nullValue="", quote='"', escape='"'))
                return _tidy(read_dataset_json(spark, path))
    raise FileNotFoundError(f"domain {name} not found in {folder} as any of {', '.join(formats)}")


def _json_columns(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """Name, type and label of each column: from the text before the rows, or from the whole document where they come first."""
    head = spark.read.text(path, lineSep='"rows"').limit(1).collect()
    try:
        columns = json.loads((head[0]["value"].rstrip().rstrip(",") if head else "") + "}")["columns"]
    except (ValueError, KeyError):
        schema = "columns array<struct<name:string,dataType:string,label:string>>"
        columns = [c.asDict() for c in spark.read.schema(schema).json(path, multiLine=True).select("columns").first()["columns"]]
    return [(c["name"], JSON_TYPES.get(c.get("dataType"), "string"), c.get("label") or "") for c in columns]


#: A row at the end of a piece: an array of plain values that follows another one or opens an array of arrays.
_ROW = r'(?s)(?:^\s*,|\[)\s*\[((?:[^\[\]{}"]++|"(?:[^"\\]++|\\.)*+")*+)$'


def _json_rows(spark: SparkSession, path: str) -> DataFrame:
    """The row arrays of a document as text (``r``), read by as many tasks as the file has byte ranges.

    The text is cut at every closing bracket, which Spark does on ranges of bytes. A bracket closes an array if the quotes before
    it pair up: each range counts its quotes, the ranges' counts are summed in order, and a running sum within a range does the rest. Pieces that end
    inside a text are joined with those after them, across ranges too; only such pieces meet again in a shuffle of their own.
    """
    meta = F.col("_metadata")
    pieces = spark.read.text(path, lineSep="]").select(
        meta.file_path.alias("__file"), meta.file_block_start.alias("__part"), F.monotonically_increasing_id().alias("__seq"), "value")
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"]+', ""))
    counted = pieces.withColumn("__q", quotes.cast("long"))
    by_range = counted.groupBy("__file", "__part").agg(F.sum("__q").alias("__n"))
    earlier = W.partitionBy("__file").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_range.select("__file", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"))
    inside = W.partitionBy("__file", "__part").orderBy("__seq")
    after = F.pmod(F.col("__o") + F.sum("__q").over(inside), F.lit(2))
    state = counted.join(offsets, ["__file", "__part"]).withColumn("__to", after).withColumn("__from", F.pmod(F.col("__to") + F.col("__q"), F.lit(2)))
    whole = state.filter("__from = 0 AND __to = 0").select("value")
    cut = state.filter("__from = 1 OR __to = 1").select("__file", "__part", "__seq", "value", (F.col("__from") == 0).cast("int").alias("__start"))
    runs = running_sums(cut, ["__file"], "__seq", {"__run": F.col("__start")})
    joined = runs.groupBy("__file", "__run").agg(F.array_sort(F.collect_list(F.struct("__part", "__seq", "value"))).alias("__p"))
    joined = joined.select(F.array_join(F.transform("__p", lambda x: x["value"]), "]").alias("value"))
    return whole.unionByName(joined).filter(F.col("value").rlike(_ROW)).select(F.regexp_extract("value", _ROW, 1).alias("r"))


def read_dataset_json(spark: SparkSession, path: str) -> DataFrame:
    """A Dataset-JSON document (column metadata plus an array of row arrays) as a typed table; a large document is read by many tasks."""
    cols = _json_columns(spark, path)
    rows = _json_rows(spark, path).select(F.from_json(F.concat(F.lit("["), "r", F.lit("]")), "array<string>").alias("r"))
    return rows.select(*[
        F.try_element_at("r", F.lit(i + 1)).try_cast(t).alias(n, metadata={"label": label})
        for i, (n, t, label) in enumerate(cols)])


def read_dataset_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """The newline form: first line the metadata object, then one row array per line; read by many tasks."""
    schema = "columns array<struct<name:string,dataType:string,label:string>>"
    text = spark.read.text(path)
    head = text.filter(F.col("value").startswith("{")).select(F.from_json("value", schema).alias("h")).first()["h"]
    parsed = text.filter(F.col("value").startswith("[")).select(F.from_json("value", "array<string>").alias("r"))
    return parsed.select(*[
        F.try_element_at("r", F.lit(i + 1)).try_cast(JSON_TYPES.get(c["dataType"], "string")).alias(
            c["name"], metadata={"label": c["label"] or ""}) for i, c in enumerate(head["columns"])])


def coerce_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a text column into a number when every value in it parses; one aggregate decides for all columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not text:
        return df
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in text]).first()
    return df.withColumns({c: F.col(c).try_cast("double") for c in text if bad[c] == 0})


def inventory(spark: SparkSession, frames: Mapping[str, DataFrame], study_id: str | None = None) -> DataFrame:
    """One row per domain and column: record count, type and presence, from one count per table."""
    parts = []
    for name, df in frames.items():
        cols = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name.upper()).alias("variable"),
                                  F.lit(f.dataType.simpleString()).alias("type")) for i, f in enumerate(df.schema.fields, 1)])
        parts.append(df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(study_id).cast("string").alias("study_id"), F.lit(name.upper()).alias("domain"), "records",
            F.inline(cols)))
    return reduce(DataFrame.unionByName, parts)


def _measured_type(f: T.StructField) -> str:
    kind = f.dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "integer"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "text"


PREDECESSORS = ("STUDYID", "USUBJID")


def variable_metadata(df: DataFrame, dataset: str, spec_vars: Sequence[tuple[str, str]] = (), distinct: bool = True) -> DataFrame:
    """Per variable: order, type, longest value, nulls, distinct values, mandatory flag, origin and role.

    Specified variables (name, role) come first in their order, then extra data
    columns; a specified variable without data is marked absent. All columns are
    measured in one pass of mergeable aggregates; ``distinct`` counts come from one
    exact two-stage pass over (variable, value) pairs.
    """
    fields = {f.name.upper(): f for f in df.schema.fields}
    names = [n.upper() for n, _ in spec_vars]
    roles = {n.upper(): r for n, r in spec_vars}
    names += [n for n in fields if n not in names]
    have = [n for n in names if n in fields]
    col = lambda n: F.col(f"`{fields[n].name}`")
    stats = df.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.struct(F.count_if(col(n).isNull()).alias("nulls"), F.max(F.length(col(n).cast("string"))).alias("max_length")).alias(f"s{i}")
          for i, n in enumerate(have)])
    rows = []
    for order, n in enumerate(names, 1):
        i = have.index(n) if n in have else None
        rows.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(n).alias("variable"), F.lit(order).alias("order_number"),
            F.lit(_measured_type(fields[n]) if n in fields else None).cast("string").alias("type"),
            (F.col(f"s{i}.max_length") if i is not None else F.lit(None).cast("int")).alias("max_length"),
            (F.col(f"s{i}.nulls") if i is not None else F.lit(None).cast("bigint")).alias("nulls"),
            F.lit(n in PREDECESSORS).alias("mandatory"),
            F.lit("Predecessor" if n in PREDECESSORS else "Derived").alias("origin"),
            F.lit(roles.get(n, "")).alias("role"), F.lit(n in fields).alias("present")))
    out = stats.select("records", F.inline(F.array(*rows)))
    if not distinct:
        return out
    pairs = F.array(*[F.struct(F.lit(n).alias("variable"), col(n).cast("string").alias("value")) for n in have])
    counts = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct().groupBy("variable").agg(
        F.count(F.lit(1)).alias("distinct_values"))
    return out.join(counts, "variable", "left").withColumn(
        "distinct_values", F.when(F.col("present"), F.coalesce("distinct_values", F.lit(0))))


# ---- study documents ---------------------------------------------------------------

_CODE = "struct<code:string,decode:string>"
USDM_SCHEMA = (
    "struct<usdmVersion:string,study:struct<name:string,versions:array<struct<"
    "studyIdentifiers:array<struct<text:string>>,"
    f"titles:array<struct<text:string,type:{_CODE}>>,"
    "studyDesigns:array<struct<"
    f"studyPhase:struct<standardCode:{_CODE}>,"
    f"objectives:array<struct<id:string,name:string,text:string,description:string,level:{_CODE},"
    f"endpoints:array<struct<id:string,name:string,text:string,level:{_CODE}>>>>,"
    "estimands:array<struct<id:string,name:string,populationSummary:string,analysisPopulationId:string,variableOfInterestId:string,"
    "intercurrentEvents:array<struct<name:string,text:string,strategy:string>>>>,"
    "analysisPopulations:array<struct<id:string,name:string,text:string>>,"
    f"arms:array<struct<id:string,name:string,type:{_CODE}>>,"
    "encounters:array<struct<id:string,name:string,label:string>>,"
    "epochs:array<struct<id:string,name:string>>>>>>>>"
)

# Intercurrent-event strategies, matched on the leading phrase.
STRATEGIES = ["Treatment Policy", "Hypothetical", "Composite", "While-on-Treatment", "Principal Stratum"]


def flatten_usdm(docs: DataFrame, column: str = "doc") -> dict[str, DataFrame]:
    """Study documents, one per row as (study_id, doc), flattened to one table per kind.

    The first version and its first design count. All tables are lazy.
    """
    from ..functions.scalars import decode_level, parse_endpoint

    parsed = docs.select("study_id", F.from_json(column, USDM_SCHEMA).alias("u"))
    version = F.try_element_at("u.study.versions", F.lit(1))
    base = parsed.select("study_id", "u", version.alias("v")).withColumn("d", F.try_element_at("v.studyDesigns", F.lit(1)))

    def table(path: str, pos: bool = True) -> DataFrame:
        return base.select("study_id", F.posexplode_outer(path).alias("position", "x")).filter(F.col("x").isNotNull())

    title = F.try_element_at(F.filter("v.titles", lambda t: t["type"]["decode"] == "Official Study Title"), F.lit(1))["text"]
    study = base.select(
        "study_id", F.col("u.study.name").alias("study_name"), title.alias("title"),
        F.col("d.studyPhase.standardCode.decode").alias("phase"), F.col("u.usdmVersion").alias("usdm_version"))
    objectives = table("d.objectives").select(
        "study_id", F.col("x.id").alias("objective_id"), F.col("x.name").alias("name"),
        decode_level("x.level.code", "x.level.decode").alias("level"), F.col("x.text").alias("text"),
        F.transform("x.endpoints", lambda e: e["id"]).alias("endpoint_ids"), "position")
    endpoints = table("d.objectives").select(
        "study_id", F.col("x.id").alias("objective_id"), F.explode("x.endpoints").alias("e")).select(
        "study_id", "objective_id", F.col("e.id").alias("endpoint_id"), F.col("e.name").alias("name"),
        decode_level("e.level.code", "e.level.decode").alias("level"), F.col("e.text").alias("text"))
    strategy = lambda s: F.coalesce(*[F.when(F.lower(F.ltrim(s)).startswith(k.lower()), F.lit(k)) for k in STRATEGIES], s)
    estimands = table("d.estimands").select(
        "study_id", F.col("x.id").alias("estimand_id"), F.col("x.name").alias("name"),
        F.col("x.populationSummary").alias("population_summary"), F.col("x.analysisPopulationId").alias("population_id"),
        F.col("x.variableOfInterestId").alias("endpoint_id"), F.explode_outer("x.intercurrentEvents").alias("i")).select(
        "study_id", "estimand_id", "name", "population_summary", "population_id", "endpoint_id",
        F.col("i.name").alias("event"), strategy(F.col("i.strategy")).alias("strategy"))
    dose = F.regexp_extract(F.col("x.name"), r"(\d+(?:\.\d+)?) ?mg", 1)
    return {
        "study": study,
        "objectives": objectives,
        "endpoints": parse_endpoint(endpoints, "text"),
        "estimands": estimands,
        "populations": table("d.analysisPopulations").select("study_id", F.col("x.id").alias("population_id"),
                                                             F.col("x.name").alias("name"), F.col("x.text").alias("text")),
        "arms": table("d.arms").select("study_id", F.col("x.id").alias("arm_id"), F.col("x.name").alias("name"),
                                       F.col("x.type.decode").alias("type"), dose.try_cast("double").alias("dose"), "position"),
        "visits": table("d.encounters").select("study_id", F.col("x.id").alias("visit_id"),
                                               F.coalesce("x.label", "x.name").alias("name"), "position"),
        "epochs": table("d.epochs").select("study_id", F.col("x.id").alias("epoch_id"), F.col("x.name").alias("name"), "position"),
    }


def _contents(text: str | None) -> list[tuple]:
    """(list, path, depth, name, analysis_id, output_id) of every item of one document, parents before children; none of a text that is not JSON."""
    try:
        root = json.loads(text) if text else None
    except ValueError:
        return []
    as_dict = lambda x: x if isinstance(x, dict) else {}
    items = lambda x: [i for i in as_dict(x).get("listItems") or [] if isinstance(i, dict)] if isinstance(as_dict(x).get("listItems"), list) else []
    word = lambda x: x if x is None or isinstance(x, str) else json.dumps(x)
    main = as_dict(as_dict(root).get("mainListOfContents"))
    todo = [("main", "listItems", 1, items(main.get("contentsList")) or items(main))]
    others = as_dict(root).get("otherListsOfContents")
    for o in others if isinstance(others, list) else []:
        todo.append((word(as_dict(o).get("name")) or "other", "listItems", 1, items(as_dict(o).get("contentsList"))))
    out = []
    while todo:
        name, trail, depth, found = todo.pop()
        for i, x in enumerate(found):
            out.append((name, f"{trail}/{i}", depth, word(x.get("name")), word(x.get("analysisId")), word(x.get("outputId"))))
            below = items(x.get("sublist"))
            if below:
                todo.append((name, f"{trail}/{i}/sublist/listItems", depth + 1, below))
    return out


def flatten_contents(docs: DataFrame, column: str = "doc") -> DataFrame:
    """The nested lists of contents as rows (list, path, depth, name, analysis_id, output_id).

    Documents are parsed once, each to the rows of all its depths, so one scan does whatever the depth. A null document, one that is not JSON
    and one without lists have no rows.
    """
    schema = T.StructType([docs.schema["study_id"], *T.StructType.fromDDL("list string, path string, depth int, name string, analysis_id string, output_id string").fields])

    names = schema.names

    def parse(batches):
        for b in batches:
            rows = [(s, *r) for s, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in _contents(text)]
            for at in range(0, len(rows), 10_000):
                part = list(zip(*rows[at:at + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(part, [b.schema.field(0).type, pa.string(), pa.string(), pa.int32(), *[pa.string()] * 3])],
                                                 names=names)

    return docs.select("study_id", F.col(column).cast("string").alias("__doc")).mapInArrow(parse, schema)

