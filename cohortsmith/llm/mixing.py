"""Operator 9: mix sources to target weights with a time-varying curriculum.

Each source has a weight and a schedule of its own over training time t in [0, 1]: it is asked for ``target * (1 + drift * (2 t - 1))`` words a unit of time, more and
more if its drift is positive and less and less if negative. Sources take drifts in turn, as they take weights, so by default those of the largest weight grow and those of the
least shrink. The demand for words up to t is the integral, ``D(t) = target * (t + drift * (t^2 - t))``, which ends at the target whatever the drift. The words of its documents, laid end to end in a hashed order and repeated up to
``max_epochs`` times, meet that demand: the copy that starts at word x is trained at the t where D(t) = x, and a range sort by t
gives the order of training.

Nulls: a null source is a source of its own, last in order; a null or empty text has size 0 and takes nothing; a null id is ordered as an
empty one. Repeated rows each count. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, rows_of


def targets(sized: DataFrame, weights: tuple[float, ...], max_epochs: int, drifts: tuple[float, ...]) -> DataFrame:
    """Per source: size, weight, drift and target in words, all sources together taking as many words as there are.

    A source whose share would exceed ``max_epochs`` times its size stops there and the rest share what is over. In order of size by
    weight the stopped sources come first, so prefix sums over the table of sources find where stopping ends.
    """
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1

    def in_turn(values: tuple[float, ...]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("_rank") % len(values) + 1).cast("int"))

    table = by_source.withColumn("_rank", rank).withColumn("weight", in_turn(weights)).withColumn("drift", in_turn(drifts))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "_rank")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    stopped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * max_epochs
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    table = table.withColumn("_level", (F.sum("source_size").over(everything) - stopped) / left)
    fits = F.col("source_size") * max_epochs / F.col("weight") >= F.col("_level")
    level = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), F.col("_rank"), F.col("_level").alias("level")))).over(everything)["level"]
    table = table.withColumn("_share", level * F.col("weight")).withColumn("_most", (F.col("source_size") * max_epochs).cast("double"))
    return table.select("_source", "source_size", "weight", "drift", F.least("_share", "_most").alias("target"))


def position(share: Column, drift: Column) -> Column:
    """The t with ``t + drift * (t^2 - t) = share``, for a drift above -1 and below 1."""
    return 2 * share / (1 - drift + F.sqrt((1 - drift) * (1 - drift) + 4 * drift * share))


def curriculum(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, drifts: tuple[float, ...] = (0.5, 0.0, -0.5), rows_per_bucket: int = 20_000, ordered: bool = True) -> DataFrame:
    """One row per document, in order of training if ``ordered``: ``keep`` columns, size, source_size, target, copies, taken and positions (one t per copy).

    ``rows_per_bucket`` sizes the buckets over which the running sum of a source is spread, so a source with a third of all rows
    is many windows.
    """
    if not all(-1 < d < 1 for d in drifts):
        raise ValueError("a drift must lie between -1 and 1")
    buckets = max(1, rows_of(docs) // rows_per_bucket)
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    row = docs.select(F.struct(*keep).alias("_row"), F.col(source_col).alias("_source"), key.alias("_key"), F.hash(F.col(text_col)).alias("_tie"),
                      F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("_size"))
    row = row.withColumn("_bucket", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)))
    # a source as two columns without nulls: the join below then meets the rows, whole texts among them, where the window has put them
    row = row.withColumn("_name", F.coalesce(F.col("_source").cast("string"), F.lit(""))).withColumn("_none", F.col("_source").isNull())
    at = ["_name", "_none", "_bucket"]
    sums = row.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_source", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    sources = targets(row, weights, max_epochs, drifts)
    places = sums.alias("a").join(sources.alias("b"), F.col("a._source").eqNullSafe(F.col("b._source"))).select(
        F.coalesce(F.col("a._source").cast("string"), F.lit("")).alias("_name"), F.col("a._source").isNull().alias("_none"), "_bucket", "_base", "source_size", "drift", "target")
    within = Window.partitionBy(*at).orderBy("_key", "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    row = row.withColumn("_run", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    row = row.join(places, at)
    start = [F.col("_base") + F.col("_run") + c * F.col("source_size") for c in range(max_epochs)]
    row = row.withColumn("positions", F.array_compact(F.array(*[F.when(s < F.col("target"), position(s / F.col("target"), F.col("drift"))) for s in start])))
    copies = F.size("positions").cast("long")
    if ordered:
        row = row.orderBy(F.try_element_at("positions", F.lit(1)).asc_nulls_last(), "_key")
    return row.select(
        "_row.*", F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("_size")).alias("taken"), "positions")


def trained(docs: DataFrame, **options) -> DataFrame:
    """The documents as they are trained: each row once per copy, in order of position."""
    plain = docs.select(F.struct(*docs.columns).alias("_doc"), *[F.col(options.get(k, v)).alias(f"_{v}") for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))])
    options = {k: v for k, v in options.items() if k not in ("id_col", "text_col", "source_col")}
    mixed = curriculum(plain, ["_doc"], id_col="_doc_id", text_col="_text", source_col="_source", ordered=False, **options)
    return mixed.select("_doc", F.explode("positions").alias("_position")).orderBy("_position").select("_doc.*")


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words each document gives, and its source's target; rows are in order of training."""
    return curriculum(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = """
WITH row AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM row GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS r FROM src),
weighed AS (SELECT *, CASE r % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM ranked),
-- what each set of stopped sources (those of least size by weight) leaves for a unit of weight
level AS (SELECT a.*, (SELECT sum(source_size) FROM weighed) AS total,
                 coalesce((SELECT sum(b.source_size) FROM weighed b WHERE (b.source_size / b.w, b.r) < (a.source_size / a.w, a.r)), 0) AS stopped,
                 (SELECT sum(b.w) FROM weighed b WHERE (b.source_size / b.w, b.r) >= (a.source_size / a.w, a.r)) AS weight_left FROM weighed a),
lam AS (SELECT arg_min((total - 3 * stopped) / weight_left, (source_size / w, r)) AS v FROM level
        WHERE 3 * source_size / w >= (total - 3 * stopped) / weight_left),
goal AS (SELECT source, source_size, least((SELECT v FROM lam) * w, 3.0 * source_size)::DOUBLE AS target FROM weighed),
run AS (SELECT row.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY row.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM row JOIN goal ON row.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target, CAST(size * ((before < target)::INT + (before + source_size < target)::INT + (before + 2 * source_size < target)::INT) AS BIGINT) AS taken FROM run
"""
