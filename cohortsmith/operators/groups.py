"""Building blocks that keep one hot group from landing in one task.

Nothing here puts a whole group into a window or a list. Group facts come from
partial aggregation, are joined back with a join that AQE can split, and order
statistics come from two-level prefix sums over value counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed


def keyed_join(df: DataFrame, table: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``table`` on ``by`` (null matches null) so that a hot key can be split.

    A table fresh from an aggregate is already partitioned by its key; Spark then
    reuses that partitioning and AQE no longer sees two plain exchanges, which is
    what its skew split needs. A hash of the key as one more join key makes the
    join ask for its own exchange on both sides. Small tables still turn into
    broadcast joins at run time, by measured size; no hint is given here.
    """
    by = list(by)
    right = table.select(
        *[F.col(b).alias(f"__k_{b}") for b in by],
        F.xxhash64(*by).alias("__k_hash"),
        *[c for c in table.columns if c not in by],
    )
    left = df.withColumn("__hash", F.xxhash64(*by))
    cond = F.col("__hash") == F.col("__k_hash")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__k_{b}"))
    joined = left.join(right, cond, how)
    return joined.drop("__hash", "__k_hash", *[f"__k_{b}" for b in by])


def attach_aggregates(df: DataFrame, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """Add group aggregates to every row: map-side combine, then ``keyed_join``."""
    facts = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()])
    return keyed_join(df.drop(*aggregates), facts, by)


def order_key(order: Sequence[Column | str]) -> Column:
    """A comparable struct out of order columns (nulls sort first)."""
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def extreme_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], mode: str = "first",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """One row per group, the first or last in ``order``, by ``min_by``/``max_by``.

    Rows with a null in the leading order column are left out. ``order`` should
    be total, else any of the tied rows may be returned.
    """
    keep = [c for c in (keep or df.columns) if c not in by]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    pick = F.min_by if mode == "first" else F.max_by
    row = F.struct(*[F.col(c) for c in keep])
    return (
        df.filter(cols[0].isNotNull())
        .groupBy(*by)
        .agg(pick(row, order_key(cols)).alias("__row"))
        .select(*by, *[F.col(f"__row.{c}").alias(c) for c in keep])
    )


def in_ranges(counts: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``counts`` (one row per ``by`` and value) cut into ranges of values, numbered by ``__part`` and materialised.

    The cut is Spark's range partitioning over groups and values together, so its number of ranges follows the size of
    the table and the session's partition settings, and a group of any size is many ranges.
    """
    return checkpointed(counts.repartitionByRange(*by, value).withColumn("__part", F.spark_partition_id()))


def prefix_counts(ranged: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """Rows strictly below each distinct value and in total, as ``below`` and ``total``.

    ``ranged`` comes from ``in_ranges``. A running sum over a group's ranges gives each range its offset, and a second
    running sum stays inside one range.
    """
    by = list(by)
    over_ranges, group = W.partitionBy(*by).orderBy("__part"), W.partitionBy(*by)
    offsets = ranged.groupBy(*by, "__part").agg(F.sum(n).alias("__rn")).select(
        *by, "__part", F.coalesce(F.sum("__rn").over(over_ranges.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.sum("__rn").over(group).alias("total"))
    inside = W.partitionBy(*by, "__part").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        keyed_join(ranged, offsets, [*by, "__part"], "inner")
        .withColumn("below", F.col("__off") + F.coalesce(F.sum(n).over(inside), F.lit(0)))
        .drop("__part", "__off")
    )


def running_sums(ranged: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column], later: bool = False,
                 strict: bool = False) -> DataFrame:
    """Running sums along ``value`` within each group of a table from ``in_ranges``, however long the group.

    Each range sums its own rows first; a running sum over the ranges of a group (as many rows as ranges) gives a range the sum
    of those before it, and only a range's own rows meet in a task. ``later`` runs from the last value back; ``strict``
    leaves out the row's own value. ``__part`` stays, so that scans can follow one another.
    """
    by = list(by)
    order = F.col("__part").desc() if later else F.col("__part").asc()
    over_ranges = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    per_range = ranged.groupBy(*by, "__part").agg(*[F.sum(c).alias(f"__r_{n}") for n, c in sums.items()])
    offsets = per_range.select(*by, "__part", *[F.coalesce(F.sum(f"__r_{n}").over(over_ranges), F.lit(0)).alias(f"__o_{n}") for n in sums])
    inside = W.partitionBy(*by, "__part").orderBy(F.col(value).desc() if later else F.col(value).asc()).rowsBetween(
        W.unboundedPreceding, -1 if strict else 0)
    joined = keyed_join(ranged.drop(*sums), offsets, [*by, "__part"], "inner")
    return joined.withColumns({n: F.col(f"__o_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).drop(
        *[f"__o_{n}" for n in sums])


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """How often each value that is not null occurs per group (``__n``), cut into ranges."""
    return in_ranges(df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n")), by, value)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles per group, one column per entry of ``probs``.

    Works on value counts, so a group of any size is spread over many tasks.
    """
    return quantiles_of_counts(value_counts(df, by, value), by, value, probs)


def quantiles_of_counts(counts: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """The same from the result of ``value_counts``."""
    by = list(by)
    ranked = prefix_counts(counts, by, value, "__n")
    out = []
    for name, p in probs.items():
        h = (F.col("total") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda r: (F.col("below") <= r) & (r < F.col("below") + F.col("__n"))
        low = F.max(F.when(covers(lo), F.col(value)))
        high = F.max(F.when(covers(hi), F.col(value)))
        frac = F.max(h - lo)
        out.append((low + (high - low) * frac).alias(name))
    return ranked.groupBy(*by).agg(*out)
