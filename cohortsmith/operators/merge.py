"""Merges between record tables and subject-level tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .groups import extreme_rows, in_ranges, keyed_join, order_key, prefix_counts


def _flag_rows(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The distinct keys of ``df`` with a marker column."""
    return df.select(*by).distinct().withColumn("__hit", F.lit(True))


def merge_vars(df: DataFrame, add: DataFrame, by: Sequence[str], new_vars: Sequence[str],
               check: bool = True) -> DataFrame:
    """Left merge of ``new_vars`` by key; the job fails if the added side repeats a key.

    The check rides on the one aggregate that makes the added side unique, so it
    costs no extra job.
    """
    if check:
        count = F.count(F.lit(1))
        guard = F.when(count > 1, F.raise_error(F.lit(f"merge_vars: repeated key in {list(by)}")).cast("boolean"))
        add = (
            add.groupBy(*by)
            .agg(*[F.first(v).alias(v) for v in new_vars], count.alias("__n"), guard.alias("__guard"))
            .filter(F.col("__guard").isNull())
            .drop("__n", "__guard")
        )
    return keyed_join(df.drop(*[v for v in new_vars if v not in by]), add.select(*by, *new_vars), by)


def merge_extreme(df: DataFrame, add: DataFrame, by: Sequence[str], order: Sequence[Column | str], mode: str,
                  new_vars: dict[str, str], where: str | Column | None = None) -> DataFrame:
    """Merge values of the first or last record per key; ``new_vars`` maps new name to source column."""
    if where is not None:
        add = add.filter(where)
    picked = extreme_rows(add, by, order, mode, keep=list(dict.fromkeys(new_vars.values())))
    renamed = picked.select(*by, *[F.col(src).alias(new) for new, src in new_vars.items()])
    return keyed_join(df.drop(*new_vars), renamed, by)


def flag_exists(df: DataFrame, add: DataFrame, by: Sequence[str], cond: str | Column, new_var: str,
                yes: str = "Y", no: str | None = "N") -> DataFrame:
    """``yes`` where any record of ``add`` meets the condition for the key, else ``no``."""
    hits = _flag_rows(add.filter(cond), by)
    return keyed_join(df.drop(new_var), hits, by).withColumn(
        new_var, F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no))
    ).drop("__hit")


def combine_supp(parent: DataFrame, supp: DataFrame, qnams: dict[str | None, Sequence[str]],
                 by: Sequence[str] = ("USUBJID",)) -> DataFrame:
    """Pivot supplemental qualifiers and merge them, one join per identifying variable.

    ``qnams`` maps each IDVAR (None for subject-level rows) to its qualifier names,
    so no job is needed to find the pivot columns. A key that repeats a qualifier
    keeps the largest value.
    """
    out = parent
    for idvar, names in qnams.items():
        mine = F.coalesce(F.col("IDVAR"), F.lit("")) == F.lit(idvar or "")
        keys = list(by) if not idvar else [*by, "IDVARVAL"]
        wide = supp.filter(mine).groupBy(*keys).agg(
            *[F.max(F.when(F.col("QNAM") == q, F.col("QVAL"))).alias(q) for q in names]
        )
        if idvar:
            out = keyed_join(out.withColumn("IDVARVAL", F.col(idvar).cast("string")), wide, keys).drop("IDVARVAL")
        else:
            out = keyed_join(out, wide, keys)
    return out


def assign_window_table(df: DataFrame, windows: DataFrame, day: str = "ADY", pick: bool = True,
                        by: Sequence[str] = ("USUBJID", "PARAMCD"), tie: Sequence[str] = ("ASEQ",)) -> DataFrame:
    """Records in caller-given day windows, nearest to target per window; off-window records fall away.

    ``windows`` has AVISIT, AVISITN, LOWER, TARGET and UPPER, one row per visit of a
    protocol; Spark broadcasts it when its measured size allows.
    """
    hit = df.join(windows, (F.col(day) >= F.col("LOWER")) & (F.col(day) <= F.col("UPPER")))
    if not pick:
        return hit
    near = [F.abs(F.col(day) - F.col("TARGET")), -F.col(day), *[F.col(t) for t in tie]]
    return extreme_rows(hit, [*by, "AVISIT"], near, "first", keep=hit.columns).select(*hit.columns)


def asof_last(df: DataFrame, ref: DataFrame, by: Sequence[str], date: str, ref_date: str,
              tie: Sequence[str], new_vars: dict[str, str], match_by: Sequence[str] | None = None) -> DataFrame:
    """The last record at or before each reference date: one filtered ``max_by`` per key."""
    match_by = list(match_by or by)
    dated = keyed_join(df, ref.select(*match_by, ref_date), match_by, "inner")
    eligible = dated.filter(F.col(date) <= F.col(ref_date))
    picked = extreme_rows(eligible, by, [date, *tie], "last", keep=list(new_vars.values()))
    return picked.select(*by, *[F.col(src).alias(new) for new, src in new_vars.items()])


def without(df: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key has no row in ``other``."""
    return keyed_join(df, other.select(*by), by, "left_anti")


def flag_overlap(df: DataFrame, start: str = "ASTDT", end: str = "AENDT", ref_start: str = "TRTSDT",
                 ref_end: str = "TRTEDT") -> DataFrame:
    """CONCOMFL, PREFL and ONTRTFL against the treatment period; open ends reach without limit.

    PREFL: started before first dose. ONTRTFL: started within the treatment period.
    CONCOMFL: any overlap with it.
    """
    s, e, a, b = F.col(start), F.col(end), F.col(ref_start), F.col(ref_end)
    starts_by_end = b.isNull() | s.isNull() | (s <= b)
    ends_after_start = e.isNull() | (e >= a)
    treated = a.isNotNull()
    yes = F.lit("Y")
    return df.withColumns({
        "PREFL": F.when(treated & (s < a), yes),
        "CONCOMFL": F.when(treated & starts_by_end & ends_after_start, yes),
        "ONTRTFL": F.when(treated & (s >= a) & (b.isNull() | (s <= b)), yes),
    })


def merge_joined(df: DataFrame, add: DataFrame, by: Sequence[str], cond: str | Column, order: Sequence[Column | str],
                 mode: str, new_vars: dict[str, str], row_key: Sequence[str]) -> DataFrame:
    """First or last record of ``add`` per row of ``df`` under any condition over both sides, tried on all pairs of a key.

    For a range of one column of ``add`` use ``merge_in_range``, whose work does not grow with the size of a key.

    ``row_key`` identifies a row of ``df``. Names used in ``cond`` must be unique
    over both tables. Matches are reduced by partial aggregation before any group
    meets in one task.
    """
    pairs = keyed_join(df, add, by, "inner").filter(cond)
    picked = extreme_rows(pairs, row_key, order, mode, keep=list(dict.fromkeys(new_vars.values())))
    renamed = picked.select(*row_key, *[F.col(src).alias(new) for new, src in new_vars.items()])
    return keyed_join(df, renamed, row_key)


def _positions(points: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """``below`` of each point (``by``, ``__x``): how many counted points of its key lie below it, and ``total``."""
    return prefix_counts(in_ranges(points, by, "__x"), by, "__x", count)


def _tree_nodes(first: Column, end: Column) -> Column:
    """The aligned blocks of 1, 2, 4, ... places that make up [first, end), as (level, node): at most two of each size."""
    levels = F.sequence(F.lit(0), F.greatest(F.floor(F.log2(F.greatest(end - first, F.lit(1)).cast("double"))), F.lit(0)).cast("int"))

    def of_level(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level).cast("long")
        lo, hi = F.floor((first + size - 1) / size).cast("long"), F.floor(end / size).cast("long")
        node = lambda ok, at: F.when((lo < hi) & ok, F.struct(level.cast("int").alias("level"), at.alias("node")))
        return F.array(node(F.pmod(lo, F.lit(2)) == 1, lo), node(F.pmod(hi, F.lit(2)) == 1, hi - 1))

    return F.filter(F.flatten(F.transform(levels, of_level)), lambda x: x.isNotNull())


def merge_in_range(df: DataFrame, add: DataFrame, by: Sequence[str], value: str, low: str | None, high: str | None,
                   order: Sequence[str], mode: str, new_vars: dict[str, str], row_key: Sequence[str],
                   closed: tuple[bool, bool] = (True, True)) -> DataFrame:
    """``merge_joined`` for the condition ``low <= value <= high``: the first or last record by ``order`` whose ``value`` lies in the row's range.

    ``low`` and ``high`` are columns of ``df`` (None: no bound; a null in a bound: no record), ``value`` and ``order`` are
    columns of ``add``, and ``closed`` says which bounds count themselves. ``row_key`` identifies a row of ``df``.

    The distinct values of a key are numbered along with the bounds by one scan over ranges. Blocks of 1, 2, 4, ... neighbouring
    values keep their first or last record, and a row's range is a union of at most two blocks of each size: so a row meets
    about 2 log2(values) candidates, however many records its key and its range hold, and the blocks are at most twice the values.
    """
    by, row_key, keep = list(by), list(row_key), list(dict.fromkeys([*new_vars.values(), *order]))
    keep = [c for c in keep if c not in by]
    leaves = extreme_rows(
        add.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("__x"), *keep), [*by, "__x"], order, mode, keep=keep)
    bounds = [b for b in (low, high) if b is not None]
    rows = df.select(*row_key, *[b for b in by if b not in row_key], *[F.col(b).alias(f"__b{i}") for i, b in enumerate(bounds)])
    points = leaves.select(*by, "__x", F.lit(1).alias("__leaf"))
    for i in range(len(bounds)):
        points = points.unionByName(rows.filter(F.col(f"__b{i}").isNotNull()).select(*by, F.col(f"__b{i}").alias("__x"), F.lit(0).alias("__leaf")))
    places = _positions(points.groupBy(*by, "__x").agg(F.max("__leaf").alias("__leaf")), by, "__leaf")
    leaf_places = places.filter(F.col("__leaf") == 1).select(*by, "__x", F.col("below").alias("__at"))
    row = F.struct(*keep)
    numbered = keyed_join(leaves, leaf_places, [*by, "__x"], "inner").select(*by, "__at", row.alias("__row"), order_key(order).alias("__o"))
    pick = F.min_by if mode == "first" else F.max_by
    best = F.min if mode == "first" else F.max
    sizes = leaf_places.groupBy(*by).agg((F.max("__at") + 1).alias("__total"))
    levels = F.sequence(F.lit(0), F.floor(F.log2(F.col("__total").cast("double"))).cast("int"))
    blocks = keyed_join(numbered, sizes, by, "inner").withColumn("__level", F.explode(levels)).withColumn(
        "__node", F.floor(F.col("__at") / F.pow(F.lit(2.0), F.col("__level"))).cast("long"))
    blocks = blocks.groupBy(*by, "__level", "__node").agg(pick("__row", "__o").alias("__row"), best("__o").alias("__o"))
    ranged = rows
    for i, b in enumerate(bounds):
        ranged = keyed_join(ranged, places.select(*by, F.col("__x").alias(f"__b{i}"), F.col("below").alias(f"__n{i}"), F.col("__leaf").alias(f"__l{i}")),
                            [*by, f"__b{i}"], "inner")
    if high is None:
        ranged = keyed_join(ranged, sizes, by, "inner")
    lo_at, hi_at = 0, len(bounds) - 1
    first = F.lit(0) if low is None else F.col(f"__n{lo_at}") + (F.lit(0) if closed[0] else F.col(f"__l{lo_at}"))
    end = F.col("__total") if high is None else F.col(f"__n{hi_at}") + (F.col(f"__l{hi_at}") if closed[1] else F.lit(0))
    probes = ranged.filter(first < end).select(*row_key, *[b for b in by if b not in row_key], F.explode(_tree_nodes(first, end)).alias("__t")).select(
        *row_key, *[b for b in by if b not in row_key], F.col("__t.level").alias("__level"), F.col("__t.node").alias("__node"))
    met = keyed_join(probes, blocks, [*by, "__level", "__node"], "inner")
    picked = met.groupBy(*row_key, *[b for b in by if b not in row_key]).agg(pick("__row", "__o").alias("__row"))
    values = picked.select(*row_key, *[(F.col(src) if src in by else F.col(f"__row.{src}")).alias(new) for new, src in new_vars.items()])
    return keyed_join(df, values, row_key)


def merge_as_of_by_bucket(df: DataFrame, add: DataFrame, by: Sequence[str], day: str, add_day: str,
                          lookback: int, tie: Sequence[str], new_vars: dict[str, str],
                          row_key: Sequence[str]) -> DataFrame:
    """``merge_joined`` for "last value at most ``lookback`` days before", as a bucketed equi-join.

    ``add`` is first reduced to its last record per (key, day). Days are cut into
    buckets as long as the look-back, so each row meets two buckets and at most
    ``2 * lookback`` candidates, whatever the size of its key.
    """
    width = max(int(lookback), 1)
    vals = list(new_vars.values())
    daily = extreme_rows(add, [*by, add_day], list(tie), "last", keep=vals).withColumn(
        "__bucket", F.floor(F.datediff(F.col(add_day), F.lit("1970-01-01").cast("date")) / width)
    )
    own = F.floor(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) / width)
    probe = df.select(*row_key, *[b for b in by if b not in row_key],
                      *[day] if day not in [*row_key, *by] else []).withColumn(
        "__bucket", F.explode(F.array(own, own - 1)))
    right = daily.withColumnRenamed(add_day, "__add_day")
    pairs = keyed_join(probe, right, [*by, "__bucket"], "inner").filter(
        (F.col("__add_day") <= F.col(day)) & (F.datediff(F.col(day), F.col("__add_day")) <= lookback)
    )
    picked = extreme_rows(pairs, row_key, ["__add_day"], "last", keep=vals)
    renamed = picked.select(*row_key, *[F.col(src).alias(new) for new, src in new_vars.items()])
    return keyed_join(df, renamed, row_key)


def dangling_refs(uses: DataFrame, defs: DataFrame, by: Sequence[str] = ("study_id",)) -> DataFrame:
    """Uses ``(owner, field, kind, ref)`` with no definition ``(kind, ref)`` in the same study, with a message."""
    key = [*by, "kind", "ref"]
    missing = keyed_join(uses.filter(F.col("ref").isNotNull()), defs.select(*key), key, "left_anti")
    return missing.withColumn(
        "message", F.format_string("%s: %s refers to unknown %s '%s'", "owner", "field", "kind", "ref")
    )


def spec_coverage(spec_vars: DataFrame, data_cols: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variable-level presence and the per-dataset status.

    Both inputs have (dataset, variable). The first result marks each variable
    present, missing (specified only) or extra (in the data only); the second
    counts them and says OK or blocked.
    """
    key = ["dataset", "variable"]
    spec = spec_vars.select(*key).distinct().withColumn("in_spec", F.lit(True))
    data = data_cols.select(*key).distinct().withColumn("in_data", F.lit(True))
    both = spec.join(data, key, "full_outer")
    detail = both.select(
        *key,
        F.when(F.col("in_spec") & F.col("in_data"), "present")
        .when(F.col("in_spec"), "missing").otherwise("extra").alias("state"),
    )
    count = lambda s: F.count_if(F.col("state") == s)
    status = detail.groupBy("dataset").agg(
        count("present").alias("n_present"), count("missing").alias("n_missing"), count("extra").alias("n_extra")
    ).withColumn("status", F.when(F.col("n_missing") == 0, "OK").otherwise("blocked"))
    return detail, status


def union_rows(*frames: DataFrame) -> DataFrame:
    """Stack record tables with unequal columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
