"""Summary statistics as tidy long tables, one row per statistic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .groups import exact_quantiles, in_ranges, keyed_join, quantiles_of_counts

ARD_COLUMNS = ["study_id", "analysis_id", "group1", "group1_level", "variable", "variable_level", "context",
               "stat_name", "stat", "stat_chr"]
QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def to_ard(df: DataFrame, arm: str | None, context: str, stats: Sequence[str], variable: Column | str | None = None,
           variable_level: Column | str | None = None, extra: Sequence[str] = (), study_id: str | None = None,
           analysis_id: str | None = None) -> DataFrame:
    """Unpivot a wide table of statistics into the long schema, keeping ``extra`` columns."""
    lit = lambda x: F.lit(x).cast("string")
    col = lambda x: lit(None) if x is None else (F.col(x) if isinstance(x, str) else x).cast("string")
    wide = df.select(
        lit(study_id).alias("study_id"), lit(analysis_id).alias("analysis_id"), lit(arm).alias("group1"),
        col(arm).alias("group1_level"), col(variable).alias("variable"), col(variable_level).alias("variable_level"),
        lit(context).alias("context"), *extra, *[F.col(s).cast("double").alias(s) for s in stats],
    )
    ids = ["study_id", "analysis_id", "group1", "group1_level", "variable", "variable_level", "context", *extra]
    return wide.unpivot(ids, list(stats), "stat_name", "stat").withColumn("stat_chr", F.col("stat").cast("string"))


def continuous_wide(df: DataFrame, by: Sequence[str], variables: Sequence[str],
                    quantiles: dict[str, float] | None = None) -> DataFrame:
    """N, mean, sd, min, max and exact quantiles per group and variable, one row each; N = 0 and nulls where a group has no value."""
    quantiles = QUANTILES if quantiles is None else quantiles
    long = df.select(*by, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        list(by), list(variables), "variable", "value")
    key = [*by, "variable"]
    # everything comes from one materialised table of value counts; nulls stay in it, so that a group without any value keeps its row
    counts = in_ranges(long.groupBy(*key, "value").agg(F.count(F.lit(1)).alias("__n")), key, "value")
    return continuous_of_counts(counts, key, quantiles)


def continuous_of_counts(counts: DataFrame, key: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """The same from counts of values per ``key`` (value, __n) out of ``in_ranges``; a group of nulls alone has N = 0."""
    n, v = F.when(F.col("value").isNotNull(), F.col("__n")), F.col("value")
    moments = counts.groupBy(*key).agg(F.coalesce(F.sum(n), F.lit(0)).alias("N"), F.try_divide(F.sum(n * v), F.sum(n)).alias("mean"),
                                       F.min(v).alias("min"), F.max(v).alias("max"))
    around = keyed_join(counts, moments.select(*key, "N", "mean"), key).groupBy(*key).agg(
        F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.col("mean"), 2)), F.max("N") - 1)).alias("sd"))
    moments = keyed_join(moments, around, key).select(*key, "N", "mean", "sd", "min", "max")
    return keyed_join(moments, quantiles_of_counts(counts.filter(v.isNotNull()), key, "value", quantiles), key) if quantiles else moments


def ard_continuous(df: DataFrame, by: Sequence[str], variables: Sequence[str],
                   stats: Sequence[str] = ("N", "mean", "sd", "median", "min", "max"), **ids) -> DataFrame:
    """Continuous summary rows; the first ``by`` column is the group, the others stay as columns."""
    quantiles = {k: p for k, p in QUANTILES.items() if k in stats}
    wide = continuous_wide(df, by, variables, quantiles)
    return to_ard(wide, by[0] if by else None, "continuous", stats, "variable", extra=list(by)[1:], **ids)


def population_n(adsl: DataFrame, flag: str, arm: str = "ARM", total: str | None = None) -> DataFrame:
    """Subjects per arm with the population flag, from the subject table; optionally a total row."""
    counted = adsl.filter(F.col(flag) == "Y")
    if total is None:
        return counted.groupBy(arm).agg(F.count(F.lit(1)).alias("N"))
    return (
        counted.rollup(arm).agg(F.count(F.lit(1)).alias("N"), F.grouping(arm).alias("__g"))
        .select(F.when(F.col("__g") == 1, F.lit(total)).otherwise(F.col(arm)).alias(arm), "N")
    )


#: Level of values outside the declared list.
UNDECLARED = "Other or missing"


def ard_categorical(df: DataFrame, arm: str, variable: str, levels: Sequence[str], arms: Sequence[str],
                    denom: DataFrame) -> DataFrame:
    """Hits, N and percent per arm and level, with a zero row for each absent pair.

    ``levels`` and ``arms`` are the declared level lists; ``denom`` holds N per arm. Values
    outside the list, nulls included, are counted in a row of their own where there are any.
    """
    declared = F.when(F.col(variable).cast("string").isin(*levels), F.col(variable).cast("string")).otherwise(F.lit(UNDECLARED))
    counts = df.groupBy(arm, declared.alias("level")).agg(F.count(F.lit(1)).alias("hits"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, l) for a in arms for l in levels], f"{arm} string, level string")
    other = counts.filter((F.col("level") == UNDECLARED) & F.col(arm).isin(*arms)).select(arm, "level")
    filled = grid.union(other).join(counts, [arm, "level"], "left").join(denom, arm, "left")
    hits, total = F.coalesce(F.col("hits"), F.lit(0)), F.col("N")
    return filled.select(
        arm, F.lit(variable).alias("variable"), "level", hits.alias("hits"), F.coalesce(total, F.lit(0)).alias("N"),
        F.try_divide(100.0 * hits, total).alias("pct"),
    )


def ard_hierarchical(events: DataFrame, denom: DataFrame, arms: Sequence[str], arm: str = "ARM",
                     levels: Sequence[str] = ("AESOC", "AEDECOD"), subject: str = "USUBJID",
                     extra: Sequence[str] = ()) -> DataFrame:
    """Subjects, percent and events per arm: any event, per first level, per second level.

    Events are first counted per subject and finest term, so the subject counts of
    every level come from that smaller table, and no subject meets its own events
    again. Terms seen in any arm get a row for each arm. ``extra`` adds grouping
    columns such as severity.
    """
    finest = [arm, *extra, *levels, subject]
    per_subject = events.groupBy(*finest).agg(F.count(F.lit(1)).alias("events"))
    parts = []
    for depth in range(len(levels) + 1):
        kept = list(levels[:depth])
        mine = per_subject.groupBy(arm, *extra, *kept, subject).agg(F.sum("events").alias("events"))
        parts.append(mine.groupBy(arm, *extra, *kept).agg(
            F.count(F.lit(1)).alias("subjects"), F.sum("events").alias("events")
        ).select(arm, *extra, *kept, *[F.lit(None).cast("string").alias(l) for l in levels[depth:]],
                 F.lit(depth).alias("depth"), "subjects", "events"))
    counted = reduce(DataFrame.unionByName, parts)
    # the arm list is a literal; the term list has one row per term, whatever the number of events
    term = [*extra, *levels, "depth"]
    arm_table = events.sparkSession.createDataFrame([(a,) for a in arms], f"{arm} string")
    grid = counted.select(*term).distinct().crossJoin(F.broadcast(arm_table))
    filled = keyed_join(grid, counted, [arm, *term])
    filled = filled.join(denom.select(arm, "N"), arm, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return filled.select(
        arm, *extra, *levels, "depth", zero("subjects").alias("subjects"), zero("events").alias("events"),
        zero("N").alias("N"), F.try_divide(100.0 * zero("subjects"), F.col("N")).alias("pct"),
    )


def by_frequency(hierarchy: DataFrame, levels: Sequence[str] = ("AESOC", "AEDECOD"), arm: str = "ARM") -> DataFrame:
    """Order a hierarchy for display: classes, then terms within them, by falling subject count over arms."""
    total = hierarchy.groupBy(*levels, "depth").agg(F.sum("subjects").alias("__t"))
    soc, pt = levels
    soc_total = total.filter("depth = 1").select(soc, F.col("__t").alias("__soc"))
    return (
        keyed_join(hierarchy, total, [*levels, "depth"]).join(soc_total, soc, "left")
        .orderBy(F.col("__soc").desc_nulls_first(), F.col(soc), F.col("depth"), F.col("__t").desc(), F.col(pt), F.col(arm))
        .drop("__t", "__soc")
    )


def ard_max_severity(events: DataFrame, denom: DataFrame, arms: Sequence[str], arm: str = "ARM",
                     severity: str = "AESEVN", levels: Sequence[str] = ("AESOC", "AEDECOD")) -> DataFrame:
    """Subjects per term by their greatest severity for it."""
    worst = events.groupBy(arm, *levels, "USUBJID").agg(F.max(severity).alias(severity))
    counts = worst.groupBy(arm, *levels, severity).agg(F.count(F.lit(1)).alias("subjects"))
    return counts.join(denom.select(arm, "N"), arm, "left").withColumn(
        "pct", F.try_divide(100.0 * F.col("subjects"), F.col("N")))


def ard_shift(df: DataFrame, by: Sequence[str], base: str = "BNRIND", post: str = "ANRIND") -> DataFrame:
    """Records per group, baseline category and post-baseline category."""
    return df.groupBy(*by, base, post).agg(F.count(F.lit(1)).alias("n"))


def worst_shift(df: DataFrame, by: Sequence[str], subject: Sequence[str], order: Sequence[str],
                base: str = "BNRIND", post: str = "ANRIND") -> DataFrame:
    """Shift to the worst post-baseline category per subject; ``order`` lists categories, worst last."""
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(post))
    worst = df.filter(F.col(post).isNotNull()).groupBy(*by, *subject).agg(
        F.max(base).alias(base), F.max_by(post, rank).alias(post))
    return ard_shift(worst, by, base, post)


def beyond_range(df: DataFrame, by: Sequence[str], post: str = "ANRIND") -> DataFrame:
    """Normal and abnormal records per group."""
    return df.filter(F.col(post).isNotNull()).groupBy(*by).agg(
        F.count_if(F.col(post) == "NORMAL").alias("normal"), F.count_if(F.col(post) != "NORMAL").alias("abnormal"),
        F.count(F.lit(1)).alias("n"))


def ard_disposition(adsl: DataFrame, arm: str = "ARM") -> DataFrame:
    """Completed, discontinued by reason and ongoing per arm, with percent of the arm."""
    status = F.coalesce(F.col("EOSSTT"), F.lit("ONGOING"))
    counts = adsl.groupBy(arm, status.alias("EOSSTT"), "DCSREAS").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(arm).agg(F.sum("n").alias("N_"))
    return counts.join(total, arm).select(
        arm, "EOSSTT", "DCSREAS", "n", F.col("N_").alias("total"), F.try_divide(100.0 * F.col("n"), F.col("N_")).alias("pct"))


def ard_sites(adsl: DataFrame, arm: str = "ARM", site: str = "SITEGR1") -> DataFrame:
    """Subjects per pooled site and arm."""
    return adsl.groupBy(site, arm).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ITTFL") == "Y").alias("n_itt"))


def mean_over_time(df: DataFrame, arm: str = "ARM", visit: str = "AVISITN", extra: Sequence[str] = ("PARAMCD",),
                   variables: Sequence[str] = ("AVAL", "CHG")) -> DataFrame:
    """Mean profile: N, mean, sd and standard error per parameter, arm and visit."""
    wide = continuous_wide(df, [*extra, arm, visit], variables, {})
    return wide.withColumn("se", F.col("sd") / F.sqrt("N"))


def subject_mean(df: DataFrame, lo: int, hi: int, by: Sequence[str] = ("USUBJID", "PARAMCD"), keep: Sequence[str] = (),
                 visit: str = "AVISITN") -> DataFrame:
    """Mean per subject over the visits from ``lo`` to ``hi``."""
    return df.filter(F.col(visit).between(lo, hi)).groupBy(*by, *keep).agg(
        F.avg("AVAL").alias("AVAL"), F.count("AVAL").alias("n_visits"))


def event_rate(events: DataFrame, exposure: DataFrame, arm: str = "ARM", per: float = 365.25) -> DataFrame:
    """Events over exposure days per arm, per ``per`` days; arms without events count zero."""
    n = events.groupBy(arm).agg(F.count(F.lit(1)).alias("events"))
    days = exposure.groupBy(arm).agg(F.sum("TRTDUR").alias("days"))
    joined = days.join(n, arm, "left").withColumn("events", F.coalesce("events", F.lit(0)))
    return joined.withColumn("rate", F.try_divide(F.col("events") * F.lit(float(per)), F.col("days")))


def ard_geometric(df: DataFrame, by: Sequence[str], value: str = "AVAL") -> DataFrame:
    """Geometric mean, geometric CV in percent, median and range of the positive values."""
    positive = df.filter(F.col(value) > 0)
    log = F.ln(F.col(value))
    moments = positive.groupBy(*by).agg(
        F.count(value).alias("N"), F.exp(F.avg(log)).alias("gmean"),
        (100.0 * F.sqrt(F.exp(F.var_samp(log)) - 1)).alias("gcv"), F.min(value).alias("min"), F.max(value).alias("max"))
    return keyed_join(moments, exact_quantiles(positive, by, value, {"median": 0.5}), by)


def response_counts(df: DataFrame, by: Sequence[str], responder: str | Column) -> DataFrame:
    """Responders (hits) and N per group."""
    hit = F.expr(responder) if isinstance(responder, str) else responder
    return df.groupBy(*by).agg(F.count_if(F.coalesce(hit, F.lit(False))).alias("hits"), F.count(F.lit(1)).alias("N"))


def ard_proportion_ci(counts: DataFrame, method: str = "wilson", level: float = 0.95, n: str = "hits", total: str = "N") -> DataFrame:
    """Rate with a Wilson or exact (Clopper-Pearson) interval on a table of counts."""
    from ..functions import special

    p = F.col(n) / F.col(total)
    if method == "wilson":
        z = float(special.norm_quantile(0.5 + level / 2))
        z2 = F.lit(z * z)
        mid = (p + z2 / (2 * F.col(total))) / (1 + z2 / F.col(total))
        half = F.lit(z) * F.sqrt(p * (1 - p) / F.col(total) + z2 / (4 * F.col(total) * F.col(total))) / (1 + z2 / F.col(total))
        return counts.withColumns({"rate": p, "lower": mid - half, "upper": mid + half})
    exact = special.clopper_pearson_udf(level)
    return counts.withColumn("rate", p).withColumn("__ci", exact(F.col(n).cast("double"), F.col(total).cast("double"))).select(
        "*", F.col("__ci.lower").alias("lower"), F.col("__ci.upper").alias("upper")).drop("__ci")


def ada_status(df: DataFrame, by: Sequence[str] = ("USUBJID",), titre_fold: float = 4.0, persist_days: int = 112) -> DataFrame:
    """Anti-drug antibody status per subject.

    ``df`` has ADT, TRTSDT, RESULT (POSITIVE or NEGATIVE) and TITRE. Treatment-emergent:
    positive after a negative or missing baseline, or a titre at least ``titre_fold``
    times baseline. Persistent: emergent, positive dates at least ``persist_days`` apart
    or the last result positive; else transient.
    """
    pos, pre = F.col("RESULT") == "POSITIVE", F.col("ADT") <= F.col("TRTSDT")
    post_pos = pos & ~pre
    facts = df.groupBy(*by).agg(
        F.coalesce(F.bool_or(pos & pre), F.lit(False)).alias("base_pos"),
        F.max(F.when(pos & pre, F.col("TITRE"))).alias("base_titre"),
        F.coalesce(F.bool_or(post_pos), F.lit(False)).alias("post_pos"),
        F.max(F.when(post_pos, F.col("TITRE"))).alias("max_titre"),
        F.min(F.when(post_pos, F.col("ADT"))).alias("first_pos"),
        F.max(F.when(post_pos, F.col("ADT"))).alias("last_pos"),
        F.max(F.when(~pre, F.col("ADT"))).alias("last_test"),
    )
    boosted = F.col("base_pos") & (F.col("max_titre") >= titre_fold * F.col("base_titre"))
    emergent = F.coalesce(F.col("post_pos") & (~F.col("base_pos") | boosted), F.lit(False))
    persistent = (F.datediff("last_pos", "first_pos") >= persist_days) | (F.col("last_pos") == F.col("last_test"))
    yn = lambda c: F.when(F.coalesce(c, F.lit(False)), "Y").otherwise("N")
    return facts.select(
        *by, yn(F.col("base_pos")).alias("BASEPOS"), yn(emergent).alias("TEADA"),
        yn(emergent & persistent).alias("PERSIST"), yn(emergent & ~F.coalesce(persistent, F.lit(False))).alias("TRANSIENT"),
        F.col("max_titre").alias("MAXTITRE"))


def ada_summary(status: DataFrame, by: Sequence[str] = ("ARM",)) -> DataFrame:
    """Tested subjects and those of each anti-drug antibody status per group, with percent of the tested."""
    flags = {"baseline_positive": "BASEPOS", "treatment_emergent": "TEADA", "persistent": "PERSIST", "transient": "TRANSIENT"}
    wide = status.groupBy(*by).agg(F.count(F.lit(1)).alias("N"), *[F.count_if(F.col(f) == "Y").alias(n) for n, f in flags.items()])
    long = wide.unpivot([*by, "N"], list(flags), "status", "hits")
    return long.withColumn("pct", F.try_divide(100.0 * F.col("hits"), F.col("N")))


def ada_titres(status: DataFrame, by: Sequence[str] = ("ARM",)) -> DataFrame:
    """Greatest titre after baseline among subjects with emergent antibodies: N, geometric mean, CV, median and range per group."""
    return ard_geometric(status.filter("TEADA = 'Y'"), by, "MAXTITRE")


def nab_incidence(status: DataFrame, results: DataFrame, by: Sequence[str] = ("ARM",), subject: str = "USUBJID") -> DataFrame:
    """Neutralising antibodies among ADA-positive subjects (at baseline or emergent): positive at any time after baseline.

    ``results`` has ADT, TRTSDT and NABRES (POSITIVE, NEGATIVE or null); a positive subject without a result counts as not tested.
    """
    after = F.col("ADT") > F.col("TRTSDT")
    per_subject = results.groupBy(subject).agg(
        F.coalesce(F.bool_or(after & (F.col("NABRES") == "POSITIVE")), F.lit(False)).alias("__pos"),
        F.coalesce(F.bool_or(after & F.col("NABRES").isNotNull()), F.lit(False)).alias("__tested"))
    positive = keyed_join(status.filter("BASEPOS = 'Y' OR TEADA = 'Y'"), per_subject, [subject])
    out = positive.groupBy(*by).agg(F.count(F.lit(1)).alias("ada_positive"), F.count_if("__tested").alias("tested"), F.count_if("__pos").alias("nab_positive"))
    return out.withColumn("pct", F.try_divide(100.0 * F.col("nab_positive"), F.col("ada_positive")))


def responder_flag(df: DataFrame, threshold: float, direction: str = "decrease") -> DataFrame:
    """RESPFL from change against a meaningful-change threshold."""
    hit = F.col("CHG") <= -threshold if direction == "decrease" else F.col("CHG") >= threshold
    return df.withColumn("RESPFL", F.when(F.col("CHG").isNull(), F.lit(None)).when(hit, "Y").otherwise("N"))


def completion_rate(df: DataFrame, adsl: DataFrame, visits: DataFrame, arm: str = "ARM") -> DataFrame:
    """Completed over expected questionnaires per arm and visit."""
    done = df.select(arm, "USUBJID", "AVISITN").distinct().groupBy(arm, "AVISITN").agg(F.count(F.lit(1)).alias("completed"))
    expected = adsl.groupBy(arm).agg(F.count(F.lit(1)).alias("expected"))
    grid = expected.crossJoin(visits.select("AVISITN"))
    out = grid.join(done, [arm, "AVISITN"], "left").withColumn("completed", F.coalesce("completed", F.lit(0)))
    return out.withColumn("rate", F.try_divide(100.0 * F.col("completed"), F.col("expected")))


def best_pct_change(df: DataFrame, by: Sequence[str] = ("USUBJID",), keep: Sequence[str] = ("ARM",)) -> DataFrame:
    """Waterfall data: least percent change from baseline per subject; order by BESTPCHG to draw."""
    pct = F.try_divide(100.0 * (F.col("AVAL") - F.col("BASE")), F.col("BASE"))
    return df.withColumn("__p", pct).filter(F.col("__p").isNotNull()).groupBy(*by, *keep).agg(F.min("__p").alias("BESTPCHG"))


def pct_change_over_time(df: DataFrame, by: Sequence[str] = ("USUBJID",), keep: Sequence[str] = ("ARM",)) -> DataFrame:
    """Spider data: percent change per subject and day."""
    return df.select(*by, *keep, "ADY", F.try_divide(100.0 * (F.col("AVAL") - F.col("BASE")), F.col("BASE")).alias("PCHG"))


def swimmer(tte: DataFrame, by: Sequence[str] = ("USUBJID",)) -> DataFrame:
    """Swimmer data: length of each bar and whether it ends in an event."""
    return tte.select(*by, "ARM", F.col("AVAL").alias("DAYS"), (F.col("CNSR") == 0).alias("EVENT"))


def by_subgroup(fn: Callable[[DataFrame, list[str]], DataFrame], df: DataFrame, subgroup: str, by: Sequence[str]) -> DataFrame:
    """Repeat an analysis per subgroup level in one pass by widening its grouping."""
    return fn(df, [*by, subgroup])
