"""Survival estimates and tests from the table of distinct times.

Records are first reduced to events and censorings per group and distinct time.
That table may be as long as the input, as times need not be whole days: it is cut
into ranges of time, and at-risk counts, survival and the sums of the models are
scans over ranges (``running_sums``), so that no task holds a group or a stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import special
from .groups import in_ranges, keyed_join, prefix_counts, running_sums


def _risk_in_ranges(df: DataFrame, by: Sequence[str], time: str, cnsr: str) -> DataFrame:
    table = df.filter(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("t")).agg(
        F.count_if(F.col(cnsr) == 0).alias("d"), F.count_if(F.col(cnsr) != 0).alias("c"))
    return running_sums(in_ranges(table, by, "t"), by, "t", {"at_risk": F.col("d") + F.col("c")}, later=True)


def risk_table(df: DataFrame, by: Sequence[str] = ("ARM",), time: str = "AVAL", cnsr: str = "CNSR") -> DataFrame:
    """Per group and distinct time: events d, censored c and number at risk."""
    return _risk_in_ranges(df, by, time, cnsr).drop("__part")


def kaplan_meier(df: DataFrame, by: Sequence[str] = ("ARM",), time: str = "AVAL", cnsr: str = "CNSR",
                 level: float = 0.95) -> DataFrame:
    """Risk table with survival, Greenwood standard error and log-transformed confidence limits.

    Survival is a running product, taken as a running sum of logs; a time at which all at risk have the event
    takes it to zero for good.
    """
    z = float(special.norm_quantile(0.5 + level / 2))
    d, n = F.col("d").cast("double"), F.col("at_risk").cast("double")
    out = running_sums(_risk_in_ranges(df, by, time, cnsr), by, "t", {
        "__dead": F.when(d == n, 1).otherwise(0),
        "__log": F.when(d < n, F.ln(1 - d / n)).otherwise(0.0),
        "__v": F.when(d < n, d / (n * (n - d))).otherwise(0.0),
    })
    alive = F.col("__dead") == 0
    spread = F.exp(z * F.sqrt("__green"))
    return out.withColumns({
        "survival": F.when(alive, F.exp("__log")).otherwise(0.0), "__green": F.when(alive, F.col("__v")),
    }).withColumns({
        "se": F.col("survival") * F.sqrt("__green"),
        "lower": F.col("survival") / spread,
        "upper": F.when(F.col("__green").isNotNull(), F.least(F.lit(1.0), F.col("survival") * spread)),
    }).drop("__part", "__dead", "__log", "__v", "__green")


def km_summary(km: DataFrame, by: Sequence[str] = ("ARM",)) -> DataFrame:
    """Subjects, events, censored and median survival with its limits.

    The median is the first time with survival at or below one half; where survival
    stays at exactly one half for a while the middle of that stretch is taken.
    """
    tol = 1e-9
    first = lambda col, strict=False: F.min(F.when(
        (F.col("d") > 0) & ((F.col(col) < 0.5 - tol) if strict else (F.col(col) <= 0.5 + tol)), F.col("t")))
    facts = km.groupBy(*by).agg(
        (F.sum("d") + F.sum("c")).alias("subjects"), F.sum("d").alias("events"), F.sum("c").alias("censored"),
        first("survival").alias("__lo"), first("survival", True).alias("__hi"),
        F.min(F.when((F.col("d") > 0) & F.abs(F.col("survival") - 0.5).__le__(tol), F.col("t"))).alias("__flat"),
        first("lower").alias("median_lower"), first("upper").alias("median_upper"))
    middle = (F.col("__lo") + F.coalesce("__hi", "__lo")) / 2.0
    median = F.when(F.col("__flat").isNotNull(), middle).otherwise(F.col("__lo").cast("double"))
    return facts.withColumn("median", median).drop("__lo", "__hi", "__flat")


def km_landmarks(km: DataFrame, times: Sequence[float], by: Sequence[str] = ("ARM",)) -> DataFrame:
    """Survival and number at risk at given times."""
    def at(t: float) -> Column:
        past, future = F.col("t") <= t, F.col("t") >= t
        return F.struct(
            F.lit(float(t)).alias("time"),
            F.coalesce(F.max_by(F.when(past, F.col("survival")), F.when(past, F.col("t"))), F.lit(1.0)).alias("survival"),
            F.coalesce(F.max(F.when(future, F.col("at_risk"))), F.lit(0)).alias("at_risk"))

    wide = km.groupBy(*by).agg(F.array(*[at(t) for t in times]).alias("__p"))
    return wide.select(*by, F.explode("__p").alias("__x")).select(*by, "__x.*")


def km_points(km: DataFrame, by: Sequence[str] = ("ARM",)) -> DataFrame:
    """Step points for plotting, starting at time 0, with a mark where records are censored."""
    start = km.groupBy(*by).agg(F.max("at_risk").alias("at_risk")).select(
        *by, F.lit(0.0).alias("time"), F.lit(1.0).alias("survival"), F.lit(False).alias("censor_mark"), "at_risk")
    return start.unionByName(km.select(
        *by, F.col("t").cast("double").alias("time"), "survival", (F.col("c") > 0).alias("censor_mark"), "at_risk"))


def _event_times(df: DataFrame, group: str, levels: Sequence[str], strata: Sequence[str], time: str, cnsr: str) -> DataFrame:
    """One row per stratum and event time with deaths and numbers at risk of every group, in level order.

    A group's last censoring may lie before an event of another, so the at-risk
    counts come from one scan over the common time axis.
    """
    ev = lambda l: F.count_if((F.col(group) == l) & (F.col(cnsr) == 0))
    al = lambda l: F.count_if(F.col(group) == l)
    axis = df.filter(F.col(group).isin(*levels) & F.col(time).isNotNull()).withColumn("__all", F.lit(1)).groupBy(
        *strata, "__all", F.col(time).alias("t")).agg(
        *[ev(l).alias(f"d{i}") for i, l in enumerate(levels)], *[al(l).alias(f"m{i}") for i, l in enumerate(levels)])
    keys = [*strata, "__all"]
    return running_sums(in_ranges(axis, keys, "t"), keys, "t", {f"n{i}": F.col(f"m{i}") for i in range(len(levels))}, later=True).drop(
        "__part", "__all", *[f"m{i}" for i in range(len(levels))])


def logrank(df: DataFrame, group: str, levels: Sequence[str], strata: Sequence[str] = (), time: str = "AVAL",
            cnsr: str = "CNSR") -> DataFrame:
    """Log-rank test of two or more groups, optionally stratified: observed, expected, statistic, p."""
    k = len(levels)
    tab = _event_times(df, group, levels, strata, time, cnsr)
    total = lambda p: sum((F.col(f"{p}{i}") for i in range(1, k)), F.col(f"{p}0"))
    d, n = total("d").cast("double"), total("n").cast("double")
    hyper = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(0.0)
    share = [F.col(f"n{i}") / n for i in range(k)]
    pairs = [(i, j) for i in range(k - 1) for j in range(i, k - 1)]
    sums = tab.filter(d > 0).agg(
        F.array(*[F.sum(f"d{i}").cast("double") for i in range(k)]).alias("obs"),
        F.array(*[F.sum(d * share[i]) for i in range(k)]).alias("exp"),
        F.array(*[F.sum(hyper * share[i] * ((1.0 if i == j else 0.0) - share[j])) for i, j in pairs]).alias("var"))

    @F.pandas_udf("statistic double, df double, p double")
    def solve(obs: pd.Series, exp: pd.Series, var: pd.Series) -> pd.DataFrame:
        rows = []
        for o, e, v in zip(obs, exp, var):
            m = np.zeros((k - 1, k - 1))
            for (i, j), x in zip(pairs, v):
                m[i, j] = m[j, i] = np.nan if x is None else x
            u = np.asarray(o, float)[:-1] - np.asarray(e, float)[:-1]
            ok = bool(np.isfinite(m).all() and m.any())
            rank = int(np.linalg.matrix_rank(m, hermitian=True)) if ok else 0
            stat = float(u @ np.linalg.pinv(m, hermitian=True) @ u) if rank else np.nan
            rows.append((stat, float(rank), float(special.chi2_sf(stat, rank)) if rank else np.nan))
        return pd.DataFrame(rows, columns=["statistic", "df", "p"])

    return sums.withColumn("__r", solve("obs", "exp", "var")).select(
        "__r.*", *[F.col("obs")[i].alias(f"observed_{i}") for i in range(k)],
        *[F.col("exp")[i].alias(f"expected_{i}") for i in range(k)])


#: So many of the smallest terms are added one by one; the others lie far enough from zero for the expansion below.
_NEAR = 24


def falling_sums(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of log u, 1/u and 1/u^2 over u = x, x - 1, ... (n terms, the last one 1 or more).

    The integral between the half steps around the terms and two corrections (Euler and Maclaurin); sums of logs are
    written without differences of large numbers.
    """
    x, n = np.asarray(x, float), np.asarray(n, float)
    low = x - n + 1
    log = one = two = np.zeros_like(x)
    for k in range(_NEAR):
        u = np.where(k < n, low + k, np.nan)
        log, one, two = (a + np.nan_to_num(b) for a, b in zip((log, one, two), (np.log(u), 1 / u, 1 / u**2)))
    r = np.maximum(n - _NEAR, 0.0)
    p, q = np.where(r > 0, low + _NEAR - 0.5, 1.0), np.where(r > 0, x + 0.5, 1.0)
    gap = np.log1p(r / p)
    diff = lambda k: q ** -float(k) - p ** -float(k)
    a, b = -1 / 24, 7 / 5760
    return (log + r * np.log(p) + q * gap - r + a * diff(1) + 2 * b * diff(3),
            one + gap - a * diff(2) - 6 * b * diff(4),
            two + r / (p * q) - 2 * a * diff(3) - 24 * b * diff(5))


def tie_sums(efron: bool):
    """Sums over the d tied events of log m, 1/m and 1/m^2, with m = risk - l/d * tied for l < d (Efron) or m = risk (Breslow)."""
    @F.pandas_udf("total double, one double, two double")
    def sums(risk: pd.Series, tied: pd.Series, d: pd.Series) -> pd.DataFrame:
        r, n = risk.to_numpy(float), d.to_numpy(float)
        if not efron:
            return pd.DataFrame({"total": n * np.log(r), "one": n / r, "two": n / r**2})
        step = tied.to_numpy(float) / n  # m falls by this from one event to the next
        log, one, two = falling_sums(np.maximum(r / step, n), n)
        return pd.DataFrame({"total": n * np.log(step) + log, "one": one / step, "two": two / step**2})

    return sums


def cox(df: DataFrame, covariates: dict[str, Column], time: str = "AVAL", cnsr: str = "CNSR", strata: Sequence[str] = (),
        ties: str = "efron", max_iter: int = 25, tol: float = 1e-9, level: float = 0.95) -> DataFrame:
    """Proportional hazards: log hazard ratio, SE, hazard ratio with limits and p per covariate.

    ``covariates`` maps a name to a numeric Column. Records with equal time, status
    and covariates are counted together first and cut into ranges of time once. Each Newton step
    is one aggregate to sums per distinct time, a scan over the ranges, and one aggregate to the
    score and information; only those last k + k*k numbers come to the driver, which
    takes the next step. Ties after Efron or Breslow. Nulls if ``max_iter`` steps are not enough.
    """
    names = list(covariates)
    k = len(names)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = df.select(*strata, F.col(time).alias("t"), (F.col(cnsr) == 0).cast("double").alias("e"),
                     *[covariates[n].cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    rows = rows.dropna(subset=["t", "e", *[f"x{i}" for i in range(k)]])
    head = rows.agg(*[F.avg(f"x{i}") for i in range(k)], F.sum("e").alias("events")).first()
    centre = [head[i] or 0.0 for i in range(k)]
    packed = rows.groupBy(*strata, "t", "e", *[f"x{i}" for i in range(k)]).agg(F.count(F.lit(1)).cast("double").alias("w"))
    packed = packed.select(*strata, F.lit(1).alias("__all"), "t", "e", "w", *[(F.col(f"x{i}") - centre[i]).alias(f"x{i}") for i in range(k)])
    keys = [*strata, "__all"]
    packed = in_ranges(packed, keys, "t")  # all rows of one time lie in one range
    tied = tie_sums(ties == "efron")

    def step(beta):
        eta = F.lit(0.0)
        for i in range(k):
            eta = eta + float(beta[i]) * F.col(f"x{i}")
        r = F.col("w") * F.exp(eta)
        moment = {"s0": r, **{f"s1_{i}": r * F.col(f"x{i}") for i in range(k)},
                  **{f"s2_{i}_{j}": r * F.col(f"x{i}") * F.col(f"x{j}") for i, j in pairs}}
        aggs = [F.sum(F.col("w") * F.col("e")).alias("d"), F.sum(F.col("w") * F.col("e") * eta).alias("deta")]
        aggs += [F.sum(F.col("w") * F.col("e") * F.col(f"x{i}")).alias(f"dx_{i}") for i in range(k)]
        aggs += [F.sum(c).alias(n) for n, c in moment.items()]
        aggs += [F.sum(c * F.col("e")).alias(f"e_{n}") for n, c in moment.items()]
        axis = packed.groupBy(*keys, "__part", "t").agg(*aggs)
        axis = running_sums(axis, keys, "t", {f"r_{n}": F.col(n) for n in moment}, later=True).filter(F.col("d") > 0)
        # Efron: the l-th of d tied events sees the risk set less l/d of the tied ones. Every term is a ratio of two
        # functions linear in l/d, so its sum over l needs the sums of log m, 1/m and 1/m^2 of the denominator m only.
        axis = axis.withColumn("__t", tied("r_s0", "e_s0", "d"))
        total, one, two = F.col("__t.total"), F.col("__t.one"), F.col("__t.two")
        if ties == "efron":
            at = lambda n: F.col(f"e_{n}") / F.col("e_s0")
            off = lambda n: F.col(f"r_{n}") - F.col("r_s0") * at(n)
        else:
            at, off = (lambda n: F.lit(0.0)), (lambda n: F.col(f"r_{n}"))
        mean = lambda n: F.col("d") * at(n) + off(n) * one
        both = lambda a, b: F.col("d") * at(a) * at(b) + (at(a) * off(b) + at(b) * off(a)) * one + off(a) * off(b) * two
        out = axis.agg(
            (F.sum("deta") - F.sum(total)).alias("ll"),
            *[(F.sum(f"dx_{i}") - F.sum(mean(f"s1_{i}"))).alias(f"u{i}") for i in range(k)],
            *[F.sum(mean(f"s2_{i}_{j}") - both(f"s1_{i}", f"s1_{j}")).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        u = np.array([out[f"u{i}"] or 0.0 for i in range(k)])
        h = np.zeros((k, k))
        for i, j in pairs:
            h[i, j] = h[j, i] = out[f"h{i}_{j}"] or 0.0
        return out["ll"] or 0.0, u, h

    beta, last, settled = np.zeros(k), -np.inf, False
    ll, u, h = step(beta)
    for _ in range(max_iter):
        delta = np.linalg.pinv(h, hermitian=True) @ u
        scale = 1.0
        while True:  # halve a step that lowers the likelihood
            trial = beta + scale * delta
            got = step(trial)
            if got[0] >= ll - 1e-9 * (abs(ll) + 1) or scale < 1e-4:
                break
            scale /= 2
        last, (ll, u, h), beta = ll, got, trial
        settled = abs(ll - last) <= tol * (abs(ll) + 1e-12)
        if settled:
            break
    se = np.sqrt(np.diag(np.linalg.pinv(h, hermitian=True)))
    z = special.norm_quantile(0.5 + level / 2)
    out = []
    for i, n in enumerate(names):
        if not settled:
            out.append((n,) + (None,) * 6)
            continue
        b, s = float(beta[i]), float(se[i])
        out.append((n, b, s, float(np.exp(b)), float(np.exp(b - z * s)), float(np.exp(b + z * s)),
                    float(2 * special.norm_sf(abs(b / s))) if s > 0 else None))
    return df.sparkSession.createDataFrame(
        out, "term string, estimate double, se double, hazard_ratio double, lower double, upper double, p double")


def wilcoxon(df: DataFrame, group: str, levels: Sequence[str], value: str = "AVAL", by: Sequence[str] = (),
             continuity: bool = False) -> DataFrame:
    """Rank-sum test of two groups: rank sum of the first, tie-corrected z and two-sided p.

    Mid-ranks come from counts per distinct value and two-level prefix sums, so no
    task sorts all records.
    """
    a, b = levels
    sub = df.filter(F.col(group).isin(a, b) & F.col(value).isNotNull())
    keys = [*by, "__all"]
    counts = sub.withColumn("__all", F.lit(1)).groupBy(*keys, value).agg(
        F.count_if(F.col(group) == a).alias("na"), F.count(F.lit(1)).alias("m"))
    ranked = prefix_counts(in_ranges(counts, keys, value), keys, value, "m")
    mid = F.col("below") + (F.col("m") + 1) / 2.0
    m = F.col("m").cast("double")
    sums = ranked.groupBy(*by).agg(
        F.sum("na").alias("n1"), F.max("total").alias("n"), F.sum(F.col("na") * mid).alias("rank_sum"),
        F.sum(m * m * m - m).alias("__ties"))
    n1, n = F.col("n1").cast("double"), F.col("n").cast("double")
    n2 = n - n1
    var = n1 * n2 / 12.0 * (n + 1 - F.col("__ties") / (n * (n - 1)))
    dev = F.col("rank_sum") - n1 * (n + 1) / 2.0
    if continuity:
        dev = F.signum(dev) * F.greatest(F.abs(dev) - 0.5, F.lit(0.0))
    tail = special.tail_udf("z")
    return sums.withColumn("z", F.try_divide(dev, F.sqrt(var))).withColumn(
        "p", tail("z", F.lit(0.0), F.lit(0.0))).select(*by, "n1", (F.col("n") - F.col("n1")).alias("n2"), "rank_sum", "z", "p")
