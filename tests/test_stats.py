import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortsmith.functions import special as sp
from cohortsmith.operators import ard, glm, mmrm, models as md, survival as sv

ARMS = ["P", "L", "H"]


def test_special_functions():
    assert sp.norm_quantile(0.975) == pytest.approx(1.959963984540054, abs=1e-10)
    assert float(sp.t_sf2(2.228138852, 10)) == pytest.approx(0.05, abs=1e-8)
    assert sp.t_quantile(0.975, 10) == pytest.approx(2.228138852, abs=1e-8)
    assert float(sp.chi2_sf(3.841458821, 1)) == pytest.approx(0.05, abs=1e-9)
    assert float(sp.chi2_sf(18.307038053, 10)) == pytest.approx(0.05, abs=1e-9)
    assert float(sp.f_sf(4.102821015, 2, 10)) == pytest.approx(0.05, abs=1e-8)
    lo, hi = sp.clopper_pearson(4, 20)
    assert (lo, hi) == (pytest.approx(0.0573340, abs=1e-6), pytest.approx(0.4366140, abs=1e-6))
    assert sp.clopper_pearson(0, 10)[0] == 0.0 and sp.clopper_pearson(10, 10)[1] == 1.0
    assert sp.hypergeom_two_sided(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert sp.hypergeom_two_sided(1, 9, 11, 3) == pytest.approx(0.0027594561852, abs=1e-10)


@pytest.fixture(scope="module")
def trial(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(120):
        arm, site, base = ARMS[i % 3], "abcd"[(i // 3) % 4], float(rng.normal(1e4, 10))
        rows.append((i, arm, site, {"P": 0, "L": 54, "H": 81}[arm], base, float(0.3 * (base - 1e4) + (i % 3) + "abcd".index(site) + rng.normal())))
    return rows, spark.createDataFrame(rows, "id int, ARM string, SITE string, DOSE int, BASE double, CHG double")


def test_ancova_equals_least_squares(trial):
    rows, df = trial
    sites = "abcd"
    x = np.array([[1, r[1] == "L", r[1] == "H", *[r[2] == s for s in sites[1:]], r[4] - 1e4] for r in rows], float)
    y = np.array([r[5] for r in rows])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    inv, df_ = np.linalg.inv(x.T @ x), len(y) - x.shape[1]
    s2 = float(((y - x @ beta) ** 2).sum() / df_)
    got = {(r["kind"], r["term"]): r for r in md.ancova(df, "CHG", "ARM", ARMS, {"SITE": list(sites)}).collect()}
    assert got["residual", "variance"]["estimate"] == pytest.approx(s2)
    xbar = x.mean(0)
    for i, a in enumerate(ARMS):
        l = np.array([1, a == "L", a == "H", 0.25, 0.25, 0.25, xbar[-1]], float)
        assert got["lsmean", a]["estimate"] == pytest.approx(l @ beta, abs=1e-7)
        assert got["lsmean", a]["se"] == pytest.approx(math.sqrt(s2 * l @ inv @ l))
    c = got["contrast", "H - L"]
    l = np.array([0, -1, 1, 0, 0, 0, 0], float)
    assert c["estimate"] == pytest.approx(l @ beta, abs=1e-7) and c["df"] == df_
    assert c["p"] == pytest.approx(float(sp.t_sf2(c["estimate"] / c["se"], df_)))
    assert c["lower"] < c["estimate"] < c["upper"]
    # term F against the drop of the two arm columns
    rest = np.delete(x, [1, 2], 1)
    b2, *_ = np.linalg.lstsq(rest, y, rcond=None)
    f = (((y - rest @ b2) ** 2).sum() - s2 * df_) / 2 / s2
    assert got["type3", "ARM"]["statistic"] == pytest.approx(f)
    back = {r["term"]: r["estimate"] for r in md.ancova(df, "CHG", "ARM", ARMS, {"SITE": list(sites)}, contrasts={"a": [-1, 1, 0], "b": [1, -1, 0]}).filter("kind = 'contrast'").collect()}
    assert back["a"] == pytest.approx(-back["b"])


def test_rank_deficient_design(trial):
    _, df = trial
    copy = df.withColumn("B2", F.col("BASE") * 2)
    got = {(r["kind"], r["term"]): r for r in md.ancova(copy, "CHG", "ARM", ARMS, covariates=["BASE", "B2"]).collect()}
    one = {(r["kind"], r["term"]): r for r in md.ancova(df, "CHG", "ARM", ARMS).collect()}
    assert got["residual", "rank"]["estimate"] == 4
    assert got["contrast", "H - P"]["estimate"] == pytest.approx(one["contrast", "H - P"]["estimate"])


def test_dose_response_and_anova(trial):
    rows, df = trial
    slope = md.dose_response(df, "CHG", "DOSE").first()
    x = np.array([[1, r[3], r[4] - 1e4] for r in rows], float)
    y = np.array([r[5] for r in rows])
    assert slope["estimate"] == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0][1])
    f = md.anova(df, "CHG", "ARM", ARMS).filter("kind = 'type3'").first()
    groups = [y[[r[1] == a for r in rows]] for a in ARMS]
    ssb = sum(len(g) * (g.mean() - y.mean()) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    assert f["statistic"] == pytest.approx(ssb / 2 / (ssw / 117))


def test_contingency_tests(spark):
    rows = [("t", "y")] * 3 + [("t", "n")] + [("c", "y")] + [("c", "n")] * 3
    df = spark.createDataFrame(rows, "r string, c string")
    assert md.fisher2x2(df, "r", ["t", "c"], "c", ["y", "n"]).first()["p"] == pytest.approx(0.4857142857)
    chi = md.chisq(df, "r", "c").first()
    assert chi["statistic"] == pytest.approx(2.0) and chi["df"] == 1 and chi["p"] == pytest.approx(0.1572992, abs=1e-6)
    one = md.cmh(df, "r", ["t", "c"], "c", ["y", "n"]).first()
    assert one["statistic"] == pytest.approx(2.0 * 7 / 8)  # (n-1)/n of Pearson's
    strat = df.withColumn("s", F.lit("1")).unionByName(df.withColumn("s", F.lit("2"))).unionByName(spark.createDataFrame([("t", "y", "solo")], "r string, c string, s string"))
    two = md.cmh(strat, "r", ["t", "c"], "c", ["y", "n"], ["s"]).first()
    assert two["statistic"] == pytest.approx(2 * 2.0 * 7 / 8)
    empty = md.cmh(spark.createDataFrame([("t", "y", "1"), ("t", "n", "1")], "r string, c string, s string"), "r", ["t", "c"], "c", ["y", "n"], ["s"]).first()
    assert empty["df"] == 0
    kinds = {k: md.cmh(df, "r", ["t", "c"], "c", ["y", "n"], kind=k).first()["statistic"] for k in ("general", "row_mean", "correlation")}
    assert kinds["row_mean"] == pytest.approx(kinds["general"]) and kinds["correlation"] == pytest.approx(kinds["general"])


# remission times in weeks, 6-MP and placebo arms of a classic leukaemia trial (published data)
TREATED = [(6, 0), (6, 0), (6, 0), (6, 1), (7, 0), (9, 1), (10, 0), (10, 1), (11, 1), (13, 0), (16, 0), (17, 1), (19, 1), (20, 1), (22, 0), (23, 0), (25, 1), (32, 1), (32, 1), (34, 1), (35, 1)]
CONTROL = [1, 1, 2, 2, 3, 4, 4, 5, 5, 8, 8, 8, 8, 11, 11, 12, 12, 15, 17, 22, 23]


@pytest.fixture(scope="module")
def remission(spark):
    rows = [("T", t, c) for t, c in TREATED] + [("C", t, 0) for t in CONTROL]
    return spark.createDataFrame(rows, "ARM string, AVAL int, CNSR int")


def test_kaplan_meier_published(remission):
    km = sv.kaplan_meier(remission)
    got = {(r["ARM"], r["t"]): r for r in km.collect()}
    assert got["T", 6]["survival"] == pytest.approx(0.857, abs=1e-3) and got["T", 23]["survival"] == pytest.approx(0.448, abs=1e-3)
    assert got["T", 6]["se"] == pytest.approx(0.0764, abs=1e-4) and got["C", 23]["survival"] == 0.0
    med = {r["ARM"]: (r["median"], r["events"], r["censored"]) for r in sv.km_summary(km).collect()}
    assert med == {"T": (23.0, 9, 12), "C": (8.0, 21, 0)}
    at = {(r["ARM"], r["time"]): (r["survival"], r["at_risk"]) for r in sv.km_landmarks(km, [10]).collect()}
    assert at["T", 10.0][0] == pytest.approx(0.753, abs=1e-3) and at["T", 10.0][1] == 15
    for arm in "TC":
        s = [got[k]["survival"] for k in sorted(got) if k[0] == arm]
        assert all(a >= b for a, b in zip(s, s[1:]))


def test_logrank_published(remission):
    r = sv.logrank(remission, "ARM", ["T", "C"]).first()
    assert r["statistic"] == pytest.approx(16.79, abs=0.01) and r["p"] < 1e-4
    assert r["expected_0"] == pytest.approx(19.25, abs=0.01)


def test_cox_published(remission):
    x = {"C": F.when(F.col("ARM") == "C", 1.0).otherwise(0.0)}
    efron = sv.cox(remission, x).first()
    assert efron["estimate"] == pytest.approx(1.5721, abs=1e-4) and efron["se"] == pytest.approx(0.4124, abs=1e-4)
    breslow = sv.cox(remission, x, ties="breslow").first()
    assert breslow["estimate"] == pytest.approx(1.5092, abs=1e-4)


def plain_survival(rows):
    """(t, c) rows of one arm: at risk, survival and Greenwood's sum per distinct time."""
    t = np.array([r[0] for r in rows])
    e = np.array([r[1] for r in rows]) == 0
    times, place = np.unique(t, return_inverse=True)
    d, m = np.bincount(place, e, len(times)), np.bincount(place, minlength=len(times))
    n = np.cumsum(m[::-1])[::-1]
    return times, n, np.cumprod(1 - d / n), np.cumsum(d / np.maximum(n * (n - d), 1e-300))


def test_survival_on_a_long_fractional_axis(spark):
    """A million distinct times in one arm: equal to a plain version, and no range holds the arm."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("A").alias("ARM"), (F.pmod(F.col("id") * 7919, F.lit(n)) + 0.25).alias("AVAL"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("CNSR"))
    km = sv.kaplan_meier(df).toPandas().sort_values("t")
    i = np.arange(n)
    times, at_risk, s, v = plain_survival(np.column_stack((i * 7919 % n + 0.25, np.where(i % 3 == 0, 1, 0))))
    assert (km.t.to_numpy() == times).all() and (km.at_risk.to_numpy() == at_risk).all()
    assert np.allclose(km.survival, s, rtol=1e-9) and np.allclose(km.se[:-1], s[:-1] * np.sqrt(v[:-1]), rtol=1e-8)
    ranges = sv._risk_in_ranges(df, ["ARM"], "AVAL", "CNSR").groupBy("__part").count().toPandas()["count"]
    assert ranges.sum() == n and ranges.max() < n / 2


def test_models_on_fractional_times(spark):
    """Log-rank and Cox with ties, strata and empty strata against plain sums over events."""
    rng = np.random.default_rng(3)
    n = 600
    arm, stratum, x = rng.integers(0, 3, n), rng.integers(0, 2, n), rng.normal(size=n).round(1)
    t, c = (rng.exponential(10 / (1 + arm), n)).round(1) + 0.05, (rng.random(n) < 0.3).astype(int)
    df = spark.createDataFrame([(f"a{a}", int(s), float(v), float(u), int(k)) for a, s, v, u, k in zip(arm, stratum, x, t, c)], "ARM string, S int, X double, AVAL double, CNSR int")
    u, var = np.zeros(3), np.zeros((3, 3))
    for s in (0, 1):
        for time in np.unique(t[(stratum == s) & (c == 0)]):
            risk = (stratum == s) & (t >= time)
            dead = risk & (t == time) & (c == 0)
            share, d, m = np.bincount(arm[risk], minlength=3) / risk.sum(), dead.sum(), risk.sum()
            u += np.bincount(arm[dead], minlength=3) - d * share
            if m > 1:
                var += d * (m - d) / (m - 1) * (np.diag(share) - np.outer(share, share))
    want = u[:2] @ np.linalg.solve(var[:2, :2], u[:2])
    got = sv.logrank(df, "ARM", ["a0", "a1", "a2"], ["S"]).first()
    assert got["statistic"] == pytest.approx(want, rel=1e-9) and got["df"] == 2 and got["p"] == pytest.approx(math.exp(-want / 2), rel=1e-6)
    z = np.column_stack([(arm == 1).astype(float), (arm == 2).astype(float), x])

    def score(beta):
        g, h = np.zeros(3), np.zeros((3, 3))
        for s in (0, 1):
            for time in np.unique(t[(stratum == s) & (c == 0)]):
                risk, dead = (stratum == s) & (t >= time), (stratum == s) & (t == time) & (c == 0)
                d = dead.sum()
                for l in range(d):
                    w = np.exp(z @ beta) * (risk - l / d * dead)
                    mean = w @ z / w.sum()
                    g += z[dead].mean(0) - mean
                    h += (z * w[:, None]).T @ z / w.sum() - np.outer(mean, mean)
        return g, h

    beta = np.zeros(3)
    for _ in range(8):
        g, h = score(beta)
        beta = beta + np.linalg.solve(h, g)
    se = np.sqrt(np.diag(np.linalg.inv(score(beta)[1])))
    fit = sv.cox(df, {"a1": F.when(F.col("ARM") == "a1", 1.0).otherwise(0.0), "a2": F.when(F.col("ARM") == "a2", 1.0).otherwise(0.0), "x": F.col("X")}, strata=["S"]).collect()
    assert [r["estimate"] for r in fit] == pytest.approx(beta.tolist(), rel=1e-6) and [r["se"] for r in fit] == pytest.approx(se.tolist(), rel=1e-6)


@pytest.mark.parametrize("x, n", [(1.0, 1), (5.5, 5), (30.0, 30), (1000.25, 1000), (1e9 + 0.5, 40), (1e6, 7), (250_000.0, 249_990)])
def test_closed_tie_sums(x, n):
    u = np.array([x - k for k in range(n)])
    got = [float(s[0]) for s in sv.falling_sums(np.array([x]), np.array([n]))]
    assert got == pytest.approx([math.fsum(np.log(u)), math.fsum(1 / u), math.fsum(1 / u**2)], rel=1e-11)


def test_all_censored(spark):
    df = spark.createDataFrame([("A", 3, 1), ("A", 5, 1), ("B", 4, 1)], "ARM string, AVAL int, CNSR int")
    assert {r["survival"] for r in sv.kaplan_meier(df).collect()} == {1.0}
    assert all(r["median"] is None for r in sv.km_summary(sv.kaplan_meier(df)).collect())


def test_wilcoxon_with_ties(spark):
    a, b = [1, 2, 2, 3, 9], [2, 4, 5, 5, 7, 8]
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "ARM string, AVAL double")
    r = sv.wilcoxon(df, "ARM", ["a", "b"]).first()
    pool = sorted(a + b)
    rank = {v: np.mean([i + 1 for i, x in enumerate(pool) if x == v]) for v in pool}
    w, n1, n = sum(rank[x] for x in a), 5, 11
    ties = sum(c ** 3 - c for c in (pool.count(v) for v in set(pool)))
    z = (w - n1 * (n + 1) / 2) / math.sqrt(n1 * 6 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert r["rank_sum"] == pytest.approx(w) and r["z"] == pytest.approx(z)


def test_negative_binomial_and_prop_odds(spark):
    rng = np.random.default_rng(5)
    rows = [(float(i % 2), int(rng.negative_binomial(2, 2 / (2 + (2.0 if i % 2 else 4.0)))), "abc"[min(2, int(rng.exponential(1 + i % 2)))]) for i in range(400)]
    df = spark.createDataFrame(rows, "X double, Y int, C string")
    nb = {r["term"]: r for r in glm.negbin(df, "Y", {"X": F.col("X")}).collect()}
    m0, m1 = (np.mean([y for x, y, _ in rows if x == v]) for v in (0.0, 1.0))
    assert nb["X"]["estimate"] == pytest.approx(math.log(m1 / m0), abs=1e-5)

    def ll(size):
        return sum(math.lgamma(y + size) - math.lgamma(size) - math.lgamma(y + 1) + size * math.log(size / (size + mu)) + y * math.log(mu / (size + mu))
                   for y, mu in ((y, m1 if x else m0) for x, y, _ in rows))

    best = math.exp(nb["log_size"]["estimate"])
    assert ll(best) >= max(ll(best * 1.01), ll(best * 0.99))
    po = {r["term"]: r["estimate"] for r in glm.prop_odds(df, "C", ["a", "b", "c"], {"X": F.col("X")}).collect()}

    def pll(b, c1, c2):
        f = lambda t: 1 / (1 + math.exp(-t))
        p = {(x, c): v for x in (0.0, 1.0) for c, v in zip("abc", (f(c1 - b * x), f(c2 - b * x) - f(c1 - b * x), 1 - f(c2 - b * x)))}
        return sum(math.log(p[x, c]) for x, _, c in rows)

    at = (po["X"], po["a|b"], po["b|c"])
    for d in itertools.product((-1e-3, 0, 1e-3), repeat=3):
        assert pll(*at) >= pll(*(a + e for a, e in zip(at, d))) - 1e-9


def test_mmrm_equals_direct_likelihood(spark):
    rng = np.random.default_rng(11)
    chol = np.array([[1.0, 0, 0], [0.6, 0.9, 0], [0.4, 0.5, 1.1]])
    rows, data = [], []
    for i in range(60):
        arm, base = ARMS[i % 2], float(rng.normal(50, 5))
        y = 0.2 * (base - 50) + np.array([1, 2, 3]) * (i % 2) + chol @ rng.normal(size=3)
        seen = [0, 1, 2] if i % 4 else ([0, 1] if i % 8 else [0])
        data.append((i % 2, base, seen, y))
        rows += [(i, arm, base, v, float(y[v])) for v in seen]
    df = spark.createDataFrame(rows, "USUBJID int, ARM string, BASE double, V int, CHG double")
    got = {(r["visit"], r["kind"], r["term"]): r for r in mmrm.mmrm(df, "CHG", "V", [0, 1, 2], "ARM", ARMS[:2]).collect()}
    sigma = np.zeros((3, 3))
    for i in range(3):
        for j in range(i, 3):
            sigma[i, j] = sigma[j, i] = got[str(i), "covariance", str(j)]["estimate"]

    def reml(s):
        a, b, yy, ld = np.zeros((9, 9)), np.zeros(9), 0.0, 0.0
        for t, base, seen, y in data:
            z = np.zeros((len(seen), 9))
            for k, v in enumerate(seen):
                z[k, v * 3:v * 3 + 3] = [1, t, base - 50]
            so = s[np.ix_(seen, seen)]
            w = np.linalg.inv(so)
            a += z.T @ w @ z
            b += z.T @ w @ y[seen]
            yy += y[seen] @ w @ y[seen]
            ld += np.linalg.slogdet(so)[1]
        beta = np.linalg.solve(a, b)
        return -0.5 * (ld + np.linalg.slogdet(a)[1] + yy - b @ beta), beta, np.linalg.inv(a)

    best, beta, cov = reml(sigma)
    for i in range(3):
        for j in range(i, 3):
            for e in (-1e-3, 1e-3):
                s = sigma.copy()
                s[i, j] += e
                s[j, i] = s[i, j]
                assert reml(s)[0] <= best + 1e-7
    c = got["2", "contrast", "L - P"]
    assert c["estimate"] == pytest.approx(beta[7], abs=1e-5) and c["se"] == pytest.approx(math.sqrt(cov[7, 7]), rel=1e-5)
    assert 20 < c["df"] < 60 and 0 < c["p"] < 1


def dense_kenward_roger(x, y, blocks, sigma, l):
    """Estimate, corrected standard error and degrees of freedom of l'beta by whole matrices (rows of x in blocks of one subject's visits)."""
    t = len(sigma)
    pairs = [(i, j) for i in range(t) for j in range(i, t)]
    n = len(y)
    v, ds = np.zeros((n, n)), [np.zeros((n, n)) for _ in pairs]
    for rows, seen in blocks:
        v[np.ix_(rows, rows)] = sigma[np.ix_(seen, seen)]
        for q, (i, j) in enumerate(pairs):
            d = np.zeros((t, t))
            d[i, j] = d[j, i] = 1
            ds[q][np.ix_(rows, rows)] = d[np.ix_(seen, seen)]
    w = np.linalg.inv(v)
    phi = np.linalg.inv(x.T @ w @ x)
    first = [-x.T @ w @ d @ w @ x for d in ds]
    second = [[x.T @ w @ a @ w @ b @ w @ x for b in ds] for a in ds]
    p = len(pairs)
    info = np.array([[np.trace(w @ ds[q] @ w @ ds[r]) - np.trace(2 * phi @ second[q][r] - phi @ first[q] @ phi @ first[r]) for r in range(p)] for q in range(p)])
    wt = 2 * np.linalg.inv(info)
    lam = phi @ sum(wt[q, r] * (second[q][r] - first[q] @ phi @ first[r]) for q in range(p) for r in range(p)) @ phi
    theta = np.outer(l, l) / (l @ phi @ l)
    a = sum(wt[q, r] * np.trace(theta @ phi @ first[q] @ phi @ theta @ phi @ first[r] @ phi) for q in range(p) for r in range(p))
    e, rho = 1 / (1 - a), (1 - a / 2) / (1 - 2 * a)  # one row: the two sums of the paper are equal, its g is -1
    m = 4 + 3 / (rho - 1)
    assert m / (e * (m - 2)) == pytest.approx(1)
    return l @ phi @ x.T @ w @ y, math.sqrt(l @ (phi + 2 * lam) @ l), m


@pytest.mark.parametrize("complete, changing", [(True, False), (False, False), (False, True)])
def test_mmrm_kenward_roger_and_changing_covariates(spark, complete, changing):
    """Small samples, where the correction matters: equal to the published formulas on whole matrices."""
    rng = np.random.default_rng(5)
    chol = np.array([[1.0, 0], [0.6, 0.9]])
    rows = []
    for i in range(24):
        base, z = float(rng.normal(50, 5)), rng.normal(3, 1, 2)
        y = 0.2 * (base - 50) + np.array([1, 2]) * (i % 2) + 0.7 * z + chol @ rng.normal(size=2)
        rows += [(i, ARMS[i % 2], base, v, float(z[v]), float(y[v])) for v in ([0, 1] if complete or i % 3 else [i % 2])]
    df = spark.createDataFrame(rows, "USUBJID int, ARM string, BASE double, V int, Z double, CHG double")
    by_visit = ["Z"] if changing else []
    fit = mmrm.mmrm(df, "CHG", "V", [0, 1], "ARM", ARMS[:2], by_visit=by_visit, method="kenward-roger").collect()
    got = {(r["visit"], r["kind"], r["term"]): r for r in fit}
    sigma = np.array([[got[str(min(i, j)), "covariance", str(max(i, j))]["estimate"] for j in (0, 1)] for i in (0, 1)])
    k = 3 + len(by_visit)
    mean_b, mean_z = np.mean([r[2] for r in rows]), np.mean([r[4] for r in rows])
    x = np.zeros((len(rows), 2 * k))
    for n, (i, arm, base, v, z, _) in enumerate(rows):
        x[n, v * k:v * k + k] = [1, arm == "L", base - mean_b, z - mean_z][:k]
    y = np.array([r[5] for r in rows])
    blocks = [([n for n, r in enumerate(rows) if r[0] == i], [r[3] for r in rows if r[0] == i]) for i in range(24)]
    if changing:  # the likelihood is at its maximum
        def reml(s):
            v = np.zeros((len(rows),) * 2)
            for at, seen in blocks:
                v[np.ix_(at, at)] = s[np.ix_(seen, seen)]
            w = np.linalg.inv(v)
            a = x.T @ w @ x
            r = y - x @ np.linalg.solve(a, x.T @ w @ y)
            return -0.5 * (np.linalg.slogdet(v)[1] + np.linalg.slogdet(a)[1] + r @ w @ r)
        for d in ([[1e-3, 0], [0, 0]], [[0, 1e-3], [1e-3, 0]], [[0, 0], [0, 1e-3]]):
            assert max(reml(sigma + np.array(d)), reml(sigma - np.array(d))) <= reml(sigma) + 1e-7
    for v in (0, 1):
        for kind, term, at in (("contrast", "L - P", [0, 1, 0, 0]), ("lsmean", "L", [1, 1, 0, 0])):
            l = np.zeros(2 * k)
            l[v * k:v * k + k] = at[:k]
            est, se, m = dense_kenward_roger(x, y, blocks, sigma, l)
            r = got[str(v), kind, term]
            assert (r["estimate"], r["se"], r["df"]) == (pytest.approx(est, rel=1e-6), pytest.approx(se, rel=1e-6), pytest.approx(m, rel=1e-6))
    plain = {(r["visit"], r["kind"], r["term"]): r for r in mmrm.mmrm(df, "CHG", "V", [0, 1], "ARM", ARMS[:2], by_visit=by_visit).collect()}
    assert plain["1", "contrast", "L - P"]["se"] <= got["1", "contrast", "L - P"]["se"] + 1e-12
    with pytest.raises(ValueError):
        mmrm.mmrm(df, "CHG", "V", [0, 1], "ARM", ARMS[:2], method="other")


def test_zero_rows_for_absent_levels(spark):
    adsl = spark.createDataFrame([("A", "P", "x"), ("B", "P", "x"), ("C", "H", "y")], "USUBJID string, ARM string, G string")
    n = adsl.groupBy("ARM").agg(F.count(F.lit(1)).alias("N"))
    got = {(r["ARM"], r["level"]): (r["hits"], r["pct"]) for r in ard.ard_categorical(adsl, "ARM", "G", ["x", "y", "z"], ["P", "H"], n).collect()}
    assert got == {("P", "x"): (2, 100.0), ("P", "y"): (0, 0.0), ("P", "z"): (0, 0.0), ("H", "x"): (0, 0.0), ("H", "y"): (1, 100.0), ("H", "z"): (0, 0.0)}
    ev = spark.createDataFrame([("A", "P", "s", "t"), ("A", "P", "s", "t")], "USUBJID string, ARM string, AESOC string, AEDECOD string")
    tree = {(r["ARM"], r["depth"]): (r["subjects"], r["events"]) for r in ard.ard_hierarchical(ev, n, ["P", "H"]).collect()}
    assert tree == {("P", 0): (1, 2), ("P", 1): (1, 2), ("P", 2): (1, 2), ("H", 0): (0, 0), ("H", 1): (0, 0), ("H", 2): (0, 0)}


def test_absent_arm_and_collinear_dose_are_not_estimable(spark):
    rows = [("P", 0.0, b, 1.0 + 0.5 * b + (k % 3)) for k, b in enumerate([1.0, 2.0, 4.0, 5.0, 7.0])]
    rows += [("L", 1.0, b, 2.0 + 0.5 * b + (k % 2)) for k, b in enumerate([1.5, 2.5, 3.0, 6.0])]
    df = spark.createDataFrame(rows, "ARM string, DOSE double, BASE double, CHG double")
    got = {(r["kind"], r["term"]): (r["estimate"], r["se"]) for r in md.ancova(df, "CHG", "ARM", ["P", "L", "H"]).collect()}
    assert got[("lsmean", "H")] == got[("contrast", "H - P")] == got[("contrast", "H - L")] == got[("coefficient", "ARM=H")] == (None, None)
    assert got[("contrast", "L - P")][1] > 0 and got[("lsmean", "P")][0] is not None
    same = df.withColumn("COPY", F.col("DOSE") * 3)
    slope = md.dose_response(same, "CHG", "DOSE", covariates=("COPY", "BASE")).first()
    assert slope["estimate"] is None and slope["se"] is None
    factor = md.ancova(df.withColumn("SITE", F.lit("A")), "CHG", "ARM", ["P", "L"], {"SITE": ["A", "B"]}).filter("kind = 'lsmean'").collect()
    assert all(r["estimate"] is None for r in factor)  # the grid asks for a level that is not there


def test_far_tails():
    from cohortsmith.functions import special

    assert float(special.chi2_sf(100, 1)) == pytest.approx(1.523970604832094e-23, rel=1e-10)
    assert float(special.chi2_sf(60, 1)) == pytest.approx(9.485738e-15, rel=1e-5)
    assert float(special.chi2_sf(900, 2)) == pytest.approx(math.exp(-450), rel=1e-10)


def test_ranges_of_many_values_match_a_plain_sort(spark):
    from pyspark.sql import Window

    from cohortsmith.operators.groups import prefix_counts, value_counts

    df = spark.range(0, 60_000, 1, 8).select((F.col("id") % 2).alias("g"), (F.xxhash64("id") % 25_000 / 7.0).alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        counts = value_counts(df, ["g"], "v")
        sizes = [r["n"] for r in counts.groupBy("__part").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
        got = {(r["g"], r["v"]): (r["below"], r["total"]) for r in prefix_counts(counts, ["g"], "v", "__n").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plain = df.groupBy("g", "v").count().withColumn("b", F.sum("count").over(Window.partitionBy("g").orderBy("v")) - F.col("count"))
    plain = plain.withColumn("t", F.sum("count").over(Window.partitionBy("g")))
    assert got == {(r["g"], r["v"]): (r["b"], r["t"]) for r in plain.collect()}
