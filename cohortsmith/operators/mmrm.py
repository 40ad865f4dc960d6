"""Repeated-measures model with unstructured covariance, from sums per missingness pattern.

The mean model crosses every column with visit, so all subjects with
the same set of observed visits enter the likelihood only through their count,
means and co-moments: of the columns of a subject, of the columns that change from
visit to visit (at each visit), and of the responses. Spark reduces the data to at most 2^T - 1 such rows per
model; REML runs on those rows in a pandas UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import special
from .models import RowSpace, Design, dose_contrasts

_FIELDS = ["visit", "kind", "term", "estimate", "se", "df", "statistic", "p", "lower", "upper"]
_SCHEMA = ("array<struct<visit:string,kind:string,term:string,estimate:double,se:double,df:double,statistic:double,"
           "p:double,lower:double,upper:double>>")


def pattern_stats(df: DataFrame, y: str, visit: str, visits: Sequence, design: Design, subject: Sequence[str],
                  by: Sequence[str] = (), by_visit: Sequence[str] = ()) -> DataFrame:
    """Per model and pattern of observed visits: n, means and co-moments of [x, by-visit columns at each visit, y at each visit]."""
    xs = design.columns()
    k, t = len(xs), len(visits)
    rows = design.complete(df, y).dropna(subset=list(by_visit)).select(
        *by, *subject, F.col(visit).alias("__v"), F.col(y).cast("double").alias("__y"), *[c.alias(f"x{i}") for i, c in enumerate(xs)],
        *[F.col(c).cast("double").alias(f"__z{i}") for i, c in enumerate(by_visit)])
    at = lambda c, v: F.max(F.when(F.col("__v") == v, F.col(c)))
    wide = rows.filter(F.col("__v").isin(*visits)).groupBy(*by, *subject).agg(
        *[F.max(f"x{i}").alias(f"x{i}") for i in range(k)],
        *[at(f"__z{i}", v).alias(f"z{i}_{j}") for i in range(len(by_visit)) for j, v in enumerate(visits)],
        *[at("__y", v).alias(f"y{j}") for j, v in enumerate(visits)])
    seen = F.concat(*[F.when(F.col(f"y{j}").isNotNull(), "1").otherwise("0") for j in range(t)])
    cols = [f"x{i}" for i in range(k)] + [f"z{i}_{j}" for i in range(len(by_visit)) for j in range(t)] + [f"y{j}" for j in range(t)]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return wide.withColumn("pattern", seen).groupBy(*by, "pattern").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(*[F.avg(zero(c)) for c in cols]).alias("means"),
        F.array(*[F.covar_pop(zero(a), zero(b)) for i, a in enumerate(cols) for b in cols[i:]]).alias("cross"))


class _Reml:
    """The likelihood of one model. A block is a pattern: n, observed visits, and sums of x(a) x(b)', x(a) y(b) and y(a) y(b) for visits a, b."""

    def __init__(self, patterns, k, t, changing=0):
        self.t, self.k1 = t, k + 1 + changing
        self.pairs = [(i, j) for i in range(t) for j in range(i, t)]
        m = k + changing * t + t
        mean = lambda p: np.asarray(p["means"], float)
        seen = lambda p: [j for j, s in enumerate(p["pattern"]) if s == "1"]
        n_tot = sum(p["n"] for p in patterns)
        recs = sum(p["n"] * len(seen(p)) for p in patterns)
        place = lambda i, j: k + i * t + j  # of the changing column i at visit j
        shift = sum(p["n"] * mean(p)[:k] for p in patterns) / n_tot
        moving = [sum(p["n"] * mean(p)[place(i, j)] for p in patterns for j in seen(p)) / recs for i in range(changing)]
        self.shift = np.concatenate([shift, moving])
        grid = sum(p["n"] * len(seen(p)) * (mean(p)[:k] - shift) for p in patterns) / recs
        self.grid_mean = np.concatenate([grid, np.zeros(changing)])  # changing columns stand at their mean over all records
        self.blocks = []
        for p in patterns:
            c = np.zeros((m, m))
            c[np.triu_indices(m)] = np.asarray(p["cross"], float)
            c = c + np.triu(c, 1).T
            mu = mean(p).copy()
            mu[:k] -= shift
            obs = seen(p)
            for i in range(changing):
                mu[[place(i, j) for j in obs]] -= moving[i]
            full = np.zeros((m + 1, m + 1))
            full[0, 0], full[0, 1:], full[1:, 0] = p["n"], p["n"] * mu, p["n"] * mu
            full[1:, 1:] = p["n"] * (c + np.outer(mu, mu))
            x = np.array([[0, *range(1, k + 1), *[1 + place(i, j) for i in range(changing)]] for j in obs])
            ys = np.array([1 + k + changing * t + j for j in obs])
            sxx = full[x[:, None, :, None], x[None, :, None, :]]
            sxy = full[x[:, None, :], ys[None, :, None]]
            self.blocks.append((p["n"], obs, sxx, sxy, full[np.ix_(ys, ys)]))

    def spread(self, obs, weights, sxx):
        """Sum over visits a, b of weights[a, b] x(a) x(b)', laid out over all coefficients."""
        t, k1 = self.t, self.k1
        out = np.zeros((t, k1, t, k1))
        out[np.ix_(obs, range(k1), obs, range(k1))] = np.einsum("ab,abij->aibj", weights, sxx)
        return out.reshape(t * k1, t * k1)

    def sigma(self, theta):
        s = np.zeros((self.t, self.t))
        for (i, j), v in zip(self.pairs, theta):
            s[i, j] = s[j, i] = v
        return s

    def steps(self, obs, w):
        """Per covariance parameter that the visits ``obs`` meet: w D, with D the derivative of the covariance."""
        where = {v: a for a, v in enumerate(obs)}
        out = {}
        for q, (i, j) in enumerate(self.pairs):
            if i in where and j in where:
                d = np.zeros_like(w)
                d[where[i], where[j]] = d[where[j], where[i]] = 1.0
                out[q] = w @ d
        return out

    def evaluate(self, theta, need_score=True):
        """REML log-likelihood, score, scoring matrix, coefficients, their covariance and its derivatives."""
        t, k1 = self.t, self.k1
        s = self.sigma(theta)
        if np.linalg.eigvalsh(s)[0] <= 1e-10 * max(np.trace(s), 1e-300):
            return None
        xvx, xvy, yvy, logdet = np.zeros((t * k1, t * k1)), np.zeros((t, k1)), 0.0, 0.0
        inv = []
        for n, obs, sxx, sxy, syy in self.blocks:
            so = s[np.ix_(obs, obs)]
            w = np.linalg.inv(so)
            inv.append(w)
            logdet += n * np.linalg.slogdet(so)[1]
            xvy[obs] += np.einsum("ab,abi->ai", w, sxy)
            xvx += self.spread(obs, w, sxx)
            yvy += float((w * syy).sum())
        xvy = xvy.ravel()
        cov = np.linalg.pinv(xvx, hermitian=True, rcond=1e-12)
        eig = np.linalg.eigvalsh(xvx)
        eig = eig[eig > eig[-1] * 1e-12]
        beta = cov @ xvy
        ll = -0.5 * (logdet + np.log(eig).sum() + yvy - xvy @ beta)
        if not need_score:
            return ll
        p = len(self.pairs)
        score, info, dcov = np.zeros(p), np.zeros((p, p)), [np.zeros_like(xvx) for _ in range(p)]
        for (n, obs, sxx, sxy, syy), w in zip(self.blocks, inv):
            b = beta.reshape(t, k1)[obs]
            fitted = np.einsum("ai,abi->ab", b, sxy)
            resid = syy - fitted - fitted.T + np.einsum("ai,abij,bj->ab", b, sxx, b)
            wd = self.steps(obs, w)
            for q, m in wd.items():
                mid = m @ w
                score[q] += -0.5 * n * np.trace(m) + 0.5 * float((mid * resid).sum())
                dcov[q] += self.spread(obs, mid, sxx)
                for r, m2 in wd.items():
                    info[q, r] += 0.5 * n * np.trace(m @ m2)
        for q in range(p):
            score[q] += 0.5 * float((cov * dcov[q]).sum())
        return ll, score, info, beta, cov, dcov

    def start(self):
        var, cnt = np.zeros(self.t), np.zeros(self.t)
        for n, obs, sxx, sxy, syy in self.blocks:
            for a, v in enumerate(obs):
                coef = np.linalg.pinv(sxx[a, a], hermitian=True) @ sxy[a, a]
                var[v] += max(syy[a, a] - coef @ sxy[a, a], 0.0)
                cnt[v] += n
        d = np.where(cnt > 0, var / np.maximum(cnt, 1), 1.0)
        d = np.where(d > 0, d, max(d.max(), 1.0))
        return np.array([d[i] if i == j else 0.0 for i, j in self.pairs])

    def fit(self, max_iter=200, tol=1e-15):
        theta = self.start()
        cur = self.evaluate(theta)
        for _ in range(max_iter if cur is not None else 0):
            ll, score, info = cur[:3]
            delta, step = np.linalg.pinv(info, hermitian=True) @ score, 1.0
            while True:
                got = self.evaluate(theta + step * delta, need_score=False)
                if got is not None and got >= ll - 1e-10 or step < 1e-8:
                    break
                step /= 2
            if got is None:
                break
            theta = theta + step * delta
            cur = self.evaluate(theta)
            if float(score @ delta) < tol:
                break
        return theta, cur

    def theta_cov(self, theta):
        """Inverse of the observed information, by central differences of the score."""
        p = len(theta)
        h = np.zeros((p, p))
        for q in range(p):
            e = 1e-5 * max(abs(theta[q]), 1e-3 * np.abs(theta).max())
            up, dn = theta.copy(), theta.copy()
            up[q] += e
            dn[q] -= e
            a, b = self.evaluate(up), self.evaluate(dn)
            if a is None or b is None:
                return None
            h[:, q] = -(a[1] - b[1]) / (2 * e)
        return np.linalg.pinv((h + h.T) / 2, hermitian=True)


    def kenward_roger(self, theta, cov, dcov):
        """Covariance of the coefficients corrected for that of the covariance parameters, and the latter (Kenward and Roger 1997).

        The covariance is linear in its parameters, so their second derivatives vanish, and what is left is made of
        w D w and w D w D w, spread over the sums of each pattern.
        """
        s, p = self.sigma(theta), len(self.pairs)
        second = [[None] * p for _ in range(p)]
        traces = np.zeros((p, p))
        for n, obs, sxx, _, _ in self.blocks:
            w = np.linalg.inv(s[np.ix_(obs, obs)])
            wd = self.steps(obs, w)
            for q, m in wd.items():
                for r, m2 in wd.items():
                    traces[q, r] += n * np.trace(m @ m2)
                    part = self.spread(obs, m @ m2 @ w, sxx)
                    second[q][r] = part if second[q][r] is None else second[q][r] + part
        info = np.zeros((p, p))
        for q in range(p):
            for r in range(p):
                both = 0.0 if second[q][r] is None else 2 * float((cov * second[q][r].T).sum())
                info[q, r] = traces[q, r] - both + float(np.trace(cov @ dcov[q] @ cov @ dcov[r]))
        spread = 2 * np.linalg.pinv((info + info.T) / 2, hermitian=True)
        middle = sum(spread[q, r] * ((0.0 if second[q][r] is None else second[q][r]) - dcov[q] @ cov @ dcov[r]) for q in range(p) for r in range(p))
        return cov + cov @ (middle + middle.T) @ cov, spread


def _satterthwaite(l, cov, dcov, a):
    v = float(l @ cov @ l)
    if a is None or v <= 0:
        return np.nan
    g = np.array([float(l @ cov @ d @ cov @ l) for d in dcov])
    denom = float(g @ a @ g)
    return 2 * v * v / denom if denom > 0 else np.nan


def mmrm(df: DataFrame, y: str, visit: str, visits: Sequence, treat: str, levels: Sequence[str],
         covariates: Sequence[str] = ("BASE",), factors: Mapping[str, Sequence[str]] | None = None,
         contrasts: Mapping[str, Sequence[float]] | None = None, subject: Sequence[str] = ("USUBJID",),
         by: Sequence[str] = (), level: float = 0.95, by_visit: Sequence[str] = (), method: str = "satterthwaite") -> DataFrame:
    """LS-means and contrasts per visit, with standard errors and degrees of freedom, and the covariance.

    ``df`` has one record per subject and visit; treatment, factors and ``covariates`` do
    not change within a subject, those in ``by_visit`` may. Every column has a coefficient per visit;
    LS-means take covariates at their means over all records. Covariance: unstructured. ``method``: "satterthwaite", or "kenward-roger",
    which also corrects the standard errors (of one-row contrasts the statistic needs no further factor).
    """
    if method not in ("satterthwaite", "kenward-roger"):
        raise ValueError(method)
    design = Design(treat, tuple(levels), tuple((n, tuple(v)) for n, v in (factors or {}).items()), tuple(covariates))
    terms, k, t = design.terms(), len(design.terms()), len(visits)
    wanted = dict(contrasts if contrasts is not None else dose_contrasts(levels))
    share = {n: 1.0 / len(v) for n, v in design.factors}

    def grid(arm, model):
        x = np.zeros(k)
        for i, (kind, name, lev) in enumerate(terms):
            if kind == "covariate":
                x[i] = model.grid_mean[i]
            elif name == treat:
                x[i] = (1.0 if lev == arm else 0.0) - model.shift[i]
            else:
                x[i] = share[name] - model.shift[i]
        return np.concatenate([[1.0], x, model.grid_mean[k:]])

    def solve_one(patterns):
        patterns = [p for p in patterns if "1" in p["pattern"]]
        if not patterns:
            return []
        model = _Reml(patterns, k, t, len(by_visit))
        try:
            theta, fitted = model.fit()
            a = model.theta_cov(theta) if fitted is not None and method == "satterthwaite" else None
        except np.linalg.LinAlgError:
            fitted = None
        if fitted is None:  # too little data for an unstructured covariance
            return [dict(zip(_FIELDS, ("", "loglik", "REML") + (None,) * 7))]
        ll, _, _, beta, cov, dcov = fitted
        wide = cov
        if method == "kenward-roger":
            wide, a = model.kenward_roger(theta, cov, dcov)
        rows = [("", "loglik", "REML", ll) + (None,) * 6]
        rows += [(str(visits[i]), "covariance", str(visits[j]), float(v)) + (None,) * 6
                 for (i, j), v in zip(model.pairs, theta)]
        space = RowSpace(cov)  # an absent arm, or one absent at a visit, is outside it
        for vi, v in enumerate(visits):
            base = {arm: grid(arm, model) for arm in levels}
            asked = [("lsmean", arm, base[arm]) for arm in levels]
            asked += [("contrast", name, sum(w * base[arm] for w, arm in zip(ws, levels))) for name, ws in wanted.items()]
            for kind, name, x in asked:
                l = np.zeros(t * len(x))
                l[vi * len(x):(vi + 1) * len(x)] = x
                if not space.holds(l):
                    rows.append((str(v), kind, name) + (None,) * 7)
                    continue
                est, se = float(l @ beta), float(np.sqrt(max(l @ wide @ l, 0.0)))
                dof = _satterthwaite(l, cov, dcov, a)
                ok = se > 0 and np.isfinite(dof)
                stat = est / se if se > 0 else None
                q = special.t_quantile(0.5 + level / 2, dof) if ok else None
                rows.append((str(v), kind, name, est, se, dof if np.isfinite(dof) else None, stat,
                             float(special.t_sf2(stat, dof)) if ok else None,
                             est - q * se if ok else None, est + q * se if ok else None))
        return [dict(zip(_FIELDS, r)) for r in rows]

    @F.pandas_udf(_SCHEMA)
    def solve(stats: pd.Series) -> pd.Series:
        return pd.Series([solve_one(list(s)) for s in stats])

    stats = pattern_stats(df, y, visit, visits, design, subject, by, by_visit)
    # at most 2^T - 1 rows per model are listed together
    packed = stats.groupBy(*by).agg(F.collect_list(F.struct("pattern", "n", "means", "cross")).alias("__s"))
    return packed.select(*by, F.explode(solve("__s")).alias("__r")).select(*by, "__r.*")
