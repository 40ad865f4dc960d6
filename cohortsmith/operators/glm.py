"""Generalised linear, negative binomial and proportional odds models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import special

_TABLE = "term string, estimate double, se double, statistic double, p double"


def glm(df: DataFrame, y: str, covariates: dict[str, Column], family: str = "binomial", offset: Column | None = None,
        max_iter: int = 25) -> DataFrame:
    """Logistic ("binomial") or Poisson regression: coefficients, SE, z and p, intercept last; nulls if the fit does not converge."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    names = list(covariates)
    cols = [F.col(y).cast("double").alias("label"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(covariates.values())]]
    if offset is not None:
        cols.append(offset.cast("double").alias("offset"))
    data = VectorAssembler(inputCols=[f"x{i}" for i in range(len(names))], outputCol="features").transform(
        df.select(*cols).dropna())
    model = GeneralizedLinearRegression(family=family, maxIter=max_iter, tol=1e-12, **({"offsetCol": "offset"} if offset is not None else {})).fit(data)
    s = model.summary
    est = [*model.coefficients, model.intercept]
    rows = [(n, float(b), float(se), float(t), float(p)) for n, b, se, t, p in zip(
        [*names, "intercept"], est, s.coefficientStandardErrors, s.tValues, s.pValues)]
    if s.numIterations >= max_iter:
        rows = [(n, None, None, None, None) for n, *_ in rows]
    return df.sparkSession.createDataFrame(rows, _TABLE)


def _packed(df: DataFrame, y: str, covariates: dict[str, Column], offset: Column | None) -> DataFrame:
    """Equal rows counted together: y, offset, x0.. and the weight w."""
    cols = [F.col(y).cast("double").alias("y"), (F.lit(0.0) if offset is None else offset.cast("double")).alias("o"),
            *[c.cast("double").alias(f"x{i}") for i, c in enumerate(covariates.values())]]
    rows = df.select(*cols).dropna()
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("w"))


def _sum_over_batches(packed: DataFrame, size: int, batch: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum a fixed-size numeric summary over all rows: per Arrow batch in the tasks, then one Spark aggregate."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for f in frames:
            if len(f):
                total = total + batch(f)
        yield pd.DataFrame({"v": [total.tolist()]})

    parts = packed.mapInPandas(run, "v array<double>")
    row = parts.agg(*[F.sum(F.col("v")[i]) for i in range(size)]).first()
    return np.array([x or 0.0 for x in row], float)


def _wald_table(spark, names, est, cov):
    rows = []
    for n, b, v in zip(names, est, np.diag(cov)):
        if not np.isfinite(b):
            rows.append((n, None, None, None, None))
            continue
        se = float(np.sqrt(v)) if v > 0 else None
        z = float(b) / se if se else None
        rows.append((n, float(b), se, z, float(2 * special.norm_sf(abs(z))) if z is not None else None))
    return spark.createDataFrame(rows, _TABLE)


def _newton(score: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], start: np.ndarray, max_iter: int = 50,
            tol: float = 1e-10, max_step: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """Scoring with step halving; returns the estimate and its covariance, all NaN if ``max_iter`` steps were not enough."""
    x = start
    ll, u, info = score(x)
    for _ in range(max_iter):
        delta = np.linalg.pinv(info, hermitian=True) @ u
        scale = min(1.0, max_step / max(float(np.abs(delta).max()), 1e-300))
        while True:
            got = score(x + scale * delta)
            if (np.isfinite(got[0]) and got[0] >= ll - 1e-9 * (abs(ll) + 1)) or scale < 1e-3:
                break
            scale /= 2
        gain, x = got[0] - ll, x + scale * delta
        ll, u, info = got
        if abs(gain) <= tol * (abs(ll) + 1.0):
            return x, np.linalg.pinv(info, hermitian=True)
    return np.full_like(x, np.nan), np.full_like(info, np.nan)


def _digamma_pair(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digamma and trigamma by recurrence up to 10, then the asymptotic series."""
    x = np.asarray(x, float).copy()
    d, t = np.zeros_like(x), np.zeros_like(x)
    while (low := x < 10).any():
        d[low] -= 1 / x[low]
        t[low] += 1 / x[low] ** 2
        x[low] += 1
    i = 1 / x
    j = i * i
    d += np.log(x) - i / 2 - j * (1 / 12 - j * (1 / 120 - j * (1 / 252 - j * (1 / 240 - j / 132))))
    t += i + j / 2 + i * j * (1 / 6 - j * (1 / 30 - j * (1 / 42 - j * (1 / 30 - j * 5 / 66))))
    return d, t


#: Above this log size the negative binomial and the Poisson likelihood agree to double precision for the counts seen in practice.
LOG_SIZE_MAX = 12.0


def negbin(df: DataFrame, y: str, covariates: dict[str, Column], offset: Column | None = None) -> DataFrame:
    """Negative binomial regression with log link: coefficients, intercept and log of the size parameter.

    Without overdispersion the size has no finite estimate: its row is null and the others are the Poisson limit.
    """
    names = [*covariates, "intercept", "log_size"]
    k = len(covariates) + 1
    packed = _packed(df, y, covariates, offset).cache()
    iu = np.triu_indices(k)

    def score(par):
        beta, size = par[:k], float(np.exp(np.clip(par[k], -30, 30)))

        def batch(f: pd.DataFrame) -> np.ndarray:
            x = np.column_stack([*[f[f"x{i}"] for i in range(k - 1)], np.ones(len(f))])
            yv, w = f["y"].to_numpy(float), f["w"].to_numpy(float)
            mu = np.exp(np.clip(x @ beta + f["o"].to_numpy(float), -700, 700))
            d1, t1 = _digamma_pair(yv + size)
            d0, t0 = _digamma_pair(np.full(len(f), size))
            lg = special._lgamma(yv + size) - special._lgamma(np.full(len(f), size)) - special._lgamma(yv + 1)
            ll = lg + size * np.log(size / (size + mu)) + yv * np.log(np.where(yv > 0, mu / (size + mu), 1.0))
            resid = (yv - mu) * size / (size + mu)
            g_size = size * (d1 - d0 + np.log(size / (size + mu)) + 1 - (yv + size) / (mu + size))
            h_size = -(size * size * (t1 - t0 + 1 / size - 2 / (mu + size) + (yv + size) / (mu + size) ** 2)) - g_size
            hess = (x * (w * mu * size / (size + mu))[:, None]).T @ x
            return np.concatenate([[w @ ll], x.T @ (w * resid), [w @ g_size, w @ h_size], hess[iu]])

        v = _sum_over_batches(packed, 3 + k + len(iu[0]), batch)
        info = np.zeros((k + 1, k + 1))
        h = np.zeros((k, k))
        h[iu] = v[3 + k:]
        info[:k, :k] = h + np.triu(h, 1).T
        u = v[1:2 + k]
        info[k, k] = max(abs(v[2 + k]), 1e-3)
        if par[k] >= LOG_SIZE_MAX and u[k] > 0:  # no overdispersion left to find: the Poisson limit
            u[k] = 0.0
        return v[0], u, info

    try:
        head = packed.agg((F.sum(F.col("w") * F.col("y")) / F.sum(F.col("w") * F.exp("o"))).alias("m")).first()
        start = np.zeros(k + 1)
        start[k - 1] = np.log(max(head["m"] or 1.0, 1e-8))
        est, cov = _newton(score, start)
        if est[k] >= LOG_SIZE_MAX:
            est[k] = np.nan
    finally:
        packed.unpersist()
    return _wald_table(df.sparkSession, names, est, cov)


def prop_odds(df: DataFrame, y: str, levels: list, covariates: dict[str, Column]) -> DataFrame:
    """Proportional odds model of an ordered response: slopes (positive means higher categories) and cut points."""
    k, c = len(covariates), len(levels)
    rank = F.coalesce(*[F.when(F.col(y) == l, F.lit(i)) for i, l in enumerate(levels)])
    packed = _packed(df.withColumn("__rank", rank), "__rank", covariates, None).cache()
    size = k + c - 1
    iu = np.triu_indices(size)

    def score(par):
        beta, cuts = par[:k], par[k:]
        if np.any(np.diff(cuts) <= 0):
            return -np.inf, np.zeros(size), np.eye(size)

        def batch(f: pd.DataFrame) -> np.ndarray:
            x = np.column_stack([f[f"x{i}"] for i in range(k)]) if k else np.zeros((len(f), 0))
            cat, w = f["y"].to_numpy(int), f["w"].to_numpy(float)
            eta = x @ beta
            cdf = np.column_stack([np.zeros(len(f)), *[1 / (1 + np.exp(-(a - eta))) for a in cuts], np.ones(len(f))])
            pdf = cdf * (1 - cdf)
            prob = np.maximum(np.diff(cdf, axis=1), 1e-300)
            grads = np.zeros((len(f), c, size))  # derivative of each category's probability
            grads[:, :, :k] = -(pdf[:, 1:] - pdf[:, :-1])[:, :, None] * x[:, None, :]
            for j in range(c - 1):
                grads[:, j, k + j] += pdf[:, j + 1]
                grads[:, j + 1, k + j] -= pdf[:, j + 1]
            seen = np.arange(len(f)), cat
            u = (w / prob[seen]) @ grads[seen]
            info = np.einsum("ncp,ncq,nc->pq", grads, grads, w[:, None] / prob)
            return np.concatenate([[w @ np.log(prob[seen])], u, info[iu]])

        v = _sum_over_batches(packed, 1 + size + len(iu[0]), batch)
        h = np.zeros((size, size))
        h[iu] = v[1 + size:]
        return v[0], v[1:1 + size], h + np.triu(h, 1).T

    try:
        totals = {int(r["y"]): r["n"] for r in packed.groupBy("y").agg(F.sum("w").alias("n")).collect()}
        cum = np.cumsum([totals.get(i, 0.0) + 0.5 for i in range(c)]) / (sum(totals.values()) + 0.5 * c)
        start = np.concatenate([np.zeros(k), np.log(cum[:-1] / (1 - cum[:-1]))])
        est, cov = _newton(score, start)
    finally:
        packed.unpersist()
    names = [*covariates, *[f"{levels[i]}|{levels[i + 1]}" for i in range(c - 1)]]
    return _wald_table(df.sparkSession, names, est, cov)
