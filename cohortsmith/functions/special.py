"""Tails and quantiles of the usual test distributions, in numpy.

Series and continued fractions of the incomplete gamma and beta functions as
given in standard handbooks; vectorised for use inside pandas UDFs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

_TINY = 1e-300
_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def norm_sf(x):
    """Upper tail of the standard normal."""
    return 0.5 * _erfc(np.asarray(x, float) / math.sqrt(2.0))


def _invert(fn, target: float, lo: float, hi: float) -> float:
    """Root of an increasing function by bisection."""
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if fn(mid) < target:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-15 * max(1.0, abs(mid)):
            break
    return 0.5 * (lo + hi)


def norm_quantile(p: float) -> float:
    return _invert(lambda x: 1.0 - float(norm_sf(x)), p, -40.0, 40.0)


def _gamma_tails(a: float, x: float) -> tuple[float, float]:
    """Lower and upper regularised incomplete gamma; the one that is small is summed directly."""
    if not (a > 0) or math.isnan(x):
        return math.nan, math.nan
    if x <= 0:
        return 0.0, 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        for _ in range(10000):
            k += 1
            term *= x / k
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        lower = min(1.0, total * front)
        return lower, 1.0 - lower
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > _TINY else _TINY)
        c = b + an / (c if abs(c) > _TINY else _TINY)
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    upper = min(1.0, front * h)
    return 1.0 - upper, upper


gamma_p = np.vectorize(lambda a, x: _gamma_tails(a, x)[0], otypes=[float])
gamma_q = np.vectorize(lambda a, x: _gamma_tails(a, x)[1], otypes=[float])


def chi2_sf(x, df):
    """Upper tail of chi-square."""
    return gamma_q(np.asarray(df, float) / 2.0, np.asarray(x, float) / 2.0)


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 10000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        delta = 1.0
        for coeff in (even, odd):
            d = 1 + coeff * d
            d = 1 / (d if abs(d) > _TINY else _TINY)
            c = 1 + coeff / (c if abs(c) > _TINY else _TINY)
            delta = c * d
            h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return h


def _beta_inc_scalar(a: float, b: float, x: float) -> float:
    if any(math.isnan(v) for v in (a, b, x)):
        return math.nan
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1 - x) / b


beta_inc = np.vectorize(_beta_inc_scalar, otypes=[float])


def t_sf2(t, df):
    """Two-sided tail of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f, d1, d2):
    """Upper tail of F."""
    f, d1, d2 = (np.asarray(v, float) for v in (f, d1, d2))
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t for p above one half."""
    if not (df > 0):
        return math.nan
    return _invert(lambda t: 1.0 - 0.5 * float(t_sf2(t, df)), p, 0.0, 1e6)


def beta_quantile(p: float, a: float, b: float) -> float:
    return _invert(lambda x: _beta_inc_scalar(a, b, x), p, 0.0, 1.0)


def clopper_pearson(n: float, total: float, level: float = 0.95) -> tuple[float, float]:
    """Exact interval of a proportion."""
    alpha = (1 - level) / 2
    if not total or math.isnan(total):
        return math.nan, math.nan
    lower = 0.0 if n <= 0 else beta_quantile(alpha, n, total - n + 1)
    upper = 1.0 if n >= total else beta_quantile(1 - alpha, n + 1, total - n)
    return lower, upper


def clopper_pearson_udf(level: float):
    """``clopper_pearson`` for columns, run on a table of counts."""
    @F.pandas_udf("lower double, upper double")
    def interval(n: pd.Series, total: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([clopper_pearson(a, b, level) for a, b in zip(n, total)], columns=["lower", "upper"])

    return interval


def tail_udf(kind: str):
    """p-value column from statistics: ``z``, ``t``, ``chisq`` or ``F`` with its degrees of freedom."""
    @F.pandas_udf("double")
    def tail(stat: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        if kind == "z":
            return pd.Series(2 * norm_sf(np.abs(stat.to_numpy(float))))
        if kind == "t":
            return pd.Series(t_sf2(stat.to_numpy(float), df1.to_numpy(float)))
        if kind == "chisq":
            return pd.Series(chi2_sf(stat.to_numpy(float), df1.to_numpy(float)))
        return pd.Series(f_sf(stat.to_numpy(float), df1.to_numpy(float), df2.to_numpy(float)))

    return tail


def hypergeom_two_sided(a: float, b: float, c: float, d: float) -> float:
    """Two-sided Fisher probability of a 2 x 2 table: all tables no likelier than the one seen.

    Tables more than 40 standard deviations from the mean lie below the smallest
    double, so only the range around the mean is summed.
    """
    r1, c1, n = a + b, a + c, a + b + c + d
    if n == 0:
        return math.nan
    mean = r1 * c1 / n
    sd = math.sqrt(max(mean * (1 - r1 / n) * (n - c1) / max(n - 1, 1), 0.0))
    lo = max(0, r1 + c1 - n, math.floor(mean - 40 * sd - 40))
    hi = min(r1, c1, math.ceil(mean + 40 * sd + 40))
    if not lo <= a <= hi:
        return 0.0
    x = np.arange(lo, hi + 1)
    logp = (_lgamma(r1 + 1) - _lgamma(x + 1) - _lgamma(r1 - x + 1)
            + _lgamma(n - r1 + 1) - _lgamma(c1 - x + 1) - _lgamma(n - r1 - c1 + x + 1)
            - (_lgamma(n + 1) - _lgamma(c1 + 1) - _lgamma(n - c1 + 1)))
    p = np.exp(logp)
    return float(min(1.0, p[p <= p[int(a - lo)] * (1 + 1e-7)].sum()))
