"""Inference from sufficient statistics.

Each fit takes one distributed pass to an aggregate whose size depends on the
model only: a Gram matrix, a contingency table, sums per missingness pattern. The
small solve then runs on those rows inside a pandas UDF, one row per model, so
many parameters or studies are solved side by side and nothing goes through the
driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import special

# ---- linear models ---------------------------------------------------------------


@dataclass(frozen=True)
class Design:
    """Columns of a linear model: dummies of factors with declared levels (first is the reference), then covariates."""

    treat: str | None
    treat_levels: tuple[str, ...] = ()
    factors: tuple[tuple[str, tuple[str, ...]], ...] = ()
    covariates: tuple[str, ...] = ()

    def terms(self) -> list[tuple[str, str, str | None]]:
        out = [("factor", self.treat, l) for l in self.treat_levels[1:]] if self.treat else []
        for name, levels in self.factors:
            out += [("factor", name, l) for l in levels[1:]]
        return out + [("covariate", c, None) for c in self.covariates]

    def columns(self) -> list[Column]:
        return [
            F.when(F.col(n) == l, 1.0).otherwise(0.0) if kind == "factor" else F.col(n).cast("double")
            for kind, n, l in self.terms()
        ]

    def names(self) -> list[str]:
        return [n if l is None else f"{n}={l}" for _, n, l in self.terms()]

    def complete(self, df: DataFrame, y: str) -> DataFrame:
        """Rows usable by the model: known levels and no missing value."""
        df = df.filter(F.col(y).isNotNull())
        if self.treat:
            df = df.filter(F.col(self.treat).isin(*self.treat_levels))
        for name, levels in self.factors:
            df = df.filter(F.col(name).isin(*levels))
        for c in self.covariates:
            df = df.filter(F.col(c).isNotNull())
        return df


def gram(df: DataFrame, design: Design, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Per model: n, means and centred cross-products of [x, y], in one pass.

    Co-moments are accumulated around running means, so no separate centring pass
    is needed and large offsets do no harm.
    """
    cols = [*design.columns(), F.col(y).cast("double")]
    named = design.complete(df, y).select(*by, *[c.alias(f"x{i}") for i, c in enumerate(cols)])
    k = len(cols)
    means = F.array(*[F.avg(f"x{i}") for i in range(k)])
    cross = F.array(*[F.covar_pop(f"x{i}", f"x{j}") for i in range(k) for j in range(i, k)])
    return named.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), means.alias("means"), cross.alias("cross"))


class RowSpace:
    """What a symmetric non-negative matrix of columns can tell apart."""

    def __init__(self, m):
        size = np.diag(m)
        self.scale = np.sqrt(np.where(size > 0, size, 1.0))
        corr = m / np.outer(self.scale, self.scale)
        self.inverse = np.linalg.pinv(corr, rcond=1e-10, hermitian=True)
        self.projection = self.inverse @ corr

    def holds(self, l):
        """Whether the combination ``l`` of the columns' effects can be estimated."""
        v = np.asarray(l, float) / self.scale
        return bool(np.abs(v @ self.projection - v).max(initial=0.0) <= 1e-6 * np.abs(v).max(initial=0.0))


class _Fit:
    """Least squares from one Gram row; collinear columns are absorbed by a pseudo-inverse.

    A combination of slopes outside the row space of the design (an absent arm or level, collinear columns) has no
    estimate: it is NaN here and null in results.
    """

    def __init__(self, n, means, cross, k):
        c = np.zeros((k, k))
        c[np.triu_indices(k)] = np.asarray(cross, float)
        c = (c + np.triu(c, 1).T) * n
        sxx, sxy, syy = c[:-1, :-1], c[:-1, -1], c[-1, -1]
        self.n, self.xbar, self.ybar = n, np.asarray(means[:-1], float), float(means[-1])
        self.space = RowSpace(sxx)
        scale = self.space.scale
        corr = sxx / np.outer(scale, scale)
        self.inv = self.space.inverse / np.outer(scale, scale)
        self.beta = self.inv @ sxy
        self.rank = 1 + (int(np.linalg.matrix_rank(corr, tol=1e-10, hermitian=True)) if k > 1 else 0)
        self.df = n - self.rank
        self.sse = max(float(syy - sxy @ self.beta), 0.0)
        self.s2 = self.sse / self.df if self.df > 0 else np.nan
        self.sst, self.sxx, self.sxy = float(syy), sxx, sxy

    def mean_at(self, x):
        """Prediction and standard error at covariate vector x."""
        d = np.asarray(x, float) - self.xbar
        if not self.space.holds(d):
            return np.nan, np.nan
        return self.ybar + d @ self.beta, float(np.sqrt(self.s2 * (1.0 / self.n + d @ self.inv @ d)))

    def combo(self, l):
        """Estimate and standard error of a combination of slopes."""
        l = np.asarray(l, float)
        if not self.space.holds(l):
            return np.nan, np.nan
        return float(l @ self.beta), float(np.sqrt(max(self.s2 * (l @ self.inv @ l), 0.0)))

    def term_f(self, idx):
        """F of dropping the columns ``idx`` from the model."""
        rest = [i for i in range(len(self.beta)) if i not in idx]
        sub = self.sxx[np.ix_(rest, rest)]
        explained = self.sxy[rest] @ np.linalg.pinv(sub, hermitian=True) @ self.sxy[rest] if rest else 0.0
        full_rank = self.rank - 1
        sub_rank = int(np.linalg.matrix_rank(sub, hermitian=True)) if rest else 0
        q = full_rank - sub_rank
        gain = (self.sst - explained) - self.sse
        return (gain / q / self.s2 if q > 0 and self.s2 > 0 else np.nan), q


_RESULT = "kind string, term string, estimate double, se double, df double, statistic double, p double, lower double, upper double"


def _inference(kind, term, est, se, df, level=0.95):
    t = est / se if se > 0 else np.nan
    q = special.t_quantile(0.5 + level / 2, df) if df > 0 else np.nan
    return (kind, term, est, se, df, t, float(special.t_sf2(t, df)) if df > 0 else np.nan, est - q * se, est + q * se)


def _solve_udf(design: Design, contrasts: Mapping[str, Sequence[float]], level: float):
    terms, names = design.terms(), design.names()
    k = len(terms) + 1

    def grid_row(arm):
        """Reference grid: the arm set, other factors at equal weight, covariates at their means."""
        def value(fit, i):
            kind, name, lev = terms[i]
            if kind == "covariate":
                return fit.xbar[i]
            if name == design.treat:
                return 1.0 if lev == arm else 0.0
            return 1.0 / len(dict(design.factors)[name])
        return lambda fit: np.array([value(fit, i) for i in range(len(terms))])

    def rows(n, means, cross):
        if n < 2:
            return []
        fit = _Fit(float(n), means, cross, k)
        out = [_inference("coefficient", nm, *fit.combo(np.eye(k - 1)[i]), fit.df, level) for i, nm in enumerate(names)]
        groups = ([design.treat] if design.treat else []) + [f for f, _ in design.factors] + list(design.covariates)
        for g in groups:
            idx = [i for i, t in enumerate(terms) if t[1] == g]
            f, q = fit.term_f(idx)
            out.append(("type3", g, np.nan, np.nan, float(q), f, float(special.f_sf(f, q, fit.df)), np.nan, np.nan))
        out.append(("residual", "variance", fit.s2, np.nan, float(fit.df), np.nan, np.nan, np.nan, np.nan))
        out.append(("residual", "rank", float(fit.rank), np.nan, float(fit.df), np.nan, np.nan, np.nan, np.nan))
        at = {a: grid_row(a)(fit) for a in design.treat_levels}
        for a, x in at.items():
            est, se = fit.mean_at(x)
            out.append(_inference("lsmean", a, float(est), se, fit.df, level))
        for label, w in contrasts.items():
            l = sum(wi * at[a] for wi, a in zip(w, design.treat_levels))
            out.append(_inference("contrast", label, *fit.combo(l), fit.df, level))
        return out

    schema = f"array<struct<{_RESULT.replace(' ', ':').replace(',:', ',')}>>"
    fields = [c.strip().split(" ")[0] for c in _RESULT.split(",")]

    @F.pandas_udf(schema)
    def solve(n: pd.Series, means: pd.Series, cross: pd.Series) -> pd.Series:
        known = lambda v: None if isinstance(v, float) and np.isnan(v) else v
        return pd.Series([[dict(zip(fields, map(known, r))) for r in rows(a, b, c)] for a, b, c in zip(n, means, cross)])

    return solve


def linear_model(df: DataFrame, y: str, design: Design, contrasts: Mapping[str, Sequence[float]] | None = None,
                 by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """Fit one linear model per ``by`` group and return tidy result rows.

    Rows: coefficients, type III F per term, residual variance and rank, LS-means on
    an equally weighted reference grid, and contrasts with the given weights over
    the treatment levels. No multiplicity adjustment. What the data cannot estimate
    (an absent arm, a collinear column) keeps its row with nulls.
    """
    stats = gram(df, design, y, by)
    solve = _solve_udf(design, dict(contrasts or {}), level)
    return stats.withColumn("__r", F.explode(solve("n", "means", "cross"))).select(*by, "n", "__r.*")


def ancova(df: DataFrame, y: str, treat: str, levels: Sequence[str], factors: Mapping[str, Sequence[str]] | None = None,
           covariates: Sequence[str] = ("BASE",), contrasts: Mapping[str, Sequence[float]] | None = None,
           by: Sequence[str] = ()) -> DataFrame:
    """Change on treatment, factors and baseline; contrasts default to dose minus each earlier level."""
    design = Design(treat, tuple(levels), tuple((k, tuple(v)) for k, v in (factors or {}).items()), tuple(covariates))
    return linear_model(df, y, design, contrasts if contrasts is not None else dose_contrasts(levels), by)


def dose_contrasts(levels: Sequence[str]) -> dict[str, list[float]]:
    """Later minus earlier level, for every pair in level order."""
    out = {}
    for i, lo in enumerate(levels):
        for j in range(i + 1, len(levels)):
            out[f"{levels[j]} - {lo}"] = [1.0 if k == j else -1.0 if k == i else 0.0 for k in range(len(levels))]
    return out


def dose_response(df: DataFrame, y: str, dose: str, factors: Mapping[str, Sequence[str]] | None = None,
                  covariates: Sequence[str] = ("BASE",), by: Sequence[str] = ()) -> DataFrame:
    """Slope of the numeric dose as a continuous covariate."""
    design = Design(None, (), tuple((k, tuple(v)) for k, v in (factors or {}).items()), (dose, *covariates))
    return linear_model(df, y, design, None, by).filter((F.col("kind") == "coefficient") & (F.col("term") == dose))


def anova(df: DataFrame, y: str, treat: str, levels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance with the overall F and arm means."""
    return linear_model(df, y, Design(treat, tuple(levels)), dose_contrasts(levels), by)


#: Columns of a linear model beyond which its cross-products no longer fit one aggregate row.
MODEL_COLUMNS = 2_000


def factor_levels(df: DataFrame, column: str) -> list[str]:
    """Distinct levels of a model factor in text order.

    Raises when the levels alone make a model of more than ``MODEL_COLUMNS`` columns; the number is found by an aggregate
    before any level reaches the driver.
    """
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    n = levels.count()
    if n > MODEL_COLUMNS:
        raise ValueError(f"{column} has {n} levels, more than a model can hold; pool it before modelling")
    return sorted(r[0] for r in levels.collect())


# ---- contingency tables -------------------------------------------------------------


def contingency(df: DataFrame, row: str, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per cell, the only thing the tests below see."""
    return df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(*by, row, col).agg(
        F.count(F.lit(1)).alias("n"))


def chisq(df: DataFrame, row: str, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson chi-square with degrees of freedom and p, per ``by`` group.

    Statistic as N * (sum n^2 / (row total * column total) - 1), so only cells that
    occur are needed.
    """
    cells = contingency(df, row, col, by)
    keys = list(by)
    rows = cells.groupBy(*keys, row).agg(F.sum("n").alias("__r"))
    cols = cells.groupBy(*keys, col).agg(F.sum("n").alias("__c"))
    joined = cells.join(rows, [*keys, row]).join(cols, [*keys, col])
    n, one = F.sum("n"), F.lit(1)
    stat = joined.groupBy(*keys).agg(
        n.alias("total"), (n * (F.sum(F.col("n") * F.col("n") / (F.col("__r") * F.col("__c"))) - 1)).alias("statistic"))
    dims = rows.groupBy(*keys).agg(F.count(one).alias("nr")), cols.groupBy(*keys).agg(F.count(one).alias("nc"))
    for d in dims:
        stat = stat.join(d, keys) if keys else stat.crossJoin(d)
    tail = special.tail_udf("chisq")
    dof = (F.col("nr") - 1) * (F.col("nc") - 1)
    return stat.withColumn("df", dof).withColumn(
        "p", tail("statistic", F.col("df").cast("double"), F.lit(0.0))).drop("nr", "nc")


def fisher2x2(df: DataFrame, row: str, row_levels: Sequence[str], col: str, col_levels: Sequence[str],
              by: Sequence[str] = ()) -> DataFrame:
    """Two-sided exact test of a 2 x 2 table. Larger tables: use ``chisq``."""
    if len(row_levels) != 2 or len(col_levels) != 2:
        raise ValueError("fisher2x2 takes two rows and two columns; use chisq for larger tables")
    cell = lambda r, c: F.count_if((F.col(row) == r) & (F.col(col) == c)).cast("double")
    names = ["n11", "n12", "n21", "n22"]
    counts = df.groupBy(*by).agg(*[
        cell(r, c).alias(n) for n, (r, c) in zip(names, [(r, c) for r in row_levels for c in col_levels])])

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([special.hypergeom_two_sided(*x) for x in zip(a, b, c, d)], dtype=float)

    return counts.withColumn("p", exact(*names)).withColumn(
        "odds_ratio", F.try_divide(F.col("n11") * F.col("n22"), F.col("n12") * F.col("n21")))


def cmh(df: DataFrame, row: str, row_levels: Sequence[str], col: str, col_levels: Sequence[str],
        strata: Sequence[str] = (), kind: str = "general", row_scores: Sequence[float] | None = None,
        col_scores: Sequence[float] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cochran-Mantel-Haenszel: "general" association, "row_mean" scores or "correlation".

    Spark counts each stratum into one fixed-size table and its share of the
    statistic's mean and covariance; those are summed over strata by Spark too, so
    the number of strata is not limited. Strata with fewer than two subjects add
    nothing; a singular covariance is met by its pseudo-inverse.
    """
    nr, nc = len(row_levels), len(col_levels)
    rs = np.asarray(row_scores or range(1, nr + 1), float)
    cs = np.asarray(col_scores or range(1, nc + 1), float)
    if kind == "general":
        weights = np.kron(np.eye(nr)[:-1], np.eye(nc)[:-1])
    elif kind == "row_mean":
        weights = np.kron(np.eye(nr)[:-1], cs[None, :])
    else:
        weights = np.kron(rs[None, :], cs[None, :])
    q = weights.shape[0]

    @F.pandas_udf("array<double>")
    def stratum(tables: pd.Series) -> pd.Series:
        out = []
        for cells in tables:
            tab = np.asarray(cells, float).reshape(nr, nc)
            total = tab.sum()
            if total < 2:
                out.append(np.zeros(q + q * q))
                continue
            pr, pc = tab.sum(1) / total, tab.sum(0) / total
            diff = weights @ (tab - total * np.outer(pr, pc)).ravel()
            cov = total * total / (total - 1) * np.kron(np.diag(pr) - np.outer(pr, pr), np.diag(pc) - np.outer(pc, pc))
            out.append(np.concatenate([diff, (weights @ cov @ weights.T).ravel()]))
        return pd.Series(out)

    @F.pandas_udf("statistic double, df double, p double")
    def solve(sums: pd.Series) -> pd.DataFrame:
        rows = []
        for s in sums:
            s = np.asarray(s, float)
            diff, var = s[:q], s[q:].reshape(q, q)
            rank = int(np.linalg.matrix_rank(var, hermitian=True)) if var.any() else 0
            stat = float(diff @ np.linalg.pinv(var, hermitian=True) @ diff) if rank else np.nan
            rows.append((stat, float(rank), float(special.chi2_sf(stat, rank)) if rank else np.nan))
        return pd.DataFrame(rows, columns=["statistic", "df", "p"])

    cell = [F.count_if((F.col(row) == r) & (F.col(col) == c)) for r in row_levels for c in col_levels]
    tables = df.groupBy(*by, *strata).agg(F.array(*cell).alias("__t"))
    parts = tables.select(*by, stratum(F.col("__t").cast("array<double>")).alias("__s"))
    sums = parts.groupBy(*by).agg(F.array(*[F.sum(F.col("__s")[i]) for i in range(q + q * q)]).alias("__s"))
    return sums.withColumn("__r", solve("__s")).select(*by, F.lit(kind).alias("kind"), "__r.*")
