"""Display tables, listings and finding samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import fixed_text


def cell_text(ard_wide: DataFrame, template: str, decimals: Mapping[str, int]) -> Column:
    """Text of one cell from a template such as ``{mean} ({sd})``; null when any part is missing."""
    import re

    parts: list[Column] = []
    for text, stat in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if text:
            parts.append(F.lit(text))
        if stat:
            parts.append(fixed_text(F.col(stat), decimals[stat]))
    return F.concat(*parts)


def render_table(ard: DataFrame, layout: Sequence[tuple[str, str, Mapping[str, int]]], levels: Sequence[str],
                 rows: Sequence[str] = ("variable",), group: str = "group1_level") -> DataFrame:
    """Text table: one row per ``rows`` value and layout line, one column per level in level order.

    ``layout`` lists (label, template, decimals). All statistics are pivoted in one
    aggregate over the long table.
    """
    names = sorted({s for _, _, d in layout for s in d})
    wide = ard.groupBy(*rows, group).agg(*[F.max(F.when(F.col("stat_name") == s, F.col("stat"))).alias(s) for s in names])
    lines = F.array(*[
        F.struct(F.lit(i).alias("line"), F.lit(label).alias("label"), cell_text(wide, template, dec).alias("cell"))
        for i, (label, template, dec) in enumerate(layout)])
    cells = wide.select(*rows, group, F.explode(lines).alias("__l")).select(*rows, group, "__l.*")
    return cells.groupBy(*rows, "line", "label").agg(
        *[F.max(F.when(F.col(group) == l, F.col("cell"))).alias(l) for l in levels])


def listing(df: DataFrame, columns: Sequence[str], order: Sequence[str], where: str | None = None) -> DataFrame:
    """Chosen columns of the chosen records in order."""
    return (df if where is None else df.filter(where)).select(*columns).orderBy(*order)


# Order of finding severities.
SEVERITY_ORDER = {"blocked": 0, "clarification": 1, "gap": 2, "info": 3}


def sample_findings(findings: DataFrame, n: int = 25, order: Sequence[str] = ("check_id", "subject_key", "message")) -> DataFrame:
    """The first ``n`` findings, worst severity first, in a total order."""
    rank = F.coalesce(*[F.when(F.col("severity") == s, F.lit(i)) for s, i in SEVERITY_ORDER.items()], F.lit(len(SEVERITY_ORDER)))
    return findings.orderBy(rank, *order).limit(n)
