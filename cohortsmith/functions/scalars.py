"""Scalar derivations as Column expressions; all stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- filters -------------------------------------------------------------

def apply_subset(df: DataFrame, *conditions: str) -> DataFrame:
    """Population and record filters given as SQL predicates, all of which must hold."""
    return reduce(lambda d, c: d.filter(F.expr(c)), [c for c in conditions if c], df)


_COMPARE = {
    "EQ": lambda c, v: c == v[0],
    "NE": lambda c, v: c != v[0],
    "GT": lambda c, v: c > v[0],
    "GE": lambda c, v: c >= v[0],
    "LT": lambda c, v: c < v[0],
    "LE": lambda c, v: c <= v[0],
    "IN": lambda c, v: c.isin(*v),
    "NOTIN": lambda c, v: ~c.isin(*v),
}


def where_clause(clause: Mapping) -> Column:
    """A structured clause as a Column.

    Leaves look like ``{"condition": {"variable", "comparator", "value"}}``,
    inner nodes like ``{"compoundExpression": {"logicalOperator", "whereClauses"}}``.
    Sub-clauses are folded by their ``order``. Text values compared with a numeric
    column are cast by Spark.
    """
    if "condition" in clause:
        leaf = clause["condition"]
        return _COMPARE[leaf["comparator"]](F.col(leaf["variable"]), list(leaf["value"]))
    node = clause["compoundExpression"]
    parts = [where_clause(c) for c in sorted(node["whereClauses"], key=lambda c: c.get("order", 0))]
    kind = node["logicalOperator"]
    if kind == "NOT":
        return ~parts[0]
    if kind not in ("AND", "OR"):
        raise ValueError(f"unknown logical operator {kind!r}")
    return reduce((lambda a, b: a & b) if kind == "AND" else (lambda a, b: a | b), parts)


# ---- dates ---------------------------------------------------------------

def derive_dt(df: DataFrame, dtc: str, prefix: str, highest: str | None = None,
              date_imputation: str = "first") -> DataFrame:
    """Add ``<prefix>DT`` and ``<prefix>DTF`` from a possibly partial ISO date text.

    ``highest`` is the largest part that may be filled in: None (no imputation),
    ``"D"`` (day) or ``"M"`` (month and day). The flag names the largest part that
    was filled in.
    """
    text = F.regexp_extract(F.col(dtc), r"^(\d{4}(?:-\d{2}(?:-\d{2})?)?)(?:T.*)?$", 1)
    first_of_month = F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd")
    first_of_year = F.try_to_date(F.concat(text, F.lit("-01-01")), "yyyy-MM-dd")
    if date_imputation == "last":
        month_fill, year_fill = F.last_day(first_of_month), F.last_day(F.add_months(first_of_year, 11))
    else:
        month_fill, year_fill = first_of_month, first_of_year
    size = F.length(text)
    date = F.when(size == 10, F.try_to_date(text, "yyyy-MM-dd"))
    flag = F.lit(None).cast("string")
    if highest in ("D", "M"):
        date = date.when(size == 7, month_fill)
        flag = F.when((size == 7) & month_fill.isNotNull(), F.lit("D"))
    if highest == "M":
        date = date.when(size == 4, year_fill)
        flag = flag.when((size == 4) & year_fill.isNotNull(), F.lit("M"))
    return df.withColumns({f"{prefix}DT": date, f"{prefix}DTF": flag})


def derive_dtm(df: DataFrame, dtc: str, prefix: str) -> DataFrame:
    """Add ``<prefix>DTM``: a date without a time gets midnight, a partial date null."""
    text = F.regexp_extract(F.col(dtc), r"^(\d{4}-\d{2}-\d{2})(?:T(\d{2}:\d{2}(?::\d{2})?))?", 1)
    time = F.regexp_extract(F.col(dtc), r"^(\d{4}-\d{2}-\d{2})(?:T(\d{2}:\d{2}(?::\d{2})?))?", 2)
    full = F.when(F.length(time) == 8, time).when(F.length(time) == 5, F.concat(time, F.lit(":00"))).otherwise("00:00:00")
    stamp = F.try_to_timestamp(F.concat_ws(" ", text, full), F.lit("yyyy-MM-dd HH:mm:ss"))
    return df.withColumn(f"{prefix}DTM", F.when(text != "", stamp))


def study_day(date: Column | str, ref: Column | str) -> Column:
    """Day relative to ``ref`` with no day 0."""
    d = F.datediff(_c(date), _c(ref))
    return F.when(d >= 0, d + 1).otherwise(d)


def duration(start: Column | str, end: Column | str) -> Column:
    """Inclusive number of days."""
    return F.datediff(_c(end), _c(start)) + 1


def months_between_days(start: Column | str, end: Column | str) -> Column:
    """Days from ``start`` to ``end`` in months of 30.4375 days."""
    return F.datediff(_c(end), _c(start)) / F.lit(30.4375)


def age_years(birth: Column | str, ref: Column | str) -> Column:
    """Completed years by the calendar: a birthday on 29 February is reached on 1 March of other years."""
    b, r = _c(birth), _c(ref)
    month, day = lambda c: F.month(c), lambda c: F.dayofmonth(c)
    early = (month(r) < month(b)) | ((month(r) == month(b)) & (day(r) < day(b)))
    return (F.year(r) - F.year(b) - early.cast("int")).cast("int")


# ---- values --------------------------------------------------------------

def band(col: Column | str, cuts: Sequence[tuple[str, float]], last: str | int) -> Column:
    """Label by the first matching cut, ``("<", 65, "<65")`` or ``("<=", 80, "65-80")``; null stays null."""
    c = _c(col)
    out = F.when(c.isNull(), F.lit(None))
    for op, bound, label in cuts:
        out = out.when(c < bound if op == "<" else c <= bound, F.lit(label))
    return out.otherwise(F.lit(last))


AGE_BANDS = ([("<", 65, "<65"), ("<=", 80, "65-80")], ">80")
BMI_BANDS = ([("<", 25, "<25"), ("<", 30, "25-<30")], ">=30")
DURATION_BANDS = ([("<", 12, "<12")], ">=12")


def code_map(col: Column | str, mapping: Mapping) -> Column:
    """Value to code by a literal map; unknown values give null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _c(col))


def bmi(weight: Column | str, height: Column | str) -> Column:
    """Kilograms over squared metres, one decimal."""
    return display_round(_c(weight) / F.pow(_c(height) / 100.0, 2), 1)


def bsa(weight: Column | str, height: Column | str) -> Column:
    """Body surface area after Mosteller, from kilograms and centimetres."""
    return F.sqrt(_c(height) * _c(weight) / 3600.0)


def range_indicator(v: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """LOW, NORMAL or HIGH; null when the value or a bound is null."""
    v, lo, hi = _c(v), _c(lo), _c(hi)
    return (
        F.when(v.isNull() | lo.isNull() | hi.isNull(), F.lit(None))
        .when(v < lo, "LOW").when(v > hi, "HIGH").otherwise("NORMAL")
    )


def shift_label(base: Column | str, post: Column | str) -> Column:
    """``<base> to <post>``; a missing side reads NULL."""
    return F.concat_ws(" to ", F.coalesce(_c(base), F.lit("NULL")), F.coalesce(_c(post), F.lit("NULL")))


def chg(aval: Column | str = "AVAL", base: Column | str = "BASE") -> Column:
    return _c(aval) - _c(base)


def pchg(chg_: Column | str = "CHG", base: Column | str = "BASE") -> Column:
    """Percent change; null for a zero baseline."""
    return F.try_divide(100.0 * _c(chg_), _c(base))


def display_round(x: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the binary value; a negative zero becomes zero.

    From 2^53 / 10^digits on a double has no such decimals, and the value stays as it is.
    """
    x, scale = _c(x), float(10 ** digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + F.lit(0.0)
    return F.when(F.abs(x) * scale >= float(2**53), x.cast("double")).otherwise(rounded)


def fixed_text(x: Column | str, digits: int = 0) -> Column:
    """Rounded value as text with fixed decimals; null stays null."""
    x = _c(x)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", display_round(x, digits)))


def treatment_columns(df: DataFrame) -> DataFrame:
    """Record-level treatment columns copied from the subject-level ones that exist."""
    pairs = {"TRTP": "TRT01P", "TRTA": "TRT01A", "TRTPN": "TRT01PN", "TRTAN": "TRT01AN"}
    return df.withColumns({new: F.col(old) for new, old in pairs.items() if old in df.columns})


def qualified_param(*parts: Column | str) -> Column:
    """Test code with its qualifiers, joined by an underscore; null parts are skipped."""
    return F.concat_ws("_", *[_c(p) for p in parts])


# ---- text ----------------------------------------------------------------

_POPULATION_WORDS = ("safety", "efficacy", "intent-to-treat", "itt", "completers", "all subjects")
_QUALIFIER_WORDS = ("completers", "observed cases", "windowed", "locf", "oc", "male subjects", "female subjects")


def normalise_title(title: Column | str, study_id: Column | str | None = None) -> Column:
    """Title core for duplicate search: lower case, no study id, population in parentheses, qualifiers or punctuation."""
    t = F.lower(_c(title))
    if study_id is not None:
        t = F.regexp_replace(t, F.concat(F.lit(r"(?<!\w)\Q"), F.lower(_c(study_id)), F.lit(r"\E(?!\w)")), F.lit(" "))
    t = F.regexp_replace(t, r"\((?:[^)]*\bpopulation\b[^)]*|" + "|".join(_POPULATION_WORDS) + r")\)", " ")
    t = F.regexp_replace(t, r"\b(?:" + "|".join(re.escape(w) for w in _QUALIFIER_WORDS) + r")\b", " ")
    t = F.regexp_replace(t, r"[^a-z0-9+ ]", " ")
    return F.trim(F.regexp_replace(t, r" +", " "))


# Instruments and safety phrases with the name, type and domain each stands for.
INSTRUMENTS = [
    ("(?i)total of 11 items|adas-cog ?\\(11\\)", "ADAS-Cog (11)", "continuous", "efficacy-cognition"),
    ("(?i)total of 14 items|adas-cog ?\\(14\\)", "ADAS-Cog (14)", "continuous", "efficacy-cognition"),
    ("(?i)cibic\\+", "CIBIC+", "global-impression", "efficacy-global"),
    ("(?i)npi-x", "NPI-X", "continuous", "efficacy-behavior"),
    ("(?i)\\bdad\\b", "DAD", "continuous", "efficacy-behavior"),
    ("(?i)adverse events", "Adverse events", "event", "safety-ae"),
    ("(?i)vital signs", "Vital signs", "continuous", "safety-vs"),
    ("(?i)laboratory evaluations", "Laboratory evaluations", "continuous", "safety-lab"),
    ("(?i)cmax|auc|pharmacokinetic", "PK parameters", "continuous", "pk"),
    ("(?i)\\btime to\\b", "Time to event", "event", "other"),
    ("(?i)\\bnumber of\\b", "Count", "count", "other"),
    ("(?i)\\bordinal\\b|response categor", "Ordinal response", "ordinal", "other"),
    ("(?i)shift|frequency", "Category", "categorical", "other"),
]


def parse_endpoint(df: DataFrame, text: str = "TEXT") -> DataFrame:
    """Add RESOLVED, MEASURE, MEASURE_TYPE, DOMAIN_HINT, TIMEPOINTS and WINDOWED from endpoint text.

    A placeholder or blank text is unresolved and gets no parsed values.
    """
    t = F.col(text)
    resolved = ~(t.isNull() | (F.trim(t) == "") | t.rlike(r"(?i)\*\*\* *to be determined|to be determined from protocol"))

    found = F.coalesce(*[
        F.when(t.rlike(words), F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(domain).alias("domain")))
        for words, name, kind, domain in INSTRUMENTS])
    spans = F.regexp_extract_all(t, F.lit(r"(?i)(weeks? \d+(?:(?:, *| and | & |, and )\d+)*)"), F.lit(1))
    weeks = F.flatten(F.transform(spans, lambda s: F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1))))
    points = F.array_distinct(F.transform(weeks, lambda w: F.concat(F.lit("Week "), w.cast("int").cast("string"))))
    # a one-element inline keeps later filters from copying the parsing below it
    parsed = F.struct(
        resolved.alias("RESOLVED"), F.when(resolved, found).alias("__found"),
        F.when(resolved, points).otherwise(F.array().cast("array<string>")).alias("TIMEPOINTS"),
        F.coalesce(resolved & t.rlike(r"(?i)from week \d+ to week \d+"), F.lit(False)).alias("WINDOWED"))
    return df.select("*", F.inline(F.array(parsed))).withColumns({
        "MEASURE": F.col("__found.name"),
        "MEASURE_TYPE": F.col("__found.kind"),
        "DOMAIN_HINT": F.when(F.col("RESOLVED"), F.coalesce("__found.domain", F.lit("other"))),
    }).drop("__found")


# Level codes and the level each stands for.
LEVEL_CODES = {
    "C85826": "Primary",
    "C85827": "Secondary",
    "C85828": "Exploratory",
    "C94496": "Primary",
    "C139173": "Secondary",
    "C188874": "Exploratory",
}


def decode_level(code: Column | str, decode: Column | str) -> Column:
    """Level by code; an unknown code falls back to the label without its last word."""
    return F.coalesce(code_map(code, LEVEL_CODES), F.regexp_replace(_c(decode), r" (Objective|Endpoint)$", ""))


def infer_domains(role: Column | str, sources: Column | str) -> Column:
    """Source domains named as whole words in the role text, else all sources, else ``*``."""
    role, sources = F.upper(_c(role)), _c(sources)
    padded = F.concat(F.lit(" "), F.regexp_replace(role, r"\W+", " "), F.lit(" "))
    named = F.filter(sources, lambda d: F.contains(padded, F.concat(F.lit(" "), F.upper(d), F.lit(" "))))
    return (
        F.when(F.size(F.coalesce(named, F.array().cast("array<string>"))) > 0, named)
        .when(F.size(F.coalesce(sources, F.array().cast("array<string>"))) > 0, sources)
        .otherwise(F.array(F.lit("*")))
    )
