"""Analysis recipes as data, and one pass over a data set that answers all of them.

``recipe_rows`` and ``method_rows`` turn planned outputs into recipes: condition trees instead of text, and one row per
operation of each method. ``run_recipes`` compiles the trees to column conditions and tags every record with the recipes it
belongs to, so the data set is scanned once however many recipes read it, and one aggregate serves all of them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import where_clause
from . import catalogues as cat
from .ard import continuous_of_counts
from .groups import in_ranges, keyed_join
from .models import ancova

#: Recipes that one pass takes: each is a branch of the scan's expression, so their number is checked.
MOST_RECIPES = 1_000
KEY = ["analysis_id", "group1_level", "group2_level", "variable"]


# ---- recipes from the plan -----------------------------------------------------------


def _leaf(variable: Column | str, comparator: str, *values: Column) -> Column:
    name = F.lit(variable) if isinstance(variable, str) else variable
    return F.struct(F.struct(name.alias("variable"), F.lit(comparator).alias("comparator"), F.array(*values).alias("value")).alias("condition"))


def _all_of(*leaves: Column) -> Column:
    """A clause tree as JSON in which every given leaf must hold; null without any."""
    have = F.array_compact(F.array(*leaves))
    numbered = F.transform(have, lambda x, i: F.struct((i + 1).alias("order"), x["condition"].alias("condition")))
    tree = F.struct(F.struct(F.lit("AND").alias("logicalOperator"), numbered.alias("whereClauses")).alias("compoundExpression"))
    return F.when(F.size(have) > 0, F.to_json(tree))


def _flag(table: Mapping[str, tuple[str, str]], by: str) -> Column:
    """The leaf that a fixed map gives for a column's value, null where it gives none."""
    return F.coalesce(*[F.when(F.col(by) == k, _leaf(v[0], "EQ", F.lit(v[1]))) for k, v in table.items()])


def recipe_rows(numbered: DataFrame) -> DataFrame:
    """One recipe per planned output, its conditions as clause trees (JSON as ``where_clause`` reads it).

    ``analysis_set`` comes from the population, ``subset`` from timepoint and imputation of efficacy outputs, ``subgroup``
    from ``Variable=level``. ``dataset`` is the first data set needed besides the subject table, else that one. Reason: a recipe
    that goes back to an objective or endpoint is specified, any other is convention.
    """
    df = numbered.filter((F.col("status") == "planned") & F.col("final_id").isNotNull())
    table_id = F.regexp_replace("final_id", "^[TLF]-", "")
    other = F.filter("req_adam", lambda d: d != "ADSL")
    traced = (F.size("objective_ids") > 0) | (F.size("endpoint_ids") > 0)
    efficacy = F.col("category") == "efficacy"
    week = F.col("timepoint").rlike(r"^Week \d+$")
    group = F.split("subgroup", "=")
    return df.select(
        "study_id", F.concat(F.lit("AN-"), table_id).alias("analysis_id"), table_id.alias("table_id"), "title",
        F.when(traced, "SPECIFIED IN SAP").otherwise("CONVENTION").alias("reason"),
        F.coalesce(F.try_element_at(other, F.lit(1)), F.try_element_at("req_adam", F.lit(1))).alias("dataset"),
        _all_of(_flag(cat.POPULATION_FLAGS, "population")).alias("analysis_set"),
        _all_of(F.when(week, _leaf("AVISIT", "EQ", F.col("timepoint"))),
                F.when(efficacy, _flag(cat.RECORD_FLAGS, "imputation"))).alias("subset"),
        _all_of(F.when(F.size(group) == 2, _leaf(F.upper(group[0]), "EQ", F.when(group[0] == "Sex", F.substring(group[1], 1, 1)).otherwise(group[1])))).alias("subgroup"),
        F.when(efficacy, "CHG").otherwise("AVAL").alias("response"), F.when(efficacy, "BASE").alias("baseline"))


def method_rows(numbered: DataFrame) -> DataFrame:
    """One row per planned output, method and operation, in order.

    The planner's method names one or more methods; a comparison that asks for a test adds it. Listings and methods without operations
    have no rows.
    """
    df = numbered.filter((F.col("status") == "planned") & F.col("final_id").isNotNull())
    text = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    base = F.coalesce(*[F.when(F.col("method") == k, text(v)) for k, v in cat.METHOD_TYPES.items()], F.array(F.col("method")))
    more = F.array_compact(F.array(*[F.when((F.col("method") == m) & F.lower("comparison").contains(w), F.lit(t)) for m, w, t in cat.METHOD_ADDITIONS]))
    steps = F.coalesce(*[F.when(F.col("method_type") == k, text(v)) for k, v in cat.METHOD_OPERATIONS.items()], text([]))
    return df.select(
        "study_id", F.concat(F.lit("AN-"), F.regexp_replace("final_id", "^[TLF]-", "")).alias("analysis_id"),
        F.posexplode(F.concat(base, more)).alias("method_order", "method_type")).select(
        "study_id", "analysis_id", (F.col("method_order") + 1).alias("method_order"), "method_type",
        F.posexplode(steps).alias("operation_order", "operation")).withColumn("operation_order", F.col("operation_order") + 1)


# ---- recipes that run ----------------------------------------------------------------


@dataclass(frozen=True)
class Recipe:
    """What one analysis reads and computes.

    ``method`` is Descriptive (statistics of ``variables``), Categories (records per value of each variable), ShiftTable (records
    per pair of the two ``variables``), Incidence (subjects and events per value) or ANCOVA (the first variable on the arm and
    ``baseline``). ``clauses`` are trees as ``where_clause`` reads them; all must hold.
    """

    analysis_id: str
    method: str
    variables: tuple[str, ...]
    arm: str = "ARM"
    by: str | None = None
    clauses: tuple[Mapping, ...] = ()
    analysis_set: Mapping | None = None
    baseline: str = "BASE"
    levels: tuple[str, ...] = field(default=())

    def condition(self) -> Column:
        return _holds([*([self.analysis_set] if self.analysis_set else []), *self.clauses])


def _holds(clauses: Sequence[Mapping]) -> Column:
    return reduce(lambda a, b: a & b, [where_clause(c) for c in clauses], F.lit(True))


def read_recipes(rows: DataFrame, arm: str = "ARM", levels: Sequence[str] = ()) -> list[Recipe]:
    """Recipes out of a table with analysis_id, method, variables (array), by, analysis_set, subset and subgroup (JSON trees or null).

    A recipe table is a plan for one data set of one study, so it is read to the driver; more than ``MOST_RECIPES`` rows are refused.
    """
    found = rows.select("analysis_id", "method", "variables", "by", "analysis_set", "subset", "subgroup").limit(MOST_RECIPES + 1).collect()
    if len(found) > MOST_RECIPES:
        raise ValueError(f"more than {MOST_RECIPES} recipes for one data set")
    tree = lambda text: json.loads(text) if text else None
    return [Recipe(r["analysis_id"], r["method"], tuple(r["variables"]), arm, r["by"],
                   tuple(t for t in (tree(r["subset"]), tree(r["subgroup"])) if t), tree(r["analysis_set"]), levels=tuple(levels)) for r in found]


def _text(c: str | None) -> Column:
    return F.lit(None).cast("string") if c is None else F.col(c).cast("string")


def _entries(r: Recipe, subject: str) -> list[Column]:
    """One struct per value that the recipe takes from a record."""
    def entry(variable: str, value: Column, level: Column, who: Column) -> Column:
        return F.struct(F.lit(r.analysis_id).alias("analysis_id"), _text(r.arm).alias("group1_level"), _text(r.by).alias("group2_level"),
                        F.lit(variable).alias("variable"), value.cast("double").alias("value"), level.alias("level"), who.alias("subject"))

    none = F.lit(None).cast("string")
    if r.method == "Descriptive":
        return [entry(v, F.col(v), none, none) for v in r.variables]
    if r.method == "Categories":
        return [entry(v, F.lit(None), _text(v), none) for v in r.variables]
    if r.method == "ShiftTable":
        base, post = r.variables
        return [entry(f"{base} to {post}", F.lit(None), F.concat_ws(" to ", F.coalesce(_text(base), F.lit("Missing")), F.coalesce(_text(post), F.lit("Missing"))), none)]
    if r.method == "Incidence":
        return [entry(v, F.lit(None), _text(v), F.col(subject).cast("string")) for v in r.variables]
    raise ValueError(f"unknown method {r.method!r}")


def tag(df: DataFrame, recipes: Sequence[Recipe], subject: str = "USUBJID") -> DataFrame:
    """Each record once per recipe and value that takes it, from one scan."""
    out = [F.when(r.condition(), e) for r in recipes for e in _entries(r, subject)]
    return df.select(F.inline(F.array_compact(F.array(*out))))


def population_counts(adsl: DataFrame, recipes: Sequence[Recipe]) -> DataFrame:
    """Subjects per recipe and arm in its analysis set, from one scan of the subject table."""
    out = [F.when(_holds([r.analysis_set] if r.analysis_set else []), F.struct(F.lit(r.analysis_id).alias("analysis_id"), _text(r.arm).alias("group1_level")))
           for r in recipes]
    return _counted(adsl.select(F.inline(F.array_compact(F.array(*out)))), ["analysis_id", "group1_level"], "N")


def _counted(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def _long(wide: DataFrame, context: str, level: Column, stats: Sequence[str]) -> DataFrame:
    rows = wide.select(*KEY, level.cast("string").alias("variable_level"), F.lit(context).alias("context"),
                       *[F.col(s).cast("double").alias(s) for s in stats])
    return rows.unpivot([*KEY, "variable_level", "context"], list(stats), "stat_name", "stat")


def run_recipes(df: DataFrame, recipes: Sequence[Recipe], adsl: DataFrame | None = None, subject: str = "USUBJID") -> DataFrame:
    """The statistics of all recipes on one data set, in long form.

    Descriptive: N, mean, sd, median, min and max per group and variable (a group without a value has N = 0). Categories and
    ShiftTable: n, N (records of the group) and p per level. Incidence: n (subjects), events, N (subjects of the analysis set in
    ``adsl``) and p. ANCOVA: estimate, se and df of adjusted means and contrasts, all recipes of one list of arms in one fit per
    recipe from one scan. The other methods share one scan and one aggregate. A recipe that no record meets has no rows; a null arm
    or level is a group of its own.
    """
    if len(recipes) > MOST_RECIPES:
        raise ValueError(f"more than {MOST_RECIPES} recipes for one data set")
    if len({r.analysis_id for r in recipes}) < len(recipes):
        raise ValueError("recipes of one data set need different ids")
    parts = []
    of = lambda *methods: [r for r in recipes if r.method in methods]
    models, counted = of("ANCOVA"), [r for r in recipes if r.method != "ANCOVA"]
    if counted:
        full = [*KEY, "level", "subject", "value"]
        counts = in_ranges(_counted(tag(df, counted, subject), full, "__n"), KEY, "value")
        ids = lambda rs: F.col("analysis_id").isin([r.analysis_id for r in rs])
        if of("Descriptive"):
            parts.append(_long(continuous_of_counts(counts.filter(ids(of("Descriptive"))), KEY, {"median": 0.5}), "Descriptive", F.lit(None),
                               ["N", "mean", "sd", "median", "min", "max"]))
        records = of("Categories", "ShiftTable")
        if records:
            n = counts.filter(ids(records)).groupBy(*KEY, "level").agg(F.sum("__n").alias("n"))
            parts.append(_long(keyed_join(n, n.groupBy(*KEY).agg(F.sum("n").alias("N_")), KEY).select(
                *KEY, "level", "n", F.col("N_").alias("total")).withColumn("p", F.try_divide(100.0 * F.col("n"), F.col("total"))),
                "Counts", F.col("level"), ["n", "total", "p"]).replace({"total": "N"}, subset="stat_name"))
        seen = of("Incidence")
        if seen:
            if adsl is None:
                raise ValueError("incidence needs the subject table")
            per_subject = counts.filter(ids(seen)).groupBy(*KEY, "level", "subject").agg(F.sum("__n").alias("events"))
            n = per_subject.groupBy(*KEY, "level").agg(F.count("subject").alias("n"), F.sum("events").alias("events"))
            wide = keyed_join(n, population_counts(adsl, seen).withColumnRenamed("N", "total"), ["analysis_id", "group1_level"])
            wide = wide.withColumn("total", F.coalesce("total", F.lit(0))).withColumn("p", F.try_divide(100.0 * F.col("n"), F.col("total")))
            parts.append(_long(wide, "Incidence", F.col("level"), ["n", "events", "total", "p"]).replace({"total": "N"}, subset="stat_name"))
    for levels in dict.fromkeys(r.levels for r in models):
        parts.append(_fits(df, [r for r in models if r.levels == levels], levels))
    if not parts:
        raise ValueError("no recipes")
    names = {g: F.create_map(*[F.lit(x) for r in recipes if getattr(r, a) for x in (r.analysis_id, getattr(r, a))])
             for g, a in (("group1", "arm"), ("group2", "by")) if any(getattr(r, a) for r in recipes)}
    named = lambda g: (F.try_element_at(names[g], F.col("analysis_id")) if g in names else F.lit(None)).cast("string").alias(g)
    out = reduce(DataFrame.unionByName, parts)
    return out.select("analysis_id", named("group1"), "group1_level", named("group2"), "group2_level", "variable", "variable_level", "context", "stat_name", "stat")


def _fits(df: DataFrame, models: Sequence[Recipe], levels: Sequence[str]) -> DataFrame:
    """Adjusted means and contrasts of several recipes, told apart by their id as one more group of the fit."""
    out = [F.when(r.condition(), F.struct(F.lit(r.analysis_id).alias("analysis_id"), _text(r.arm).alias("__arm"), _text(r.by).alias("group2_level"),
                                          F.lit(r.variables[0]).alias("variable"), F.col(r.variables[0]).cast("double").alias("__y"),
                                          F.col(r.baseline).cast("double").alias("__base"))) for r in models]
    rows = df.select(F.inline(F.array_compact(F.array(*out))))
    fit = ancova(rows, "__y", "__arm", list(levels), covariates=("__base",), by=["analysis_id", "group2_level", "variable"])
    shown = fit.filter("kind IN ('lsmean', 'contrast')").withColumn("group1_level", F.lit(None).cast("string"))
    return _long(shown, "ANCOVA", F.col("term"), ["estimate", "se", "df"])
