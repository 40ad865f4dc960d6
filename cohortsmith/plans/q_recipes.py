"""Recipes from the plan, and tables of recipes run in one pass."""

import json

from pyspark.sql import functions as F

from ..operators import catalogues as cat, derive as d, portfolio as p, recipes as rc
from .meta import sql, values
from .q_meta import _NUMBERED, _cands
from .q_models import _ANCOVA_ROWS, _GROUPS, _POOL
from .q_stats import _RANGES, _ranges
from .registry import query
from .views import ARM_LEVELS, VISITS, ae, endpoint, subjects, with_views

_LEAF = """'{{"order":{o},"condition":{{"variable":"{v}","comparator":"EQ","value":["' || {x} || '"]}}}}'"""
_TREE = """'{{"compoundExpression":{{"logicalOperator":"AND","whereClauses":[' || {} || ']}}}}'"""
_FLAG = _LEAF.format(o=1, v="ANL0@FL", x="'Y'").replace("@", "' || CASE imputation WHEN 'OC' THEN '2' ELSE '1' END || '")


@query("recipe_rows", sql("m_cand", f"""
  SELECT study_id, 'AN-' || substr(final_id, 3) AS analysis_id, substr(final_id, 3) AS table_id, title,
    CASE WHEN objectives <> '' OR endpoints <> '' THEN 'SPECIFIED IN SAP' ELSE 'CONVENTION' END AS reason, nullif(adam, '') AS dataset,
    {_TREE.format(_LEAF.format(o=1, v="' || CASE population WHEN 'Efficacy' THEN 'EFFFL' ELSE 'SAFFL' END || '", x="'Y'"))} AS analysis_set,
    CASE WHEN timepoint IS NOT NULL AND category = 'efficacy' THEN {_TREE.format(_LEAF.format(o=1, v="AVISIT", x="timepoint") + " || ',' || " + _FLAG.replace('"order":1', '"order":2'))}
      WHEN timepoint IS NOT NULL THEN {_TREE.format(_LEAF.format(o=1, v="AVISIT", x="timepoint"))} WHEN category = 'efficacy' THEN {_TREE.format(_FLAG)} END AS subset,
    CASE WHEN subgroup IS NOT NULL THEN {_TREE.format(_LEAF.format(o=1, v="SEX", x="substr(subgroup, 5, 1)"))} END AS subgroup,
    CASE WHEN category = 'efficacy' THEN 'CHG' ELSE 'AVAL' END AS response, CASE WHEN category = 'efficacy' THEN 'BASE' END AS baseline
  FROM (SELECT n.*, c.objectives, c.endpoints, c.adam, c.subgroup FROM num n JOIN (SELECT study_id, candidate_id, objectives, endpoints, adam, subgroup FROM m_cand) c
    ON c.study_id = n.study_id AND c.candidate_id = n.candidate_id) WHERE status = 'planned'""", num=_NUMBERED).replace("SELECT n.*, c.objectives", "SELECT n.study_id, n.candidate_id, n.final_id, n.title, n.population, n.timepoint, n.category, n.imputation, n.status, c.objectives"))
def _(spark, sf):
    return rc.recipe_rows(p.number_outputs(_cands(spark, sf)))


_OPS = [(m, i + 1, t, j + 1, o) for m in ("ANCOVA", "MMRM", "CMH", "Descriptive") for i, t in enumerate(cat.METHOD_TYPES[m]) for j, o in enumerate(cat.METHOD_OPERATIONS[t])]


@query("method_rows", sql("m_cand", f"""
  SELECT study_id, 'AN-' || substr(final_id, 3) AS analysis_id, mo::BIGINT AS method_order, mt AS method_type, oo::BIGINT AS operation_order, op AS operation
  FROM num JOIN {values(_OPS, 'r(m, mo, mt, oo, op)')} ON r.m = num.method WHERE status = 'planned'""", num=_NUMBERED))
def _(spark, sf):
    return rc.method_rows(p.number_outputs(_cands(spark, sf))).select("study_id", "analysis_id", "method_order", "method_type", "operation_order", "operation")


def _is(variable, comparator, *value):
    return {"condition": {"variable": variable, "comparator": comparator, "value": list(value)}}


def _and(*clauses):
    return json.dumps({"compoundExpression": {"logicalOperator": "AND", "whereClauses": [{"order": i, **c} for i, c in enumerate(clauses)]}})


_SCHEMA = "analysis_id string, method string, variables array<string>, by string, analysis_set string, subset string, subgroup string"
_POST = [x.label for x in VISITS[1:]]
#: Statistics at each visit in two sets, shifts at each visit, categories in two regions: one pass over one data set.
_FINDINGS = [(f"D-{f}-{n}", "Descriptive", ["AVAL", "CHG"], "PARAMCD", json.dumps(_is(f, "EQ", "Y")), json.dumps(_is("AVISIT", "EQ", n)), None)
             for f in ("ITTFL", "SAFFL") for n in _POST] + [
    (f"S-{n}", "ShiftTable", ["BNRIND", "ANRIND"], "PARAMCD", json.dumps(_is("SAFFL", "EQ", "Y")), json.dumps(_is("AVISIT", "EQ", n)), None) for n in _POST] + [
    (f"C-{r}-{k}", "Categories", ["ANRIND"], None, None, _and(_is("BASE", k, "20"), _is("PARAMCD", "IN", "view", "click")), json.dumps(_is("REGION", "EQ", r)))
    for r in ("0", "1") for k in ("GT", "LE")]
_BY_VISIT = "(SELECT r.*, 'Y' AS ITTFL, 'Y' AS SAFFL FROM rng r)"
_STATS = {"N": "CAST(count(v) AS DOUBLE)", "mean": "avg(v)", "sd": "stddev_samp(v)", "median": "median(v)", "min": "min(v)", "max": "max(v)"}
_COUNT_ROWS = """SELECT analysis_id, 'ARM' AS group1, ARM AS group1_level, {g2} AS group2, {l2} AS group2_level, variable, level AS variable_level, 'Counts' AS context, s AS stat_name,
    r6(CASE s WHEN 'n' THEN n WHEN 'N' THEN t ELSE 100.0 * n / t END) AS stat FROM (SELECT *, sum(n) OVER (PARTITION BY analysis_id, ARM, {l2}) AS t FROM ({src})) CROSS JOIN (VALUES ('n'), ('N'), ('p')) x(s)"""


@query("recipes_on_findings", with_views("analysis", "\nUNION ALL ".join(
    [f"""SELECT 'D-' || f || '-' || AVISIT AS analysis_id, 'ARM' AS group1, ARM AS group1_level, 'PARAMCD' AS group2, PARAMCD AS group2_level, variable, CAST(NULL AS VARCHAR) AS variable_level,
    'Descriptive' AS context, '{n}' AS stat_name, r6({e}) AS stat FROM (SELECT *, 'AVAL' AS variable, AVAL AS v FROM rng UNION ALL SELECT *, 'CHG', CHG FROM rng) CROSS JOIN (VALUES ('ITTFL'), ('SAFFL')) q(f)
    GROUP BY f, AVISIT, ARM, PARAMCD, variable""" for n, e in _STATS.items()] + [
     _COUNT_ROWS.format(g2="'PARAMCD'", l2="PARAMCD", src="SELECT 'S-' || AVISIT AS analysis_id, ARM, PARAMCD, 'BNRIND to ANRIND' AS variable, BNRIND || ' to ' || ANRIND AS level, count(*) AS n FROM rng GROUP BY ALL"),
     _COUNT_ROWS.format(g2="CAST(NULL AS VARCHAR)", l2="CAST(NULL AS VARCHAR)", src="""SELECT 'C-' || REGION || '-' || CASE WHEN BASE > 20 THEN 'GT' ELSE 'LE' END AS analysis_id, ARM, 'ANRIND' AS variable, ANRIND AS level, count(*) AS n
       FROM rng WHERE REGION IN ('0', '1') AND PARAMCD IN ('view', 'click') GROUP BY ALL""")]), rng=_RANGES))
def _(spark, sf):
    """Sixteen recipes of three methods from a recipe table, one scan of the data set."""
    df = _ranges(spark, sf).withColumns({"ITTFL": F.lit("Y"), "SAFFL": F.lit("Y")})
    return rc.run_recipes(df, rc.read_recipes(spark.createDataFrame(_FINDINGS, _SCHEMA)))


_EVENTS = [(f"I-{k}", "Incidence", ["AESOC", "AEDECOD"], None, json.dumps(_is("SAFFL", "EQ", "Y")), c, None) for k, c in (
    ("any", None), ("serious", json.dumps(_is("AESER", "EQ", "Y"))), ("severe", json.dumps(_is("AESEVN", "GE", "3"))),
    ("serious-severe", _and(_is("AESER", "EQ", "Y"), _is("AESEVN", "GE", "3"))))]


@query("recipes_on_events", with_views("teae subjects", """
  SELECT id AS analysis_id, 'ARM' AS group1, u.ARM AS group1_level, CAST(NULL AS VARCHAR) AS group2, CAST(NULL AS VARCHAR) AS group2_level, variable, level AS variable_level, 'Incidence' AS context,
    s AS stat_name, r6(CASE s WHEN 'n' THEN n WHEN 'events' THEN e WHEN 'N' THEN total ELSE 100.0 * n / total END) AS stat
  FROM (SELECT id, ARM, variable, level, count(DISTINCT USUBJID) AS n, count(*) AS e FROM (
      SELECT *, unnest(['AESOC', 'AEDECOD']) AS variable, unnest([AESOC, AEDECOD]) AS level FROM (SELECT * FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y')
        CROSS JOIN (VALUES ('I-any', 'N', 0), ('I-serious', 'Y', 0), ('I-severe', 'N', 3), ('I-serious-severe', 'Y', 3)) r(id, ser, sev))
      WHERE (ser = 'N' OR AESER = 'Y') AND AESEVN >= sev GROUP BY ALL) u
  JOIN (SELECT ARM, count(*) AS total FROM subjects WHERE SAFFL = 'Y' GROUP BY ARM) d ON d.ARM = u.ARM CROSS JOIN (VALUES ('n'), ('events'), ('N'), ('p')) x(s)"""))
def _(spark, sf):
    """Four incidence tables by class and term from one scan of the events, denominators from one of the subjects."""
    events = d.flag_teae(ae(spark, sf)).filter("TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y'")
    return rc.run_recipes(events, rc.read_recipes(spark.createDataFrame(_EVENTS, _SCHEMA)), subjects(spark, sf))


@query("recipes_ancova", with_views("endpoint", f"""
  SELECT 'A-' || PARAMCD AS analysis_id, variable_level, stat_name, r6(stat) AS stat FROM (
    SELECT PARAMCD, term AS variable_level, unnest(['estimate', 'se', 'df']) AS stat_name, unnest([estimate, se, df]) AS stat FROM ({_ANCOVA_ROWS})) WHERE PARAMCD IN ('view', 'click', 'purchase')""",
    gr=_GROUPS, pool=_POOL))
def _(spark, sf):
    """Three covariance analyses at the endpoint visit, fitted side by side."""
    rows = [(f"A-{x}", "ANCOVA", ["CHG"], None, None, json.dumps(_is("PARAMCD", "EQ", x)), None) for x in ("view", "click", "purchase")]
    recipes = rc.read_recipes(spark.createDataFrame(rows, _SCHEMA), levels=ARM_LEVELS)
    return rc.run_recipes(endpoint(spark, sf), recipes).select("analysis_id", "variable_level", "stat_name", "stat")
