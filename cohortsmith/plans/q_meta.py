"""Sources, conformance, output planning, audit and lineage over study metadata."""

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import catalogues as cat, display as disp_, lineage as g, merge as m, portfolio as p, quality as q
from ..sources import readers as rd
from .meta import META, meta, sql, values
from .registry import query
from .views import table

# ---- text and codes ------------------------------------------------------------------

_PARSED = """SELECT study_id, objective_id, endpoint_id, level, text, text NOT LIKE '%To be determined%' AS RESOLVED,
  CASE WHEN text LIKE '%11 items%' THEN 'ADAS-Cog (11)' WHEN text LIKE '%14 items%' THEN 'ADAS-Cog (14)' WHEN text LIKE 'CIBIC%' THEN 'CIBIC+' WHEN text LIKE 'NPI-X%' THEN 'NPI-X'
    WHEN text LIKE 'Adverse%' THEN 'Adverse events' WHEN text LIKE 'Vital%' THEN 'Vital signs' WHEN text LIKE 'Labor%' THEN 'Laboratory evaluations' WHEN text LIKE 'Cmax%' THEN 'PK parameters'
    WHEN text LIKE 'Time to%' THEN 'Time to event' END AS MEASURE,
  CASE WHEN text LIKE '% items%' OR text LIKE 'NPI%' OR text LIKE 'Vital%' OR text LIKE 'Labor%' OR text LIKE 'Cmax%' THEN 'continuous' WHEN text LIKE 'CIBIC%' THEN 'global-impression'
    WHEN text LIKE 'Adverse%' OR text LIKE 'Time to%' THEN 'event' END AS MEASURE_TYPE,
  CASE WHEN text LIKE '% items%' THEN 'efficacy-cognition' WHEN text LIKE 'CIBIC%' THEN 'efficacy-global' WHEN text LIKE 'NPI%' THEN 'efficacy-behavior' WHEN text LIKE 'Adverse%' THEN 'safety-ae'
    WHEN text LIKE 'Vital%' THEN 'safety-vs' WHEN text LIKE 'Labor%' THEN 'safety-lab' WHEN text LIKE 'Cmax%' THEN 'pk' WHEN text LIKE 'Time to%' THEN 'other' END AS DOMAIN_HINT,
  CASE WHEN text LIKE '%14 items%' THEN 'Week 8,Week 16' WHEN text LIKE 'CIBIC%' THEN 'Week 8,Week 16,Week 24' WHEN text LIKE 'NPI%' THEN 'Week 4,Week 24'
    WHEN text LIKE '%Week %' THEN 'Week ' || regexp_extract(text, 'Week ([0-9]+)', 1) ELSE '' END AS POINTS, text LIKE 'NPI%' AS WINDOWED FROM m_end"""


def _ends(spark, sf):
    return s.parse_endpoint(meta(spark, sf, "m_end"), "text")


@query("read_domain", """
  SELECT c_custkey AS C_CUSTKEY, nullif(c_name, '') AS C_NAME, CAST(c_nationkey AS BIGINT) AS C_NATIONKEY, c_acctbal AS C_ACCTBAL, nullif(c_mktsegment, '') AS C_MKTSEGMENT FROM customer""")
def _(spark, sf):
    """A domain from its Parquet file: upper-case names, empty text as null."""
    return rd.read_domain(spark, sf, "CUSTOMER").withColumn("C_NATIONKEY", F.col("C_NATIONKEY").cast("bigint"))


@query("parse_endpoint", sql("m_end", "SELECT endpoint_id, RESOLVED, MEASURE, MEASURE_TYPE, DOMAIN_HINT, POINTS, WINDOWED FROM parsed", parsed=_PARSED))
def _(spark, sf):
    return _ends(spark, sf).select("endpoint_id", "RESOLVED", "MEASURE", "MEASURE_TYPE", "DOMAIN_HINT", F.array_join("TIMEPOINTS", ",").alias("POINTS"), "WINDOWED")


@query("decode_level", sql("m_obj", """SELECT objective_id, CASE code WHEN 'C85826' THEN 'Primary' WHEN 'C85827' THEN 'Secondary'
  ELSE replace(decode, ' Objective', '') END AS level FROM m_obj"""))
def _(spark, sf):
    return meta(spark, sf, "m_obj").select("objective_id", s.decode_level("code", "decode").alias("level"))


@query("normalise_title", sql("m_cand", "SELECT candidate_id, 'summary of measure ' || right(split_part(split_part(title, ' (', 1), ' - ', 1), 1) AS core FROM m_cand"))
def _(spark, sf):
    return meta(spark, sf, "m_cand").select("candidate_id", s.normalise_title("title", "study_id").alias("core"))


@query("infer_domains", sql("m_adam", """SELECT study_id, dataset, CASE WHEN sources = 'DM,DS' AND role LIKE '%DM and DS%' THEN 'DM,DS' WHEN sources = 'DM,DS' AND role LIKE '%dm data%' THEN 'DM'
  ELSE sources END AS domains FROM m_adam"""))
def _(spark, sf):
    return meta(spark, sf, "m_adam").select("study_id", "dataset", F.array_join(s.infer_domains("role", "sdtm_source"), ",").alias("domains"))


# ---- sources and conformance ------------------------------------------------------------


@query("flatten_study_documents", sql("m_end m_obj", """
  SELECT e.study_id, e.objective_id, o.level AS objective_level, e.endpoint_id, e.level, e.RESOLVED FROM parsed e JOIN (SELECT *, CASE code WHEN 'C85826' THEN 'Primary' WHEN 'C85827' THEN 'Secondary'
    ELSE replace(decode, ' Objective', '') END AS level FROM m_obj) o USING (study_id, objective_id)""", parsed=_PARSED))
def _(spark, sf):
    """Study documents built from the objectives and endpoints, then flattened again."""
    ends = meta(spark, sf, "m_end").groupBy("study_id", "objective_id").agg(F.collect_list(F.struct(
        F.col("endpoint_id").alias("id"), "text", F.struct(F.lit(None).cast("string").alias("code"), F.concat("level", F.lit(" Endpoint")).alias("decode")).alias("level"))).alias("endpoints"))
    objs = meta(spark, sf, "m_obj").join(ends, ["study_id", "objective_id"]).select("study_id", F.struct(
        F.col("objective_id").alias("id"), "text", F.struct("code", "decode").alias("level"), "endpoints").alias("o"))
    design = F.struct(F.collect_list("o").alias("objectives"))
    doc = objs.groupBy("study_id").agg(F.to_json(F.struct(F.struct(F.array(F.struct(F.array(design).alias("studyDesigns"))).alias("versions")).alias("study"))).alias("doc"))
    flat = rd.flatten_usdm(doc)
    return flat["endpoints"].join(flat["objectives"].select("study_id", "objective_id", F.col("level").alias("objective_level")), ["study_id", "objective_id"]).select(
        "study_id", "objective_id", "objective_level", "endpoint_id", "level", "RESOLVED")


@query("flatten_contents", sql("m_end", """
  SELECT DISTINCT study_id, 'main' AS list, 1::BIGINT AS depth, NULL AS output_id, objective_id AS name FROM m_end
  UNION ALL SELECT study_id, 'main', 2::BIGINT, 'OUT.' || endpoint_id, endpoint_id FROM m_end"""))
def _(spark, sf):
    """Lists of contents built from objectives and endpoints (twelve to a study), then flattened again."""
    item = F.struct(F.lit(2).alias("level"), F.lit(1).alias("order"), F.col("endpoint_id").alias("name"), F.concat(F.lit("OUT."), "endpoint_id").alias("outputId"))
    leaf = meta(spark, sf, "m_end").groupBy("study_id", "objective_id").agg(F.collect_list(item).alias("listItems"))
    top = F.struct(F.lit(1).alias("level"), F.col("objective_id").alias("name"), F.struct("listItems").alias("sublist"))
    root = F.struct(F.struct(F.struct(F.collect_list(top).alias("listItems")).alias("contentsList")).alias("mainListOfContents"))
    docs = leaf.groupBy("study_id").agg(F.to_json(root).alias("doc"))
    return rd.flatten_contents(docs).select("study_id", "list", "depth", "output_id", "name")


@query("variable_metadata", """
  SELECT 'ADORD' AS dataset, v AS variable, CAST(o AS BIGINT) AS order_number, t AS type, CAST(l AS BIGINT) AS max_length, nulls, false AS mandatory, 'Derived' AS origin, r AS role, p AS present, records, dv AS distinct_values
  FROM (SELECT 'O_ORDERSTATUS' AS v, 1 AS o, 'text' AS t, max(length(o_orderstatus)) AS l, count(*) FILTER (o_orderstatus IS NULL) AS nulls, 'status' AS r, true AS p, count(*) AS records, count(DISTINCT o_orderstatus) AS dv FROM orders
    UNION ALL SELECT 'ABSENT', 2, NULL, NULL, NULL, 'not there', false, count(*), NULL FROM orders
    UNION ALL SELECT 'O_CUSTKEY', 3, 'integer', max(length(CAST(o_custkey AS VARCHAR))), count(*) FILTER (o_custkey IS NULL), '', true, count(*), count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'O_ORDERPRIORITY', 4, 'text', max(length(o_orderpriority)), count(*) FILTER (o_orderpriority IS NULL), '', true, count(*), count(DISTINCT o_orderpriority) FROM orders)""")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return rd.variable_metadata(df, "ADORD", [("O_ORDERSTATUS", "status"), ("ABSENT", "not there")])


@query("inventory", """
  SELECT domain, variable, CAST(pos AS BIGINT) AS position, records FROM (
    SELECT 'REGION' AS domain, unnest(['R_REGIONKEY', 'R_NAME']) AS variable, unnest([1, 2]) AS pos, (SELECT count(*) FROM region) AS records
    UNION ALL SELECT 'SUPPLIER', unnest(['S_SUPPKEY', 'S_NAME', 'S_NATIONKEY', 'S_ACCTBAL']), unnest([1, 2, 3, 4]), (SELECT count(*) FROM supplier))""")
def _(spark, sf):
    return rd.inventory(spark, {t: table(spark, sf, t) for t in ("region", "supplier")}).select("domain", "variable", "position", "records")


@query("coerce_numeric", """SELECT CAST(l_quantity AS DOUBLE) AS q, l_returnflag, CASE WHEN l_linenumber = 1 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("string").alias("q"), "l_returnflag",
                                             F.when(F.col("l_linenumber") == 1, "x").otherwise(F.col("l_linenumber").cast("string")).alias("mixed"))
    return rd.coerce_numeric(df)


@query("dangling_refs", sql("m_cand m_end", """
  SELECT study_id, candidate_id AS owner, e AS ref, candidate_id || ': endpoint_ids refers to unknown endpoints ''' || e || '''' AS message
  FROM (SELECT study_id, candidate_id, unnest(string_split(endpoints, ',')) AS e FROM m_cand WHERE endpoints <> '') u
  WHERE NOT EXISTS (SELECT 1 FROM m_end d WHERE d.study_id = u.study_id AND d.endpoint_id = u.e AND d.level <> 'Exploratory')"""))
def _(spark, sf):
    uses = meta(spark, sf, "m_cand").select("study_id", F.col("candidate_id").alias("owner"), F.lit("endpoint_ids").alias("field"), F.lit("endpoints").alias("kind"),
                                            F.explode("endpoint_ids").alias("ref"))
    defs = meta(spark, sf, "m_end").filter("level <> 'Exploratory'").select("study_id", F.lit("endpoints").alias("kind"), F.col("endpoint_id").alias("ref"))
    return m.dangling_refs(uses, defs).select("study_id", "owner", "ref", "message")


@query("required_fields", sql("m_cand", """
  SELECT study_id, candidate_id AS subject_key, 'analyses needs ' || f AS message FROM (
    SELECT study_id, candidate_id, 'reason' AS f FROM m_cand WHERE regulatory_rule IS NULL UNION ALL SELECT study_id, candidate_id, 'timepoint' FROM m_cand WHERE timepoint IS NULL)"""))
def _(spark, sf):
    fields = F.map_from_arrays(F.array(F.lit("name"), F.lit("reason"), F.lit("timepoint")), F.array("title", "regulatory_rule", "timepoint"))
    objs = meta(spark, sf, "m_cand").select("study_id", F.lit("analyses").alias("kind"), F.col("candidate_id").alias("id"), fields.alias("fields"))
    return q.required_fields(objs, {"analyses": ["name", "reason", "timepoint"], "methods": ["id"]}).select("study_id", "subject_key", "message")


@query("spec_coverage", sql("m_adam m_cand", """
  SELECT dataset, count(*) FILTER (s AND d) AS n_present, count(*) FILTER (s AND NOT d) AS n_missing, count(*) FILTER (d AND NOT s) AS n_extra,
    CASE WHEN count(*) FILTER (s AND NOT d) = 0 THEN 'OK' ELSE 'blocked' END AS status FROM (
    SELECT dataset, variable, max(s) AS s, max(d) AS d FROM (SELECT study_id || dataset AS dataset, variable, true AS s, false AS d FROM m_adam
      UNION ALL SELECT study_id || adam, 'V' || (length(title) + 5), false, true FROM m_cand WHERE adam <> '') GROUP BY 1, 2) GROUP BY 1"""))
def _(spark, sf):
    spec = meta(spark, sf, "m_adam").select(F.concat("study_id", "dataset").alias("dataset"), "variable")
    data = meta(spark, sf, "m_cand").filter(F.size("req_adam") > 0).select(
        F.concat("study_id", F.element_at("req_adam", 1)).alias("dataset"), F.concat(F.lit("V"), F.length("title") + 5).alias("variable"))
    return m.spec_coverage(spec, data)[1]


# ---- profile and candidates ------------------------------------------------------------------

_TEXTS = """SELECT study_id, text FROM m_end UNION ALL SELECT study_id, name FROM m_arm UNION ALL SELECT study_id, title FROM m_study"""
_PROFILE = f"""SELECT st.study_id, phase, coalesce(n, 0) AS arm_count, CASE WHEN plc THEN 'placebo' WHEN n >= 2 THEN 'active' WHEN n = 1 THEN 'none' ELSE 'unknown' END AS control_type,
  CASE WHEN n = 1 THEN 'single-arm' WHEN n >= 2 THEN 'parallel' ELSE 'unknown' END AS design,
  CASE WHEN title LIKE '%double-blind%' THEN 'double-blind' WHEN title LIKE '%open-label%' THEN 'open-label' WHEN plc AND phase <> 'Phase I Trial' THEN 'double-blind' WHEN plc THEN 'single-blind' ELSE 'unknown' END AS blinding,
  phase <> 'Phase I Trial' AS multi_site, phase = 'Phase III Trial' AS needs_subgroup_by_sex, coalesce(pk, false) AS needs_pk, coalesce(derm, false) AS needs_tte_safety_figure, NOT coalesce(ae, false) AS not_covered_by_safety
  FROM m_study st LEFT JOIN (SELECT study_id, count(*) AS n, bool_or(type LIKE 'Placebo%') AS plc FROM m_arm GROUP BY 1) a USING (study_id)
  LEFT JOIN (SELECT study_id, bool_or(text LIKE 'Cmax%') AS pk, bool_or(text LIKE 'Time to derm%') AS derm, bool_or(text LIKE 'Adverse%') AS ae FROM ({_TEXTS}) GROUP BY 1) t USING (study_id)"""


def _profiles(spark, sf):
    return p.profile_studies(meta(spark, sf, "m_study"), _ends(spark, sf), meta(spark, sf, "m_arm"))


@query("profile_gates_from_inventory", sql("m_study m_inv", """
  SELECT study_id, EXISTS (SELECT 1 FROM m_inv i WHERE i.study_id = s.study_id AND domain = 'MH') AS medical_history_available,
    EXISTS (SELECT 1 FROM m_inv i WHERE i.study_id = s.study_id AND domain = 'DV') AS deviations_tracked FROM m_study s"""))
def _(spark, sf):
    """Gates that open by the raw domains a study holds."""
    out = p.profile_studies(meta(spark, sf, "m_study"), _ends(spark, sf), meta(spark, sf, "m_arm"), objectives=meta(spark, sf, "m_obj"), inventory=meta(spark, sf, "m_inv"))
    return out.select("study_id", "medical_history_available", "deviations_tracked")


@query("profile_studies", sql("m_study m_end m_arm", "SELECT * FROM prof", prof=_PROFILE))
def _(spark, sf):
    return _profiles(spark, sf).select("study_id", "phase", "arm_count", "control_type", "design", "blinding", "multi_site", "needs_subgroup_by_sex", "needs_pk", "needs_tte_safety_figure", "not_covered_by_safety")


@query("scaffolding", sql("m_study m_end m_arm", f"""
  SELECT study_id, c.* FROM prof CROSS JOIN {values([r for r in cat.SCAFFOLDING if r[5] in ('', 'multi_site', 'not_covered_by_safety')], 'c(candidate_id, title, type, category, regulatory_rule, gate, population)')}
  WHERE gate = '' OR (gate = 'multi_site' AND multi_site) OR (gate = 'not_covered_by_safety' AND not_covered_by_safety)""", prof=_PROFILE).replace("SELECT study_id, c.* FROM", "SELECT study_id, candidate_id, title, type, category, regulatory_rule, population FROM"))
def _(spark, sf):
    return p.scaffolding(_profiles(spark, sf)).select("study_id", "candidate_id", "title", "type", "category", "regulatory_rule", "population")


_EFF = f"""SELECT study_id, endpoint_id, lower('eff-' || endpoint_id || '-' || role || CASE WHEN multi THEN '-' || replace(t, ' ', '') ELSE '' END) AS candidate_id,
    MEASURE || ' - ' || method || coalesce(' - ' || t, '') AS title, method, type, t AS timepoint, CASE WHEN imp = 'strategy' THEN 'LOCF' ELSE 'none' END AS imputation, priority
  FROM (SELECT *, unnest(CASE WHEN multi THEN string_split(POINTS, ',') ELSE [CASE WHEN POINTS <> '' THEN replace(POINTS, ',', CASE WHEN WINDOWED THEN ' to ' ELSE ' & ' END) END] END) AS t FROM (
    SELECT e.*, r.*, per_time AND NOT WINDOWED AND POINTS LIKE '%,%' AS multi FROM parsed e JOIN {values(cat.EFFICACY, 'r(mt, lv, role, method, type, per_time, imp, priority)')}
      ON r.mt = e.MEASURE_TYPE AND r.lv = e.level WHERE RESOLVED AND (DOMAIN_HINT LIKE 'efficacy%' OR (DOMAIN_HINT = 'other' AND MEASURE_TYPE IS NOT NULL))))"""


@query("efficacy_outputs", sql("m_end", "SELECT study_id, candidate_id, title, method, type, timepoint, imputation, priority FROM eff", parsed=_PARSED, eff=_EFF))
def _(spark, sf):
    return p.efficacy(_ends(spark, sf)).select("study_id", "candidate_id", "title", "method", "type", "timepoint", "imputation", "priority")


@query("estimand_imputation", sql("m_end", """
  SELECT study_id, lower('eff-' || endpoint_id || '-ancova') AS candidate_id, CASE CAST(substr(endpoint_id, 2) AS BIGINT) % 5 WHEN 0 THEN 'LOCF' WHEN 1 THEN 'MI' ELSE 'none' END AS imputation
  FROM parsed WHERE RESOLVED AND level = 'Primary' AND MEASURE_TYPE = 'continuous' AND DOMAIN_HINT LIKE 'efficacy%'""", parsed=_PARSED))
def _(spark, sf):
    ends = _ends(spark, sf)
    names = F.array(*[F.lit(x) for x in cat.STRATEGY_IMPUTATION])
    est = ends.select("study_id", "endpoint_id", F.element_at(names, (F.substring("endpoint_id", 2, 20).cast("bigint") % 5 + 1).cast("int")).alias("strategy"))
    return p.efficacy(ends, est).filter("method = 'ANCOVA' AND priority = 'primary'").select("study_id", "candidate_id", "imputation")


_REGIONS = "SELECT DISTINCT concat('ST', CAST(floor(p_partkey / 12) AS BIGINT)) AS study_id, concat('R', p_size % 3) AS region FROM part WHERE p_partkey % 12 < 3"
_SAID = "CASE length(text) % 4 WHEN 0 THEN ' and deaths' WHEN 1 THEN ' by severity' WHEN 2 THEN ', events leading to discontinuation' ELSE ' by sex' END"


def _rich_profiles(spark, sf):
    k = F.length("text") % 4
    said = F.when(k == 0, " and deaths").when(k == 1, " by severity").when(k == 2, ", events leading to discontinuation").otherwise(" by sex")
    objectives = meta(spark, sf, "m_obj").filter("code = 'C85826'").withColumn("text", F.concat("text", said))
    return p.profile_studies(meta(spark, sf, "m_study"), _ends(spark, sf), meta(spark, sf, "m_arm"), objectives=objectives, regions=_regions(spark, sf))


def _regions(spark, sf):
    return spark.sql(_REGIONS.replace("FROM part", "FROM {part}"), part=table(spark, sf, "part"))


@query("profile_flags_from_data", sql("m_study m_obj", f"""
  SELECT s.study_id, coalesce(o.k = 0, false) AS reports_deaths, coalesce(o.k = 1, false) AS reports_ae_severity, coalesce(o.k = 2, false) AS reports_ae_discontinuation,
    phase = 'Phase III Trial' OR coalesce(o.k = 3, false) AS needs_subgroup_by_sex, coalesce(r.n > 1, false) AS needs_subgroup_by_region
  FROM m_study s LEFT JOIN (SELECT study_id, length(text) % 4 AS k FROM m_obj WHERE code = 'C85826') o ON o.study_id = s.study_id
  LEFT JOIN (SELECT study_id, count(*) AS n FROM reg GROUP BY 1) r ON r.study_id = s.study_id""", reg=_REGIONS))
def _(spark, sf):
    """Flags that objectives and the regions of a study's sites decide."""
    return _rich_profiles(spark, sf).select("study_id", "reports_deaths", "reports_ae_severity", "reports_ae_discontinuation", "needs_subgroup_by_sex", "needs_subgroup_by_region")


@query("expand_regions", sql("m_end", """
  SELECT e.study_id, candidate_id || '-locf-' || lower(region) || CASE WHEN timepoint LIKE '% & %' THEN '-' || lower(replace(t, ' ', '')) ELSE '' END AS candidate_id, 'Region=' || region AS subgroup, 'LOCF' AS imputation, 'supportive' AS priority
  FROM (SELECT *, unnest(CASE WHEN timepoint LIKE '% & %' THEN string_split(timepoint, ' & ') ELSE [timepoint] END) AS t FROM eff) e JOIN reg r ON r.study_id = e.study_id WHERE method = 'ANCOVA' AND priority = 'primary' AND e.study_id IN (SELECT study_id FROM reg GROUP BY 1 HAVING count(*) > 1)""", parsed=_PARSED, eff=_EFF, reg=_REGIONS))
def _(spark, sf):
    """One variant per region of a study's sites."""
    out = p.expand_variants(p.efficacy(_ends(spark, sf)), _rich_profiles(spark, sf), _regions(spark, sf))
    return out.filter("subgroup LIKE 'Region=%'").select("study_id", "candidate_id", "subgroup", "imputation", "priority")


@query("safety_outputs", sql("m_end m_study m_arm", f"""
  SELECT study_id, lower(replace(DOMAIN_HINT, 'safety-', '') || '-' || endpoint_id || '-' || slug) AS candidate_id, r.title, r.type, r.method, r.category, nullif(comparison, '') AS comparison
  FROM parsed JOIN prof USING (study_id) JOIN {values(cat.SAFETY, 'r(h, slug, title, type, method, category, gate, comparison)')} ON r.h = DOMAIN_HINT
  WHERE RESOLVED AND (gate = '' OR (gate = 'needs_tte_safety_figure' AND needs_tte_safety_figure))""", parsed=_PARSED, prof=_PROFILE))
def _(spark, sf):
    return p.safety(_ends(spark, sf), _profiles(spark, sf)).select("study_id", "candidate_id", "title", "type", "method", "category", "comparison")


@query("special_outputs", sql("m_end m_study m_arm", f"""
  SELECT study_id, r.candidate_id, r.title, r.type, r.method FROM prof JOIN {values(cat.SPECIAL, 'r(candidate_id, title, type, method, category, gate, a, s)')} ON gate = 'needs_pk' AND needs_pk""", prof=_PROFILE))
def _(spark, sf):
    return p.special(_profiles(spark, sf)).select("study_id", "candidate_id", "title", "type", "method")


@query("expand_variants", sql("m_end m_study m_arm", """
  SELECT study_id, candidate_id || coalesce('-' || tok, '') || CASE WHEN sp THEN '-' || lower(replace(t, ' ', '')) ELSE '' END AS candidate_id, method, t AS timepoint, imputation, subgroup, population, priority
  FROM (SELECT *, unnest(CASE WHEN timepoint LIKE '% & %' THEN string_split(timepoint, ' & ') ELSE [timepoint] END) AS t, coalesce(timepoint LIKE '% & %', false) AS sp FROM (
    SELECT study_id, candidate_id, method, timepoint, imputation, NULL AS subgroup, 'Efficacy' AS population, priority, NULL AS tok FROM eff WHERE NOT (method = 'ANCOVA' AND priority = 'primary')
    UNION ALL SELECT study_id, candidate_id, method, timepoint, v.imp, v.sub, v.pop, v.pri, v.tok FROM eff JOIN prof USING (study_id) JOIN (VALUES ('locf', 'LOCF', NULL, 'Efficacy', 'primary', false),
      ('oc', 'OC', NULL, 'Completers', 'supportive', false), ('locf-male', 'LOCF', 'Sex=Male', 'Efficacy', 'supportive', true), ('locf-female', 'LOCF', 'Sex=Female', 'Efficacy', 'supportive', true)) v(tok, imp, sub, pop, pri, sex)
      ON method = 'ANCOVA' AND priority = 'primary' AND (needs_subgroup_by_sex OR NOT sex)))""", parsed=_PARSED, eff=_EFF, prof=_PROFILE))
def _(spark, sf):
    return p.expand_variants(p.efficacy(_ends(spark, sf)), _profiles(spark, sf)).select(
        "study_id", "candidate_id", "method", "timepoint", "imputation", "subgroup", "population", "priority")


# ---- feasibility, numbering, audit -----------------------------------------------------------------


def _cands(spark, sf):
    return p.candidates(meta(spark, sf, "m_cand"))


_FEAS = """SELECT c.study_id, c.candidate_id, CASE WHEN o.e IS NOT NULL OR category = 'unmapped' THEN 'needs-clarification' WHEN x.d IS NOT NULL THEN 'blocked' ELSE 'planned' END AS status,
  CASE WHEN o.e IS NOT NULL THEN 'Traces to unresolved endpoint ' || o.e WHEN category = 'unmapped' THEN 'No source domain is known for unmapped' WHEN x.d IS NOT NULL THEN 'Missing raw domain ' || x.d END AS status_reason
  FROM m_cand c LEFT JOIN (SELECT u.study_id, candidate_id, min(e) AS e FROM (SELECT study_id, candidate_id, unnest(string_split(endpoints, ',')) AS e FROM m_cand WHERE endpoints <> '') u
      JOIN parsed p ON p.study_id = u.study_id AND p.endpoint_id = u.e AND NOT RESOLVED GROUP BY 1, 2) o USING (study_id, candidate_id)
  LEFT JOIN (SELECT u.study_id, candidate_id, string_agg(DISTINCT d, ', ' ORDER BY d) AS d FROM (SELECT study_id, candidate_id, unnest(string_split(raw, ',')) AS d FROM m_cand WHERE raw <> '') u
      WHERE NOT EXISTS (SELECT 1 FROM m_inv i WHERE i.study_id = u.study_id AND i.domain = u.d) GROUP BY 1, 2) x USING (study_id, candidate_id)"""


@query("feasibility", sql("m_cand m_end m_inv", "SELECT * FROM feas", parsed=_PARSED, feas=_FEAS))
def _(spark, sf):
    open_ = _ends(spark, sf).filter("NOT RESOLVED")
    return p.feasibility(_cands(spark, sf), open_, meta(spark, sf, "m_inv")).select("study_id", "candidate_id", "status", "status_reason")


_SECTION = "CASE category " + " ".join(f"WHEN '{c}' THEN '{sec}'" for c, _, _, sec in cat.CATEGORIES) + " ELSE '14-x' END"
_NUMBERED = f"""SELECT *, CASE WHEN status = 'planned' THEN CASE WHEN pf = 'F' THEN 'F-14-' || seq ELSE pf || '-' || section || '.' || CASE WHEN seq < 10 THEN '0' ELSE '' END || seq END END AS final_id FROM (
  SELECT *, row_number() OVER (PARTITION BY study_id, pf, CASE WHEN pf = 'F' THEN '' ELSE section END, status = 'planned' ORDER BY section, CASE priority WHEN 'primary' THEN 1 WHEN 'secondary' THEN 2 ELSE 3 END,
    coalesce(CAST(substr(timepoint, 6) AS INTEGER), 99999), CASE WHEN imputation = 'OC' THEN 2 WHEN subgroup = 'Sex=Male' THEN 3 WHEN subgroup = 'Sex=Female' THEN 4 WHEN method = 'Descriptive' THEN 6 WHEN method = 'MMRM' THEN 7 WHEN method = 'CMH' THEN 8 ELSE 1 END,
    candidate_id) AS seq FROM (SELECT *, {_SECTION} AS section, CASE type WHEN 'Figure' THEN 'F' WHEN 'Listing' THEN 'L' ELSE 'T' END AS pf FROM m_cand))"""


@query("number_outputs", sql("m_cand", "SELECT study_id, candidate_id, section, final_id FROM num", num=_NUMBERED))
def _(spark, sf):
    return p.number_outputs(_cands(spark, sf)).select("study_id", "candidate_id", "section", "final_id")


@query("reconcile_counts", sql("m_cand", f"""
  SELECT study_id, {_SECTION} AS section, count(*) FILTER (status = 'planned' AND type = 'Table') AS tables, count(*) FILTER (status = 'planned' AND type = 'Figure') AS figures,
    count(*) FILTER (status = 'planned' AND type = 'Listing') AS listings, count(*) FILTER (status = 'planned') AS planned, count(*) FILTER (status <> 'planned') AS flagged FROM m_cand GROUP BY 1, 2"""))
def _(spark, sf):
    return p.reconcile(p.number_outputs(_cands(spark, sf)))


_DUP = f"""SELECT *, first_value(candidate_id) OVER w AS survivor_id, count(*) OVER (PARTITION BY study_id, sec, core, method, population, timepoint, imputation, subgroup) AS n_merged FROM (
    SELECT *, {_SECTION} AS sec, 'summary of measure ' || right(split_part(split_part(title, ' (', 1), ' - ', 1), 1) AS core FROM m_cand)
  WINDOW w AS (PARTITION BY study_id, sec, core, method, population, timepoint, imputation, subgroup ORDER BY -(CASE WHEN raw = '' THEN 0 ELSE len(string_split(raw, ',')) END + CASE WHEN adam = '' THEN 0 ELSE 1 END),
    CASE WHEN method = 'Descriptive' THEN 1 ELSE 0 END, -(CASE WHEN endpoints <> '' THEN 2 ELSE 0 END + CASE WHEN objectives <> '' THEN 1 ELSE 0 END), CASE WHEN produced_by IN ('efficacy', 'safety') THEN 0 ELSE 1 END, candidate_id)"""


@query("dedup_candidates", sql("m_cand", "SELECT study_id, candidate_id, n_merged FROM dup WHERE candidate_id = survivor_id", dup=_DUP))
def _(spark, sf):
    return p.dedup_candidates(_cands(spark, sf))[0].select("study_id", "candidate_id", "n_merged")


@query("dedup_merge_log", sql("m_cand", "SELECT study_id, survivor_id, candidate_id AS merged_id, produced_by AS merged_from FROM dup WHERE candidate_id <> survivor_id", dup=_DUP))
def _(spark, sf):
    return p.dedup_candidates(_cands(spark, sf))[1]


@query("dedup_notes", sql("m_cand", """
  SELECT DISTINCT d.study_id, survivor_id AS candidate_id, unnest(['at ' || coalesce(c.timepoint, 'any time'), 'from ' || c.produced_by]) AS note
  FROM dup d JOIN m_cand c ON c.study_id = d.study_id AND c.candidate_id = d.candidate_id""", dup=_DUP))
def _(spark, sf):
    """Notes of merged candidates go on with their survivor."""
    cands = _cands(spark, sf).withColumn("notes", F.array(F.concat(F.lit("at "), F.coalesce("timepoint", F.lit("any time"))), F.concat(F.lit("from "), "produced_by")))
    return p.merged_notes(cands, p.dedup_candidates(cands)[1])


_COV = """SELECT e.study_id, e.objective_id, e.endpoint_id, RESOLVED, DOMAIN_HINT, coalesce(np, 0) AS n_planned, coalesce(na, 0) AS n_any,
  CASE WHEN NOT RESOLVED THEN 'clarification' WHEN np > 0 THEN 'covered' WHEN na > 0 THEN 'gap (blocked)' ELSE 'gap' END AS coverage
  FROM parsed e LEFT JOIN (SELECT study_id, e, count(*) FILTER (status = 'planned') AS np, count(*) AS na FROM (SELECT study_id, status, unnest(string_split(endpoints, ',')) AS e FROM m_cand WHERE endpoints <> '') GROUP BY 1, 2) u
    ON u.study_id = e.study_id AND u.e = e.endpoint_id"""


@query("endpoint_coverage", sql("m_cand m_end", "SELECT * FROM cov", parsed=_PARSED, cov=_COV))
def _(spark, sf):
    return p.coverage(_ends(spark, sf), _cands(spark, sf))


@query("objective_coverage", sql("m_cand m_end m_obj", """
  SELECT o.study_id, o.objective_id, CASE WHEN coalesce(c, false) OR d.objectives IS NOT NULL THEN 'covered' WHEN coalesce(cl, false) THEN 'clarification' ELSE 'gap' END AS coverage
  FROM m_obj o LEFT JOIN (SELECT study_id, objective_id, bool_or(coverage = 'covered') AS c, bool_and(coverage = 'clarification') AS cl FROM cov GROUP BY 1, 2) v USING (study_id, objective_id)
  LEFT JOIN (SELECT DISTINCT study_id, objectives FROM m_cand WHERE status = 'planned' AND objectives <> '') d ON d.study_id = o.study_id AND d.objectives = o.objective_id""", parsed=_PARSED, cov=_COV))
def _(spark, sf):
    c = _cands(spark, sf)
    return p.objective_coverage(meta(spark, sf, "m_obj"), p.coverage(_ends(spark, sf), c), c)


@query("route_gaps", sql("m_cand m_end", """SELECT study_id, endpoint_id, coverage, CASE WHEN coverage = 'gap (blocked)' THEN 'feasibility' WHEN DOMAIN_HINT LIKE 'efficacy%' THEN 'efficacy'
  WHEN DOMAIN_HINT LIKE 'safety%' THEN 'safety' ELSE 'special domains' END AS phase FROM cov WHERE coverage LIKE 'gap%'""", parsed=_PARSED, cov=_COV))
def _(spark, sf):
    return p.route_gaps(p.coverage(_ends(spark, sf), _cands(spark, sf)))


_PROV = """SELECT c.study_id, candidate_id, CASE WHEN objectives <> '' THEN 'objective-driven' WHEN endpoints <> '' THEN 'endpoint-driven' WHEN regulatory_rule IS NOT NULL THEN 'scaffolding' ELSE 'orphan' END AS provenance,
  (CASE WHEN objectives <> '' AND NOT EXISTS (SELECT 1 FROM m_obj o WHERE o.study_id = c.study_id AND o.objective_id = c.objectives) THEN 1 ELSE 0 END) +
  (CASE WHEN endpoints = '' THEN 0 ELSE len(string_split(endpoints, ',')) - (SELECT count(*) FROM parsed e WHERE e.study_id = c.study_id AND RESOLVED AND list_contains(string_split(c.endpoints, ','), e.endpoint_id)) END) AS bad_ids FROM m_cand c"""


@query("orphan_audit", sql("m_cand m_end m_obj", "SELECT * FROM prov", parsed=_PARSED, prov=_PROV))
def _(spark, sf):
    return p.orphans(_cands(spark, sf), meta(spark, sf, "m_obj"), _ends(spark, sf))


@query("verdict", sql("m_cand m_end m_obj", """
  SELECT *, CASE WHEN gaps > 0 OR orphans > 0 THEN 'gaps-found' WHEN clarifications > 0 OR soft_gaps > 0 OR bad_ids > 0 THEN 'clean-with-caveats' ELSE 'clean' END AS verdict FROM (
    SELECT coalesce(a.study_id, b.study_id) AS study_id, coalesce(covered, 0) AS covered, coalesce(gaps, 0) AS gaps, coalesce(soft_gaps, 0) AS soft_gaps, coalesce(clarifications, 0) AS clarifications, coalesce(orphans, 0) AS orphans, coalesce(bad_ids, 0)::BIGINT AS bad_ids
    FROM (SELECT study_id, count(*) FILTER (coverage = 'covered') AS covered, count(*) FILTER (coverage = 'gap') AS gaps, count(*) FILTER (coverage = 'gap (blocked)') AS soft_gaps, count(*) FILTER (coverage = 'clarification') AS clarifications FROM cov GROUP BY 1) a
    FULL JOIN (SELECT study_id, count(*) FILTER (provenance = 'orphan') AS orphans, sum(bad_ids) AS bad_ids FROM prov GROUP BY 1) b ON a.study_id = b.study_id)""", parsed=_PARSED, cov=_COV, prov=_PROV))
def _(spark, sf):
    c, e = _cands(spark, sf), _ends(spark, sf)
    return p.verdict(p.coverage(e, c), p.orphans(c, meta(spark, sf, "m_obj"), e))


@query("completeness", sql("m_cand m_end m_study m_arm", """
  SELECT study_id, check_id FROM prof LEFT JOIN (SELECT study_id, bool_or(DOMAIN_HINT LIKE 'safety%') AS safety, bool_or(DOMAIN_HINT = 'safety-lab') AS lab,
      bool_or(level = 'Primary' AND MEASURE_TYPE = 'continuous' AND DOMAIN_HINT LIKE 'efficacy%') AS pc, bool_or(level = 'Primary' AND RESOLVED) AS pr FROM parsed GROUP BY 1) e USING (study_id)
    LEFT JOIN (SELECT study_id, bool_or(imputation = 'OC') AS oc, bool_or(method = 'MMRM') AS mm, bool_or(method = 'ANCOVA') AS an, bool_or(subgroup IS NOT NULL) AS sg,
      bool_or(category = 'disposition') AS di, bool_or(category = 'demographics') AS de, bool_or(category = 'exposure') AS ex FROM m_cand WHERE status = 'planned' GROUP BY 1) c USING (study_id)
    JOIN (SELECT unnest(['C1', 'C2', 'C3', 'C4', 'C5', 'C6', 'C7', 'C8', 'C9', 'C10']) AS check_id) k ON CASE check_id WHEN 'C1' THEN safety WHEN 'C2' THEN safety WHEN 'C3' THEN pc AND coalesce(an, false) AND NOT coalesce(oc, false)
      WHEN 'C4' THEN pc AND NOT coalesce(mm, false) WHEN 'C5' THEN pr AND NOT coalesce(sg, false) WHEN 'C6' THEN multi_site WHEN 'C7' THEN lab WHEN 'C8' THEN NOT coalesce(di, false) OR NOT coalesce(de, false)
      WHEN 'C9' THEN needs_tte_safety_figure ELSE safety AND NOT coalesce(ex, false) END""", parsed=_PARSED, prof=_PROFILE))
def _(spark, sf):
    return p.completeness(meta(spark, sf, "m_obj"), _ends(spark, sf), _cands(spark, sf), _profiles(spark, sf)).select("study_id", "check_id")


@query("assemble_specs", sql("m_cand", """
  SELECT study_id, candidate_id, substr(final_id, 3) AS table_id, CASE population WHEN 'Efficacy' THEN 'EFFFL = ''Y''' ELSE 'SAFFL = ''Y''' END AS set_condition,
    concat_ws(' AND ', CASE WHEN category = 'efficacy' THEN CASE imputation WHEN 'OC' THEN 'ANL02FL = ''Y''' ELSE 'ANL01FL = ''Y''' END END, 'AVISIT = ''' || timepoint || '''') AS record_condition, method
  FROM num WHERE status = 'planned'""", num=_NUMBERED))
def _(spark, sf):
    return p.assemble_specs(p.number_outputs(_cands(spark, sf)))


@query("arm_levels", sql("m_arm", "SELECT study_id, position AS level_order, name AS level, position = 0 AS is_reference FROM m_arm"))
def _(spark, sf):
    return p.arm_levels(meta(spark, sf, "m_arm"))


@query("aggregate_needs", sql("m_cand", """
  SELECT DISTINCT study_id, adam AS dataset, 'output' AS kind, candidate_id AS value FROM m_cand WHERE status = 'planned' AND adam <> ''
  UNION SELECT study_id, adam, 'method', method FROM m_cand WHERE status = 'planned' AND adam <> '' UNION SELECT study_id, adam, 'population', population FROM m_cand WHERE status = 'planned' AND adam <> ''"""))
def _(spark, sf):
    return p.aggregate_needs(_cands(spark, sf))


# ---- lineage ---------------------------------------------------------------------------------------


def _graph(spark, sf):
    tlfs = _cands(spark, sf).withColumn("final_id", F.lit(None).cast("string"))
    return meta(spark, sf, "m_obj"), _ends(spark, sf), tlfs, meta(spark, sf, "m_adam"), meta(spark, sf, "m_use")


_BRIDGE = """SELECT DISTINCT c.study_id, candidate_id, u.dataset FROM m_cand c JOIN m_use u ON u.study_id = c.study_id AND replace(u.table_id, 'T-', '') = c.candidate_id
  UNION SELECT c.study_id, candidate_id, a.dataset FROM m_cand c JOIN m_adam a ON a.study_id = c.study_id AND a.dataset = c.adam
    WHERE NOT EXISTS (SELECT 1 FROM m_use u WHERE u.study_id = c.study_id AND replace(u.table_id, 'T-', '') = c.candidate_id)"""
_ASRC = "SELECT DISTINCT study_id, dataset, unnest(string_split(sources, ',')) AS domain FROM m_adam"
_UNBR = """SELECT DISTINCT study_id, candidate_id, domain FROM (SELECT study_id, candidate_id, unnest(string_split(raw, ',')) AS domain FROM m_cand WHERE raw <> '') d
  WHERE NOT EXISTS (SELECT 1 FROM bridge b JOIN asrc s USING (study_id, dataset) WHERE b.study_id = d.study_id AND b.candidate_id = d.candidate_id AND s.domain = d.domain)"""
_SDTM = "SELECT study_id, domain, bool_and(a) AS absent FROM (SELECT study_id, domain, true AS a FROM unbr UNION ALL SELECT study_id, domain, false FROM asrc) GROUP BY 1, 2"
_NODES = """SELECT DISTINCT study_id, 'obj:' || objective_id AS id, 'Objective' AS type, 0::BIGINT AS tier, objective_id AS label, NULL AS status, false AS unresolved, false AS absent FROM m_obj
  UNION ALL SELECT study_id, 'end:' || endpoint_id, 'Endpoint', 1, endpoint_id, NULL, NOT RESOLVED, false FROM parsed
  UNION ALL SELECT DISTINCT study_id, 'reg:ICH-E3', 'Regulatory', 1, 'ICH E3', NULL, false, false FROM m_cand WHERE regulatory_rule IS NOT NULL
  UNION ALL SELECT study_id, 'tlf:' || candidate_id, 'TLF', 2, candidate_id, status, false, false FROM m_cand
  UNION ALL SELECT study_id, 'adam:' || dataset, 'ADaM', 3, dataset, NULL, false, false FROM m_adam
  UNION ALL SELECT study_id, 'sdtm:' || domain, 'SDTM', 4, domain, NULL, false, absent FROM sdtm"""
_USES = "SELECT study_id, candidate_id, unnest(string_split(endpoints, ',')) AS e FROM m_cand WHERE endpoints <> ''"
_EDGES = f"""SELECT e.study_id, 'obj:' || e.objective_id AS source, 'end:' || endpoint_id AS target, 'obj-end' AS kind, false AS dashed, NULL AS rule FROM m_end e JOIN m_obj USING (study_id, objective_id)
  UNION SELECT u.study_id, 'end:' || u.e, 'tlf:' || candidate_id, 'end-tlf', false, NULL FROM ({_USES}) u JOIN m_end x ON x.study_id = u.study_id AND x.endpoint_id = u.e
  UNION SELECT c.study_id, 'obj:' || objectives, 'tlf:' || candidate_id, 'obj-tlf', false, NULL FROM m_cand c JOIN m_obj o ON o.study_id = c.study_id AND o.objective_id = c.objectives WHERE c.endpoints = ''
  UNION SELECT study_id, 'reg:ICH-E3', 'tlf:' || candidate_id, 'reg-tlf', false, regulatory_rule FROM m_cand WHERE regulatory_rule IS NOT NULL
  UNION SELECT study_id, 'tlf:' || candidate_id, 'adam:' || dataset, 'tlf-adam', false, NULL FROM bridge
  UNION SELECT study_id, 'adam:' || dataset, 'sdtm:' || domain, 'adam-sdtm', false, NULL FROM asrc
  UNION SELECT study_id, 'tlf:' || candidate_id, 'sdtm:' || domain, 'tlf-sdtm', true, NULL FROM unbr"""
_G = dict(parsed=_PARSED, bridge=_BRIDGE, asrc=_ASRC, unbr=_UNBR, sdtm=_SDTM)
_GV = "m_obj m_end m_cand m_adam m_use"


@query("graph_nodes", sql(_GV, _NODES, **_G))
def _(spark, sf):
    return g.build_nodes(*_graph(spark, sf)).select("study_id", "id", "type", "tier", "label", "status", "unresolved", "absent")


@query("graph_edges", sql(_GV, _EDGES, **_G))
def _(spark, sf):
    return g.build_edges(*_graph(spark, sf))


@query("output_to_dataset_bridge", sql(_GV, "SELECT * FROM bridge", **_G))
def _(spark, sf):
    _, _, tlfs, adam, use = _graph(spark, sf)
    return g.tlf_adam(tlfs, use, adam)


@query("absent_domains", sql(_GV + " m_inv", """SELECT study_id, domain, absent AND NOT EXISTS (SELECT 1 FROM m_inv i WHERE i.study_id = s.study_id AND i.domain = s.domain) AS absent FROM sdtm s""", **_G))
def _(spark, sf):
    _, _, tlfs, adam, use = _graph(spark, sf)
    return g.mark_absent(g.unbridged(tlfs, g.tlf_adam(tlfs, use, adam), adam), adam, meta(spark, sf, "m_inv"))


_ROOTS = "SELECT study_id, 'obj:' || objective_id AS id FROM m_obj"
_DOWN = """SELECT study_id, root, id, direction FROM down UNION SELECT study_id, root, id, direction FROM up"""


def _recursive(body_roots):
    ctes = dict(_G, edges=_EDGES, roots=body_roots)
    return "WITH RECURSIVE " + ",\n".join([f"{n} AS ({META[n]})" for n in _GV.split()] + [f"{n} AS ({t})" for n, t in ctes.items()]) + """,
  down AS (SELECT study_id, id AS root, id, 'self' AS direction FROM roots UNION SELECT w.study_id, root, e.target, 'descendant' FROM down w JOIN edges e ON e.study_id = w.study_id AND e.source = w.id),
  up AS (SELECT study_id, id AS root, id, 'self' AS direction FROM roots UNION SELECT w.study_id, root, e.source, 'ancestor' FROM up w JOIN edges e ON e.study_id = w.study_id AND e.target = w.id)
  """


@query("lineage", _recursive(_ROOTS + " UNION ALL SELECT study_id, 'adam:' || dataset FROM m_adam") + _DOWN)
def _(spark, sf):
    parts = _graph(spark, sf)
    roots = parts[0].select("study_id", F.concat(F.lit("obj:"), "objective_id").alias("id")).unionByName(
        parts[3].select("study_id", F.concat(F.lit("adam:"), "dataset").alias("id")))
    return g.lineage(g.build_edges(*parts), roots)


@query("impact", _recursive("SELECT DISTINCT study_id, 'sdtm:DM' AS id FROM m_adam") + "SELECT DISTINCT study_id, root, id AS output FROM up WHERE id LIKE 'tlf:%'")
def _(spark, sf):
    parts = _graph(spark, sf)
    return g.impact(g.build_edges(*parts), parts[3].select("study_id", F.lit("sdtm:DM").alias("id")).distinct())


_ISSUES = f"""SELECT study_id, 'blocked' AS severity, 'tlf:' || candidate_id AS node_id, 'Cannot be produced: ' || title AS message FROM m_cand WHERE status = 'blocked'
  UNION ALL SELECT study_id, 'clarification', 'tlf:' || candidate_id, 'Open question: ' || title FROM m_cand WHERE status = 'needs-clarification'
  UNION ALL SELECT study_id, 'clarification', 'end:' || endpoint_id, 'No measure could be read from endpoint ' || endpoint_id FROM parsed WHERE NOT RESOLVED
  UNION ALL SELECT s.study_id, 'blocked', 'sdtm:' || s.domain, 'No data for ' || s.domain || CASE WHEN n > 0 THEN ' (outputs asking for it: ' || n || ')' ELSE '' END
    FROM sdtm s LEFT JOIN (SELECT study_id, domain, count(*) AS n FROM (SELECT study_id, unnest(string_split(raw, ',')) AS domain FROM m_cand WHERE raw <> '') GROUP BY 1, 2) d ON d.study_id = s.study_id AND d.domain = s.domain WHERE absent
  UNION ALL SELECT study_id, 'gap', 'obj:' || objective_id, 'Nothing planned for objective ' || objective_id FROM m_obj o
    WHERE NOT EXISTS (SELECT 1 FROM m_cand c WHERE c.study_id = o.study_id AND c.objectives = o.objective_id)
      AND NOT EXISTS (SELECT 1 FROM m_end e JOIN ({_USES}) u ON u.study_id = e.study_id AND u.e = e.endpoint_id WHERE e.study_id = o.study_id AND e.objective_id = o.objective_id)
  UNION ALL SELECT study_id, 'gap', 'end:' || endpoint_id, 'Nothing planned for endpoint ' || endpoint_id FROM parsed p WHERE RESOLVED
    AND NOT EXISTS (SELECT 1 FROM ({_USES}) u WHERE u.study_id = p.study_id AND u.e = p.endpoint_id)"""


@query("graph_issues", sql(_GV, _ISSUES, **_G))
def _(spark, sf):
    parts = _graph(spark, sf)
    return g.build_issues(parts[0], parts[1], parts[2], g.build_nodes(*parts))


@query("absent_domain_outputs", sql(_GV, """SELECT DISTINCT study_id, node_id, related FROM (
    SELECT study_id, 'sdtm:' || domain AS node_id, 'tlf:' || candidate_id AS related FROM lacking UNION ALL SELECT study_id, 'tlf:' || candidate_id, 'sdtm:' || domain FROM lacking WHERE status = 'blocked')""",
  **dict(_G, lacking="SELECT c.study_id, c.candidate_id, c.status, s.domain FROM m_cand c JOIN sdtm s ON s.study_id = c.study_id AND absent AND list_contains(string_split(raw, ','), s.domain)")))
def _(spark, sf):
    parts = _graph(spark, sf)
    return g.issue_relations(parts[2], g.build_nodes(*parts))


@query("graph_counts", sql(_GV, """
  SELECT study_id, count(*) FILTER (type = 'Objective') AS objectives, count(*) FILTER (type = 'Endpoint') AS endpoints, count(*) FILTER (type = 'Endpoint' AND unresolved) AS endpoints_unresolved,
    count(*) FILTER (type = 'SDTM') AS sdtm, count(*) FILTER (type = 'SDTM' AND absent) AS sdtm_absent, count(*) FILTER (type = 'ADaM') AS adam, count(*) FILTER (type = 'TLF') AS tlf,
    count(*) FILTER (type = 'TLF' AND status = 'planned') AS tlf_planned, count(*) FILTER (type = 'TLF' AND status = 'blocked') AS tlf_blocked, count(*) FILTER (type = 'TLF' AND status = 'needs-clarification') AS tlf_needs_clarification
  FROM nodes GROUP BY 1""", **dict(_G, nodes=_NODES)))
def _(spark, sf):
    return g.graph_counts(g.build_nodes(*_graph(spark, sf)))


@query("variable_edges", sql("m_adam", """SELECT DISTINCT study_id, dataset || '.' || variable AS source, 'sdtm:' || unnest(string_split(CASE WHEN sources = 'DM,DS' AND role LIKE '%dm data%' THEN 'DM' ELSE sources END, ',')) AS target FROM m_adam"""))
def _(spark, sf):
    return g.variable_edges(meta(spark, sf, "m_adam"))


@query("map_edges", sql("m_end", """SELECT study_id, 'end:' || endpoint_id AS source, 'tlf:Out-' || level AS target, 'end-tlf' AS kind FROM m_end
  UNION ALL SELECT study_id, 'end:' || endpoint_id, 'tlf:Ctx-' || objective_id, 'context' FROM m_end WHERE level = 'Primary'"""))
def _(spark, sf):
    docs = meta(spark, sf, "m_end").groupBy("study_id").agg(
        F.map_from_entries(F.collect_list(F.struct("endpoint_id", F.array(F.concat(F.lit("Out-"), "level"))))).alias("endpointOutputMap"),
        F.map_from_entries(F.collect_list(F.when(F.col("level") == "Primary", F.struct("endpoint_id", F.concat(F.lit("Ctx-"), "objective_id"))))).alias("populationContext"))
    return g.map_edges(docs.select("study_id", F.to_json(F.struct("endpointOutputMap", "populationContext")).alias("doc")))


@query("sample_findings", sql("m_cand", """
  SELECT severity, subject_key FROM (SELECT CASE status WHEN 'needs-clarification' THEN 'clarification' WHEN 'blocked' THEN 'blocked' ELSE 'info' END AS severity, candidate_id AS subject_key FROM m_cand)
  ORDER BY CASE severity WHEN 'blocked' THEN 0 WHEN 'clarification' THEN 1 ELSE 3 END, subject_key LIMIT 25"""))
def _(spark, sf):
    st = F.col("status")
    rows = _cands(spark, sf).withColumn("severity", F.when(st == "needs-clarification", "clarification").when(st == "blocked", "blocked").otherwise("info"))
    found = rows.select("severity", F.lit("status").alias("check_id"), F.col("candidate_id").alias("subject_key"), F.lit("m").alias("message"))
    return disp_.sample_findings(found).select("severity", "subject_key")
