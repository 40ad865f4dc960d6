"""Study metadata derived from the test tables: parts become endpoints, orders become output candidates.

Each view is one SQL text in the dialect both engines share; list fields are comma
lists that each side splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .views import table

_BASE = """(SELECT p_partkey AS k, p_name, p_size, CAST(floor(p_partkey / 12) AS BIGINT) AS s, p_partkey % 12 AS j,
  (p_partkey * 7 + p_size) % 10 AS m FROM part) b"""
_ORD = """(SELECT o_orderkey AS k, o_orderstatus AS st, CAST(floor(o_custkey / 10) AS BIGINT) AS s, o_orderkey % 9 AS c FROM orders) b"""
_CATEGORY = """CASE c WHEN 0 THEN 'disposition' WHEN 1 THEN 'demographics' WHEN 2 THEN 'efficacy' WHEN 3 THEN 'exposure' WHEN 4 THEN 'safety-ae'
  WHEN 5 THEN 'safety-lab' WHEN 6 THEN 'safety-vs' WHEN 7 THEN 'conmeds' ELSE 'unmapped' END"""

META = {
    "m_study": f"""SELECT concat('ST', s) AS study_id, CASE s % 3 WHEN 0 THEN 'Phase III Trial' WHEN 1 THEN 'Phase II Trial' ELSE 'Phase I Trial' END AS phase,
      concat('A ', CASE s % 4 WHEN 0 THEN 'double-blind' WHEN 1 THEN 'open-label' ELSE 'randomised' END, ' study of ', p_name) AS title FROM {_BASE} WHERE j = 0""",
    "m_obj": f"""SELECT concat('ST', s) AS study_id, concat('O', s, '_', CAST(floor(j / 2) AS BIGINT)) AS objective_id, concat('Objective on ', p_name) AS text,
      CASE WHEN j = 0 THEN 'C85826' WHEN j < 6 THEN 'C85827' ELSE 'C0' END AS code, CASE WHEN j < 8 THEN 'Secondary Objective' ELSE 'Exploratory Objective' END AS decode
      FROM {_BASE} WHERE j % 2 = 0""",
    "m_end": f"""SELECT concat('ST', s) AS study_id, concat('O', s, '_', CAST(floor(j / 2) AS BIGINT)) AS objective_id, concat('E', k) AS endpoint_id,
      CASE WHEN j < 2 THEN 'Primary' WHEN j < 6 THEN 'Secondary' ELSE 'Exploratory' END AS level,
      CASE m WHEN 0 THEN 'Cognitive scale, total of 11 items at Week 24' WHEN 1 THEN concat('Change in ', p_name, ', total of 14 items at Weeks 8 and 16')
        WHEN 2 THEN 'CIBIC+ at Weeks 8, 16 and 24' WHEN 3 THEN 'NPI-X total from Week 4 to Week 24' WHEN 4 THEN 'Adverse events'
        WHEN 5 THEN concat('Vital signs (weight, blood pressure) at Week ', p_size) WHEN 6 THEN concat('Laboratory evaluations (', p_name, ')')
        WHEN 7 THEN '*** To be determined from protocol ***' WHEN 8 THEN concat('Time to dermatologic event under ', p_name) ELSE concat('Cmax of ', p_name) END AS text
      FROM {_BASE}""",
    "m_arm": f"""SELECT concat('ST', s) AS study_id, CASE j WHEN 0 THEN 'Placebo' WHEN 1 THEN 'Drug 54 mg' ELSE 'Drug 81 mg' END AS name,
      CASE WHEN j = 0 AND s % 5 <> 0 THEN 'Placebo Control Arm' ELSE 'Active Comparator Arm' END AS type, j AS position FROM {_BASE} WHERE j <= 2 AND j <= s % 4""",
    "m_inv": f"""SELECT concat('ST', s) AS study_id, CASE j WHEN 0 THEN 'DM' WHEN 1 THEN 'DS' WHEN 2 THEN 'EX' WHEN 3 THEN 'AE' WHEN 4 THEN 'LB' WHEN 5 THEN 'VS'
      WHEN 6 THEN 'QS' WHEN 7 THEN 'CM' WHEN 8 THEN 'MH' WHEN 9 THEN 'SV' WHEN 10 THEN 'PC' ELSE 'PP' END AS domain FROM {_BASE} WHERE (k * 3 + p_size) % 9 <> 0""",
    "m_cand": f"""SELECT concat('ST', s) AS study_id, concat('C', k) AS candidate_id, CASE WHEN k % 11 = 0 THEN 'Figure' WHEN k % 13 = 0 THEN 'Listing' ELSE 'Table' END AS type,
      {_CATEGORY} AS category, concat('Summary of Measure ', k % 4, CASE k % 3 WHEN 0 THEN ' (Safety)' WHEN 1 THEN ' - LOCF' ELSE '' END) AS title,
      CASE WHEN k % 4 = 0 AND k % 3 <> 0 THEN 'ICH E3 §11.1' END AS regulatory_rule,
      CASE k % 5 WHEN 0 THEN 'ANCOVA' WHEN 1 THEN 'MMRM' WHEN 2 THEN 'CMH' ELSE 'Descriptive' END AS method, CASE WHEN k % 2 = 0 THEN 'Efficacy' ELSE 'Safety' END AS population,
      CASE WHEN k % 7 > 0 THEN concat('Week ', 8 * (1 + k % 3)) END AS timepoint, CASE WHEN k % 3 = 0 THEN 'OC' ELSE 'LOCF' END AS imputation,
      CASE k % 6 WHEN 1 THEN 'Sex=Male' WHEN 2 THEN 'Sex=Female' END AS subgroup, CASE k % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' ELSE 'supportive' END AS priority,
      CASE WHEN k % 4 = 0 THEN 'scaffolding' WHEN c = 2 THEN 'efficacy' ELSE 'safety' END AS produced_by,
      CASE st WHEN 'F' THEN 'planned' WHEN 'O' THEN 'blocked' ELSE 'needs-clarification' END AS status,
      CASE WHEN k % 4 = 1 THEN concat('O', s, '_', k % 7) ELSE '' END AS objectives,
      CASE WHEN k % 4 = 0 THEN '' WHEN k % 5 = 0 THEN concat('E', s * 12 + k % 12, ',E', s * 12 + (k + 5) % 12) ELSE concat('E', s * 12 + k % 12) END AS endpoints,
      CASE c WHEN 0 THEN 'DM,DS' WHEN 1 THEN 'DM' WHEN 2 THEN 'QS' WHEN 3 THEN 'EX' WHEN 4 THEN 'AE' WHEN 5 THEN 'LB' WHEN 6 THEN 'VS,DV' WHEN 7 THEN 'CM' ELSE '' END AS raw,
      CASE c WHEN 0 THEN 'ADSL' WHEN 1 THEN 'ADSL' WHEN 2 THEN 'ADQS' WHEN 3 THEN 'ADEX' WHEN 4 THEN 'ADAE' WHEN 5 THEN 'ADLB' WHEN 6 THEN 'ADVS' WHEN 7 THEN 'ADCM' ELSE '' END AS adam
      FROM {_ORD}""",
    "m_adam": f"""SELECT concat('ST', s) AS study_id, CASE j WHEN 0 THEN 'ADSL' WHEN 1 THEN 'ADAE' WHEN 2 THEN 'ADLB' WHEN 3 THEN 'ADVS' WHEN 4 THEN 'ADQS' ELSE 'ADCM' END AS dataset,
      CASE j WHEN 0 THEN 'DM,DS' WHEN 1 THEN 'AE' WHEN 2 THEN 'LB' WHEN 3 THEN 'VS' WHEN 4 THEN 'QS' ELSE 'CM' END AS sources,
      concat('Derived from ', CASE WHEN k % 3 = 0 THEN 'DM and DS records' WHEN k % 3 = 1 THEN 'dm data' ELSE 'source data' END) AS role, concat('V', p_size) AS variable
      FROM {_BASE} WHERE j < 6""",
    "m_use": f"""SELECT concat('ST', s) AS study_id, CASE WHEN c < 2 THEN 'ADSL' WHEN c = 2 THEN 'ADQS' WHEN c < 5 THEN 'ADAE' WHEN c = 5 THEN 'ADLB' ELSE 'ADVS' END AS dataset,
      concat(CASE WHEN k % 2 = 0 THEN 'T-' ELSE '' END, 'C', k) AS table_id FROM {_ORD} WHERE k % 3 = 0""",
}
_LISTS = {"m_cand": {"objectives": "objective_ids", "endpoints": "endpoint_ids", "raw": "req_sdtm", "adam": "req_adam"}, "m_adam": {"sources": "sdtm_source"}}


def meta(spark, sf: str, name: str) -> DataFrame:
    """A metadata view as a DataFrame, comma lists split."""
    src = {n: table(spark, sf, n) for n in ("part", "orders") if f"FROM {n})" in META[name]}
    df = spark.sql(META[name].replace("FROM part)", "FROM {part})").replace("FROM orders)", "FROM {orders})"), **src)
    for column, new in _LISTS.get(name, {}).items():
        df = df.withColumn(new, F.filter(F.split(column, ","), lambda x: x != "")).drop(column)
    return df


def sql(names: str, body: str, **extra: str) -> str:
    """Oracle text over the named metadata views."""
    ctes = [f"{n} AS ({META[n]})" for n in names.split()] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def values(rows, columns: str) -> str:
    """A literal table for the oracle."""
    def lit(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "true" if x else "false"
        return str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + f") {columns}"
