"""Merges, analysis visits, flags and derived rows over the clinical views."""

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import derive as d, merge as m, quality as q, windows as w
from ..session import shared_folder
from ..sources import readers as rd, writers as wr
from . import views as v
from .meta import meta, sql
from .registry import query
from .views import ENDPOINT, VISITS, ae, analysis, dosing, disp, locf, obs, subjects, table, with_views

# ---- joins -----------------------------------------------------------------


@query("merge_vars", with_views("subjects", """
  SELECT event_id, user_id AS USUBJID, ARM, SITEID, TRTSDT FROM events LEFT JOIN subjects ON user_id = USUBJID"""))
def _(spark, sf):
    rec = table(spark, sf, "events").select("event_id", F.col("user_id").alias("USUBJID"))
    return m.merge_vars(rec, subjects(spark, sf), ["USUBJID"], ["ARM", "SITEID", "TRTSDT"])


@query("merge_extreme", with_views("dosing", """
  SELECT c_custkey AS USUBJID, f.EXSTDT AS TRTSDT, l.EXENDT AS TRTEDT FROM customer
  LEFT JOIN (SELECT USUBJID, min(EXSTDT) AS EXSTDT FROM dosing GROUP BY 1) f ON c_custkey = f.USUBJID
  LEFT JOIN (SELECT USUBJID, max(EXENDT) AS EXENDT FROM dosing WHERE EXDOSE > 10 GROUP BY 1) l ON c_custkey = l.USUBJID"""))
def _(spark, sf):
    dm, ex = table(spark, sf, "customer").select(F.col("c_custkey").alias("USUBJID")), dosing(spark, sf)
    out = m.merge_extreme(dm, ex, ["USUBJID"], ["EXSTDT"], "first", {"TRTSDT": "EXSTDT"})
    return m.merge_extreme(out, ex, ["USUBJID"], ["EXENDT"], "last", {"TRTEDT": "EXENDT"}, where="EXDOSE > 10")


@query("flag_exists", with_views("obs subjects", """
  SELECT USUBJID, CASE WHEN EXISTS (SELECT 1 FROM obs o WHERE o.USUBJID = s.USUBJID AND o.ADY >= 25 AND o.PARAMCD = 'view')
    THEN 'Y' ELSE 'N' END AS COMP28FL FROM subjects s"""))
def _(spark, sf):
    return m.flag_exists(subjects(spark, sf).select("USUBJID"), obs(spark, sf), ["USUBJID"],
                         "ADY >= 25 AND PARAMCD = 'view'", "COMP28FL")


@query("combine_supp", with_views("", """
  SELECT e.event_id AS AESEQ, e.user_id AS USUBJID, max(CASE WHEN i.QNAM = 'AETRTEM' THEN i.QVAL END) AS AETRTEM,
    max(CASE WHEN i.QNAM = 'AEKEY' THEN i.QVAL END) AS AEKEY, max(r.QVAL) AS RACEOTH
  FROM events e
  LEFT JOIN (SELECT user_id AS USUBJID, CAST(event_id AS VARCHAR) AS IDVARVAL, q AS QNAM,
               CASE q WHEN 'AETRTEM' THEN CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END
                      ELSE json_extract_string(props, '$.k') END AS QVAL
             FROM events, (VALUES ('AETRTEM'), ('AEKEY')) t(q) WHERE event_id % 3 = 0) i
    ON i.USUBJID = e.user_id AND i.IDVARVAL = CAST(e.event_id AS VARCHAR)
  LEFT JOIN (SELECT c_custkey AS USUBJID, c_mktsegment AS QVAL FROM customer WHERE c_custkey % 2 = 0) r
    ON r.USUBJID = e.user_id
  GROUP BY ALL"""))
def _(spark, sf):
    ev = table(spark, sf, "events")
    rec = ev.select(F.col("event_id").alias("AESEQ"), F.col("user_id").alias("USUBJID"))
    pairs = F.array(
        F.struct(F.lit("AETRTEM").alias("q"), F.when(F.col("event_id") % 2 == 0, "Y").otherwise("N").alias("v")),
        F.struct(F.lit("AEKEY").alias("q"), F.get_json_object("props", "$.k").alias("v")))
    supp = ev.filter("event_id % 3 = 0").select(
        F.col("user_id").alias("USUBJID"), F.lit("AESEQ").alias("IDVAR"), F.col("event_id").cast("string").alias("IDVARVAL"),
        F.explode(pairs).alias("p")).select("USUBJID", "IDVAR", "IDVARVAL", F.col("p.q").alias("QNAM"), F.col("p.v").alias("QVAL"))
    subject_level = table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("USUBJID"), F.lit(None).cast("string").alias("IDVAR"), F.lit(None).cast("string").alias("IDVARVAL"),
        F.lit("RACEOTH").alias("QNAM"), F.col("c_mktsegment").alias("QVAL"))
    return m.combine_supp(rec, supp.unionByName(subject_level), {"AESEQ": ["AETRTEM", "AEKEY"], None: ["RACEOTH"]})


@query("assign_window_table", with_views("obs", """
  SELECT USUBJID, PARAMCD, AVISIT, ASEQ, ADY FROM obs
  JOIN (VALUES ('Baseline', -14, 1, 1), ('Day 7', 5, 7, 9), ('Day 14', 12, 14, 18), ('Day 20', 17, 20, 24))
    t(AVISIT, LO, TG, UP) ON ADY BETWEEN LO AND UP
  QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD, AVISIT ORDER BY abs(ADY - TG), ADY DESC, ASEQ) = 1"""))
def _(spark, sf):
    windows = spark.createDataFrame(
        [("Baseline", 0, -14, 1, 1), ("Day 7", 7, 5, 7, 9), ("Day 14", 14, 12, 14, 18), ("Day 20", 20, 17, 20, 24)],
        "AVISIT string, AVISITN int, LOWER int, TARGET int, UPPER int")
    return m.assign_window_table(obs(spark, sf), windows).select("USUBJID", "PARAMCD", "AVISIT", "ASEQ", "ADY")


@query("asof_last", with_views("obs subjects", """
  SELECT USUBJID, PARAMCD, AVAL AS LASTVAL, ADT AS LASTDT FROM obs WHERE ADT <= TRTEDT
  QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD ORDER BY ADT DESC, ASEQ DESC) = 1"""))
def _(spark, sf):
    return m.asof_last(obs(spark, sf).drop("TRTEDT"), subjects(spark, sf), ["USUBJID", "PARAMCD"], "ADT", "TRTEDT", ["ASEQ"],
                       {"LASTVAL": "AVAL", "LASTDT": "ADT"}, match_by=["USUBJID"])


@query("subjects_without_endpoint", with_views("analysis", """
  SELECT DISTINCT USUBJID, PARAMCD FROM analysis a WHERE AVISITN > 0 AND NOT EXISTS (
    SELECT 1 FROM analysis e WHERE e.USUBJID = a.USUBJID AND e.PARAMCD = a.PARAMCD AND e.AVISITN = 28)"""))
def _(spark, sf):
    df = analysis(spark, sf)
    groups = df.filter("AVISITN > 0").select("USUBJID", "PARAMCD").distinct()
    return m.without(groups, df.filter("AVISITN = 28"), ["USUBJID", "PARAMCD"])


@query("flag_overlap", with_views("ae", """
  SELECT AESEQ, CASE WHEN ASTDT < TRTSDT THEN 'Y' END AS PREFL,
    CASE WHEN TRTSDT IS NOT NULL AND (TRTEDT IS NULL OR ASTDT IS NULL OR ASTDT <= TRTEDT)
      AND (AENDT IS NULL OR AENDT >= TRTSDT) THEN 'Y' END AS CONCOMFL,
    CASE WHEN ASTDT >= TRTSDT AND (TRTEDT IS NULL OR ASTDT <= TRTEDT) THEN 'Y' END AS ONTRTFL FROM ae"""))
def _(spark, sf):
    return m.flag_overlap(ae(spark, sf)).select("AESEQ", "PREFL", "CONCOMFL", "ONTRTFL")


@query("merge_joined", with_views("obs", """
  SELECT s.ASEQ AS SEQ, last(o.AVAL ORDER BY o.ADT, o.ASEQ) AS PRIORVAL
  FROM obs s LEFT JOIN obs o ON o.USUBJID = s.USUBJID AND o.PARAMCD = 'view' AND o.ADT <= s.ADT
    AND date_diff('day', o.ADT, s.ADT) <= 10
  WHERE s.PARAMCD = 'purchase' GROUP BY s.ASEQ"""))
def _(spark, sf):
    df = obs(spark, sf)
    left = df.filter("PARAMCD = 'purchase'").select("USUBJID", F.col("ASEQ").alias("SEQ"), F.col("ADT").alias("DT"))
    add = df.filter("PARAMCD = 'view'").select("USUBJID", "ADT", "ASEQ", "AVAL")
    return m.merge_as_of_by_bucket(left, add, ["USUBJID"], "DT", "ADT", 10, ["ASEQ"], {"PRIORVAL": "AVAL"}, ["SEQ"]).select(
        "SEQ", "PRIORVAL")


@query("merge_joined_condition", with_views("obs subjects", """
  SELECT s.USUBJID, first(o.AVAL ORDER BY o.ADT, o.ASEQ) AS FIRSTVAL, min(o.ADT) AS FIRSTDT
  FROM subjects s LEFT JOIN obs o ON o.USUBJID = s.USUBJID AND o.PARAMCD = 'click' AND o.ADT > s.TRTSDT AND o.ADT < s.TRTEDT
  GROUP BY s.USUBJID"""))
def _(spark, sf):
    add = obs(spark, sf).filter("PARAMCD = 'click'").select("USUBJID", "ADT", "ASEQ", "AVAL")
    adsl = subjects(spark, sf).select("USUBJID", "TRTSDT", "TRTEDT")
    return m.merge_in_range(adsl, add, ["USUBJID"], "ADT", "TRTSDT", "TRTEDT", ["ADT", "ASEQ"], "first",
                            {"FIRSTVAL": "AVAL", "FIRSTDT": "ADT"}, ["USUBJID"], closed=(False, False)).drop("TRTSDT", "TRTEDT")


@query("merge_joined_any_condition", with_views("obs subjects", """
  SELECT s.USUBJID, first(o.AVAL ORDER BY o.ADT, o.ASEQ) AS FIRSTVAL FROM subjects s
  LEFT JOIN obs o ON o.USUBJID = s.USUBJID AND o.PARAMCD = 'click' AND (o.ADT > s.TRTSDT OR o.AVAL > s.TRT01PN) GROUP BY s.USUBJID"""))
def _(spark, sf):
    """A condition that is no range of one column."""
    add = obs(spark, sf).filter("PARAMCD = 'click'").select("USUBJID", "ADT", "ASEQ", "AVAL")
    adsl = subjects(spark, sf).select("USUBJID", "TRTSDT", "TRT01PN")
    return m.merge_joined(adsl, add, ["USUBJID"], "ADT > TRTSDT OR AVAL > TRT01PN", ["ADT", "ASEQ"], "first", {"FIRSTVAL": "AVAL"}, ["USUBJID"]).select("USUBJID", "FIRSTVAL")


@query("merge_highest_in_window", with_views("obs", """
  SELECT s.ASEQ AS SEQ, max(o.AVAL) AS PEAK, last(o.ASEQ ORDER BY o.AVAL, o.ASEQ) AS PEAKSEQ FROM obs s LEFT JOIN obs o ON o.PARAMCD = 'view'
    AND o.REGION = s.REGION AND o.ADT BETWEEN s.ADT - 2 AND s.ADT AND o.AVAL IS NOT NULL WHERE s.PARAMCD = 'purchase' GROUP BY s.ASEQ"""))
def _(spark, sf):
    """The highest value of a whole region in the three days up to a record: few keys, each with a large part of both sides."""
    df = obs(spark, sf)
    left = df.filter("PARAMCD = 'purchase'").select("REGION", F.col("ASEQ").alias("SEQ"), F.col("ADT").alias("TO"), F.date_sub("ADT", 2).alias("FROM"))
    add = df.filter("PARAMCD = 'view'").select("REGION", "ADT", "ASEQ", "AVAL")
    return m.merge_in_range(left, add, ["REGION"], "ADT", "FROM", "TO", ["AVAL", "ASEQ"], "last", {"PEAK": "AVAL", "PEAKSEQ": "ASEQ"}, ["SEQ"]).select(
        "SEQ", "PEAK", "PEAKSEQ")


# ---- visits, flags, carry-forward --------------------------------------------


@query("flag_extreme", with_views("obs", """
  SELECT ASEQ, CASE WHEN AVAL > 20 AND row_number() OVER (PARTITION BY USUBJID, PARAMCD, AVAL > 20 ORDER BY ADT, ASEQ) = 1
    THEN 'Y' END AS FRSTFL FROM obs"""))
def _(spark, sf):
    return w.flag_extreme(obs(spark, sf), ["USUBJID", "PARAMCD"], ["ADT", "ASEQ"], "FRSTFL", "first", "AVAL > 20").select("ASEQ", "FRSTFL")


@query("baseline_flag_and_value", with_views("based", "SELECT ASEQ, ABLFL, BASE, r6(CHG) AS CHG FROM based"))
def _(spark, sf):
    df = w.flag_baseline(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'"))
    return w.derive_base(df, BASE="AVAL").select("ASEQ", "ABLFL", "BASE", s.chg().alias("CHG"))


@query("derive_base_indicator", with_views("based", """
  SELECT b.ASEQ, x.r AS BNRIND, x.d AS BASEDT FROM based b LEFT JOIN
    (SELECT USUBJID, PARAMCD, CASE WHEN AVAL < 10 THEN 'LOW' WHEN AVAL > 50 THEN 'HIGH' ELSE 'NORMAL' END AS r, ADT AS d
     FROM based WHERE ABLFL = 'Y') x USING (USUBJID, PARAMCD)"""))
def _(spark, sf):
    df = w.baseline(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'")).withColumn(
        "ANRIND", s.range_indicator("AVAL", F.lit(10.0), F.lit(50.0)))
    return w.derive_base(df, BNRIND="ANRIND", BASEDT="ADT").select("ASEQ", "BNRIND", "BASEDT")


@query("window_visits", with_views("windowed", "SELECT ASEQ, AVISIT, AVISITN, ATARGDY FROM windowed"))
def _(spark, sf):
    return w.window_visits(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'"), VISITS).select("ASEQ", "AVISIT", "AVISITN", "ATARGDY")


@query("pick_analysis_record", with_views("windowed analysis", """
  SELECT w.ASEQ, CASE WHEN a.ASEQ IS NOT NULL THEN 'Y' END AS ANL01FL FROM windowed w LEFT JOIN analysis a USING (ASEQ)"""))
def _(spark, sf):
    return w.pick_analysis_record(v.windowed(spark, sf)).select("ASEQ", "ANL01FL")


@query("locf_endpoint", with_views("locf", """
  SELECT USUBJID, PARAMCD, AVISITN, AVAL, BASE, r6(CHG) AS CHG, ADY, DTYPE FROM locf"""))
def _(spark, sf):
    return locf(spark, sf).select("USUBJID", "PARAMCD", "AVISITN", "AVAL", "BASE", "CHG", "ADY", "DTYPE")


@query("locf_endpoint_before_the_last_visit", with_views("analysis", """
  SELECT USUBJID, PARAMCD, AVISITN, AVAL, DTYPE FROM (
    SELECT USUBJID, PARAMCD, AVISITN, AVAL, NULL AS DTYPE FROM analysis WHERE AVISITN = 14
    UNION ALL SELECT USUBJID, PARAMCD, 14 AS AVISITN, AVAL, 'LOCF' AS DTYPE FROM (
      SELECT *, row_number() OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVISITN DESC, ADY DESC, ASEQ DESC) AS k FROM analysis a
      WHERE AVISITN > 0 AND AVISITN < 14 AND NOT EXISTS (SELECT 1 FROM analysis o WHERE o.USUBJID = a.USUBJID AND o.PARAMCD = a.PARAMCD AND o.AVISITN = 14)) WHERE k = 1)"""))
def _(spark, sf):
    """Endpoint on day 14 while day 28 exists: later values are not carried back, and no second primary record appears."""
    out = w.locf_endpoint(analysis(spark, sf), VISITS[2], require_baseline=False)
    return out.filter("AVISITN = 14").select("USUBJID", "PARAMCD", "AVISITN", "AVAL", "DTYPE")


_GRID = """SELECT g.USUBJID, g.PARAMCD, t.AVISITN, a.AVAL FROM (SELECT DISTINCT USUBJID, PARAMCD FROM analysis) g
  CROSS JOIN (VALUES (CAST(0 AS BIGINT)), (7), (14), (21), (28)) t(AVISITN) LEFT JOIN analysis a USING (USUBJID, PARAMCD, AVISITN)"""


@query("locf_all_visits", with_views("analysis", f"""
  SELECT * FROM (SELECT USUBJID, PARAMCD, AVISITN,
      last_value(AVAL IGNORE NULLS) OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVISITN ROWS UNBOUNDED PRECEDING) AS AVAL,
      CASE WHEN AVAL IS NULL THEN 'LOCF' END AS DTYPE FROM ({_GRID})) WHERE AVAL IS NOT NULL"""))
def _(spark, sf):
    return w.locf_all_visits(analysis(spark, sf), w.visit_table(spark, VISITS)).select("USUBJID", "PARAMCD", "AVISITN", "AVAL", "DTYPE")


@query("wocf", with_views("analysis", f"""
  SELECT * FROM (SELECT USUBJID, PARAMCD, AVISITN,
      coalesce(AVAL, max(AVAL) OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVISITN ROWS UNBOUNDED PRECEDING)) AS AVAL,
      CASE WHEN AVAL IS NULL THEN 'WOCF' END AS DTYPE FROM ({_GRID})) WHERE AVAL IS NOT NULL"""))
def _(spark, sf):
    return w.wocf(analysis(spark, sf), w.visit_table(spark, VISITS)).select("USUBJID", "PARAMCD", "AVISITN", "AVAL", "DTYPE")


@query("flag_first_occurrence", with_views("teae", """
  SELECT AESEQ, CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY TRTEMFL, USUBJID, AESOC ORDER BY ASTDT NULLS LAST, AESEQ) = 1 THEN 'Y' END AS AOCCFL,
    CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY TRTEMFL, USUBJID, AESOC, AEDECOD ORDER BY ASTDT NULLS LAST, AESEQ) = 1 THEN 'Y' END AS AOCCSFL,
    CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY TRTEMFL, USUBJID, AEDECOD ORDER BY ASTDT NULLS LAST, AESEQ) = 1 THEN 'Y' END AS AOCCPFL
  FROM teae"""))
def _(spark, sf):
    return w.flag_first_occurrence(d.flag_teae(ae(spark, sf))).select("AESEQ", "AOCCFL", "AOCCSFL", "AOCCPFL")


@query("change_from_previous", with_views("analysis", """
  SELECT USUBJID, PARAMCD, AVISITN, p AS PREV, r6(AVAL - p) AS CHGPREV
  FROM (SELECT *, lag(AVAL) OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVISITN) AS p FROM analysis)"""))
def _(spark, sf):
    return w.change_from_previous(analysis(spark, sf)).select("USUBJID", "PARAMCD", "AVISITN", "PREV", "CHGPREV")


@query("max_severity", with_views("ae", "SELECT USUBJID, AESOC, max(AESEVN) AS AESEVN FROM ae GROUP BY 1, 2"))
def _(spark, sf):
    return w.max_severity(ae(spark, sf), ["USUBJID", "AESOC"])


@query("duplicate_primary", with_views("windowed", """
  SELECT USUBJID, PARAMCD, AVISITN, count(*) AS n FROM windowed WHERE ASEQ % 2 = 0 GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def _(spark, sf):
    df = v.windowed(spark, sf).withColumn("ANL01FL", F.when(F.col("ASEQ") % 2 == 0, "Y"))
    return w.duplicate_primary(df)


@query("flag_end_of_treatment", with_views("obs", """
  SELECT ASEQ, CASE WHEN ok AND row_number() OVER (PARTITION BY USUBJID, PARAMCD, ok ORDER BY ADT DESC, ASEQ DESC) = 1 THEN 'Y' END AS EOTFL
  FROM (SELECT *, coalesce(ADT > TRTSDT AND ADT <= TRTEDT, false) AS ok FROM obs)"""))
def _(spark, sf):
    return w.flag_eot(obs(spark, sf)).select("ASEQ", "EOTFL")


@query("flag_variants", with_views("locf disp", """
  SELECT USUBJID, PARAMCD, AVISITN, DTYPE, CASE WHEN DTYPE IS NULL THEN 'Y' END AS ANL02FL,
    CASE WHEN DTYPE IS NULL AND USUBJID % 2 = 0 THEN 'Y' END AS ANL03FL FROM locf"""))
def _(spark, sf):
    df = locf(spark, sf).withColumn("COMPLFL", F.when(F.col("USUBJID") % 2 == 0, "Y").otherwise("N"))
    return w.flag_variants(df).select("USUBJID", "PARAMCD", "AVISITN", "DTYPE", "ANL02FL", "ANL03FL")


# ---- derived rows --------------------------------------------------------------


@query("flag_treatment_emergent", with_views("teae", """
  SELECT AESEQ, TRTEMFL, CASE WHEN TRTEMFL = 'Y' AND (ASTDT IS NULL OR TRTEDT IS NULL OR date_diff('day', TRTEDT, ASTDT) <= 3)
    THEN 'Y' END AS TRTEM3FL FROM teae"""))
def _(spark, sf):
    df = d.flag_teae(ae(spark, sf), cutoff_days=3).withColumnRenamed("TRTEMFL", "TRTEM3FL")
    return d.flag_teae(df).select("AESEQ", "TRTEMFL", "TRTEM3FL")


@query("derive_populations", with_views("obs subjects", """
  SELECT s.USUBJID, s.SAFFL, s.ITTFL, CASE WHEN s.SAFFL = 'Y' AND s.ITTFL = 'Y' AND b AND p THEN 'Y' ELSE 'N' END AS EFFFL,
    CASE WHEN s.TRTEDT IS NOT NULL AND s.TRTEDT >= DATE '2024-01-25' THEN 'Y' ELSE 'N' END AS COMPLFL
  FROM subjects s LEFT JOIN (SELECT USUBJID, bool_or(ADT <= TRTSDT) AS b, bool_or(ADT > TRTSDT) AS p FROM obs
    WHERE PARAMCD = 'view' GROUP BY 1) o USING (USUBJID)"""))
def _(spark, sf):
    adsl = subjects(spark, sf).drop("SAFFL", "ITTFL")
    return d.derive_populations(adsl, obs(spark, sf), "view", completed="TRTEDT >= DATE'2024-01-25'").select(
        "USUBJID", "SAFFL", "ITTFL", "EFFFL", "COMPLFL")


@query("pool_sites", with_views("subjects", """
  SELECT s.USUBJID, s.SITEID, CASE WHEN m >= 12 THEN s.SITEID ELSE '900' END AS SITEGR1 FROM subjects s JOIN
    (SELECT SITEID, min(n) AS m FROM (SELECT x.SITEID, a.A, count(s.USUBJID) AS n FROM (SELECT DISTINCT SITEID FROM subjects) x
       CROSS JOIN (VALUES (0), (54), (81)) a(A)
       LEFT JOIN subjects s ON s.SITEID = x.SITEID AND s.TRT01PN = a.A AND s.ITTFL = 'Y' GROUP BY 1, 2) GROUP BY 1) USING (SITEID)"""))
def _(spark, sf):
    return d.pool_sites(subjects(spark, sf), list(v.ARMS.values()), threshold=12).select("USUBJID", "SITEID", "SITEGR1")


@query("derive_summary_records", with_views("analysis", """
  SELECT USUBJID, AVISITN, PARAMCD, AVAL AS AVAL, CAST(NULL AS VARCHAR) AS DTYPE FROM analysis
  UNION ALL SELECT USUBJID, AVISITN, 'TOTAL', r6(sum(AVAL)), 'SUM' FROM analysis WHERE PARAMCD IN ('view', 'click') GROUP BY 1, 2
  UNION ALL SELECT USUBJID, AVISITN, 'MEAN', r6(avg(AVAL)), 'AVERAGE' FROM analysis WHERE PARAMCD <> 'error' GROUP BY 1, 2"""))
def _(spark, sf):
    df = analysis(spark, sf).select("USUBJID", "AVISITN", "PARAMCD", "AVAL")
    total = d.derive_summary_records(df, ["USUBJID", "AVISITN"], "PARAMCD IN ('view', 'click')", "sum", {"PARAMCD": "TOTAL", "DTYPE": "SUM"})
    mean = d.derive_summary_records(df, ["USUBJID", "AVISITN"], "PARAMCD <> 'error'", "mean", {"PARAMCD": "MEAN", "DTYPE": "AVERAGE"})
    return total.unionByName(mean.filter("PARAMCD = 'MEAN'"))


@query("derive_body_params", with_views("analysis", """
  WITH_MARK SELECT USUBJID, AVISITN, PARAMCD, AVAL FROM hw
  UNION ALL SELECT USUBJID, AVISITN, 'BMI', r6(floor(W / power(H / 100.0, 2) * 10 + 0.5) / 10) FROM wide
  UNION ALL SELECT USUBJID, AVISITN, 'BSA', r6(sqrt(H * W / 3600.0)) FROM wide""".replace("WITH_MARK ", ""),
  hw="SELECT USUBJID, AVISITN, CASE PARAMCD WHEN 'view' THEN 'WEIGHT' ELSE 'HEIGHT' END AS PARAMCD, CASE PARAMCD WHEN 'view' THEN 50 + AVAL / 10 ELSE 150 + AVAL / 10 END AS AVAL FROM analysis WHERE PARAMCD IN ('view', 'click')",
  wide="SELECT a.USUBJID, a.AVISITN, a.AVAL AS W, b.AVAL AS H FROM hw a JOIN hw b USING (USUBJID, AVISITN) WHERE a.PARAMCD = 'WEIGHT' AND b.PARAMCD = 'HEIGHT'"))
def _(spark, sf):
    is_w = F.col("PARAMCD") == "view"
    df = analysis(spark, sf).filter("PARAMCD IN ('view', 'click')").select(
        "USUBJID", "AVISITN", F.when(is_w, "WEIGHT").otherwise("HEIGHT").alias("PARAMCD"),
        F.when(is_w, 50 + F.col("AVAL") / 10).otherwise(150 + F.col("AVAL") / 10).alias("AVAL"))
    key = ["USUBJID", "AVISITN"]
    return d.derive_bsa(d.derive_bmi(df, key), key).select(*key, "PARAMCD", "AVAL")


@query("exposure_params", with_views("dosing", """
  SELECT USUBJID, PARAMCD, r6(v) AS AVAL FROM (
    SELECT USUBJID, CAST(date_diff('day', min(EXSTDT), max(EXENDT)) + 1 AS DOUBLE) AS TRTDUR, sum(EXDOSE) AS CUMD,
      sum(EXDOSE) / (date_diff('day', min(EXSTDT), max(EXENDT)) + 1) AS AVGDD, max(EXDOSE) AS DOSE FROM dosing GROUP BY 1)
  UNPIVOT (v FOR PARAMCD IN (TRTDUR, CUMD, AVGDD, DOSE))"""))
def _(spark, sf):
    return d.exposure_params(dosing(spark, sf))


@query("disposition", with_views("subjects disp", """
  SELECT s.USUBJID, CASE WHEN DSDECOD = 'COMPLETED' THEN 'COMPLETED' WHEN DSDECOD IS NOT NULL THEN 'DISCONTINUED' END AS EOSSTT,
    CASE WHEN DSDECOD <> 'COMPLETED' THEN DSDECOD END AS DCSREAS, CASE WHEN DSDECOD = 'COMPLETED' THEN 'Y' ELSE 'N' END AS COMP26FL
  FROM subjects s LEFT JOIN (SELECT * FROM disp QUALIFY row_number() OVER (PARTITION BY USUBJID ORDER BY DSDT DESC, DSSEQ DESC) = 1) d USING (USUBJID)"""))
def _(spark, sf):
    return d.disposition(subjects(spark, sf).select("USUBJID"), disp(spark, sf))


@query("baseline_value", with_views("obs subjects", """
  SELECT s.USUBJID, WEIGHTBL FROM subjects s LEFT JOIN (SELECT USUBJID, AVAL AS WEIGHTBL FROM obs WHERE PARAMCD = 'view' AND ADY <= 3
    QUALIFY row_number() OVER (PARTITION BY USUBJID ORDER BY ADY DESC, ASEQ DESC) = 1) USING (USUBJID)"""))
def _(spark, sf):
    return d.baseline_value(subjects(spark, sf).select("USUBJID"), obs(spark, sf), "PARAMCD = 'view' AND ADY <= 3", "AVAL",
                            "WEIGHTBL", ["ADY", "ASEQ"])


@query("earliest_onset", with_views("ae subjects", """
  SELECT s.USUBJID, min(ASTDT) AS DISONSDT FROM subjects s LEFT JOIN ae ON ae.USUBJID = s.USUBJID AND AESOC = 'error' GROUP BY 1"""))
def _(spark, sf):
    return d.earliest(subjects(spark, sf).select("USUBJID"), ae(spark, sf), "AESOC = 'error'", "ASTDT", "DISONSDT")


@query("death_date", with_views("ae disp subjects", """
  SELECT USUBJID, coalesce(d1, d2) AS DTHDT, CASE WHEN coalesce(d1, d2) IS NOT NULL THEN 'Y' END AS DTHFL FROM subjects
  LEFT JOIN (SELECT USUBJID, min(DSDT) AS d1 FROM disp WHERE DSDECOD = 'ADVERSE EVENT' AND DSSEQ % 9 = 0 GROUP BY 1) USING (USUBJID)
  LEFT JOIN (SELECT USUBJID, min(AENDT) AS d2 FROM ae WHERE AESEVN = 3 AND AESEQ % 50 = 0 GROUP BY 1) USING (USUBJID)"""))
def _(spark, sf):
    return d.death(subjects(spark, sf).select("USUBJID"), (disp(spark, sf), "DSDECOD = 'ADVERSE EVENT' AND DSSEQ % 9 = 0", "DSDT"),
                   (ae(spark, sf), "AESEVN = 3 AND AESEQ % 50 = 0", "AENDT"))


@query("custom_query", with_views("ae", """
  SELECT AESEQ, CASE WHEN upper(AEDECOD) IN ('ERROR_1', 'VIEW_2') OR regexp_matches(AEDECOD, '^click_[34]') THEN 'DERMATOLOGICAL EVENTS' END AS CQ01NAM FROM ae"""))
def _(spark, sf):
    return d.custom_query(ae(spark, sf), "DERMATOLOGICAL EVENTS", ["error_1", "view_2"], "^click_[34]").select("AESEQ", "CQ01NAM")


@query("hys_law", with_views("windowed", """
  SELECT USUBJID, AVISITN, CASE WHEN t THEN 'Y' ELSE 'N' END AS TRANSFL, CASE WHEN b THEN 'Y' ELSE 'N' END AS BILIFL,
    CASE WHEN t AND b THEN 'Y' ELSE 'N' END AS HYSLAWFL FROM (SELECT USUBJID, AVISITN,
      bool_or(PARAMCD IN ('view', 'click') AND AVAL > 3 * 20) AS t, bool_or(PARAMCD = 'error' AND AVAL > 2 * 20) AS b
    FROM windowed WHERE PARAMCD IN ('view', 'click', 'error') GROUP BY 1, 2)"""))
def _(spark, sf):
    return d.hys_law(v.windowed(spark, sf).withColumn("A1HI", F.lit(20.0)), transaminases=["view", "click"], bilirubin="error")


@query("lab_criterion", with_views("windowed", """
  SELECT ASEQ, CASE WHEN AVAL > 20.0 * CASE PARAMCD WHEN 'view' THEN 3 ELSE 2 END THEN 'ABNORMAL' ELSE 'NORMAL' END AS CRIT1FL
  FROM windowed WHERE PARAMCD IN ('view', 'error')"""))
def _(spark, sf):
    return d.flag_lab_criterion(v.windowed(spark, sf).withColumn("A1HI", F.lit(20.0)), {"view": 3.0, "error": 2.0}).select("ASEQ", "CRIT1FL")


@query("derive_tte", with_views("tte", "SELECT * FROM tte"))
def _(spark, sf):
    return v.tte(spark, sf).select("USUBJID", "ARM", "AVAL", "CNSR")


_RESP = """SELECT USUBJID, ADT, ASEQ, CASE WHEN AVAL > 150 THEN 'CR' WHEN AVAL > 90 THEN 'PR' WHEN AVAL > 20 THEN 'SD'
  WHEN AVAL > 4 THEN 'NE' ELSE 'PD' END AS AVALC FROM obs WHERE PARAMCD = 'view'"""


def _responses(spark, sf):
    a = F.col("AVAL")
    return obs(spark, sf).filter("PARAMCD = 'view'").select(
        "USUBJID", "ADT", "ASEQ", F.when(a > 150, "CR").when(a > 90, "PR").when(a > 20, "SD").when(a > 4, "NE").otherwise("PD").alias("AVALC"))


@query("oncology_tte", with_views("obs subjects", """
  SELECT PARAMCD, USUBJID, CAST(date_diff('day', st, coalesce(ev, ce)) + 1 AS BIGINT) AS AVAL,
      CAST(CASE WHEN ev IS NULL THEN 1 ELSE 0 END AS BIGINT) AS CNSR
  FROM (SELECT 'OS' AS PARAMCD, USUBJID, TRTSDT AS st, CASE WHEN DTHDT >= TRTSDT THEN DTHDT END AS ev, CASE WHEN LSTALVDT >= TRTSDT THEN LSTALVDT END AS ce FROM a
    UNION ALL SELECT 'PFS', USUBJID, TRTSDT, least((SELECT min(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC = 'PD' AND r.ADT >= TRTSDT),
        CASE WHEN DTHDT >= TRTSDT THEN DTHDT END), (SELECT max(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC <> 'NE' AND r.ADT >= TRTSDT) FROM a
    UNION ALL SELECT 'DOR', USUBJID, R0, least((SELECT min(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC = 'PD' AND r.ADT >= R0),
        CASE WHEN DTHDT >= R0 THEN DTHDT END), (SELECT max(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC <> 'NE' AND r.ADT >= R0) FROM a WHERE R0 IS NOT NULL
    UNION ALL SELECT 'TTR', USUBJID, TRTSDT, (SELECT min(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC IN ('CR', 'PR') AND r.ADT >= TRTSDT),
        (SELECT max(r.ADT) FROM resp r WHERE r.USUBJID = a.USUBJID AND AVALC <> 'NE' AND r.ADT >= TRTSDT) FROM a)
  WHERE st IS NOT NULL AND coalesce(ev, ce) IS NOT NULL""", resp=_RESP,
  a="SELECT s.USUBJID, TRTSDT, TRTEDT AS LSTALVDT, CASE WHEN s.USUBJID % 3 = 0 THEN TRTEDT END AS DTHDT, (SELECT min(r.ADT) FROM resp r WHERE r.USUBJID = s.USUBJID AND AVALC IN ('CR', 'PR')) AS R0 FROM subjects s WHERE ITTFL = 'Y'"))
def _(spark, sf):
    adsl = subjects(spark, sf).filter("ITTFL = 'Y'").withColumns(
        {"LSTALVDT": F.col("TRTEDT"), "DTHDT": F.when(F.col("USUBJID") % 3 == 0, F.col("TRTEDT"))})
    return d.oncology_tte(adsl, _responses(spark, sf), "TRTSDT").select("PARAMCD", "USUBJID", "AVAL", "CNSR")


@query("best_response", with_views("obs", """
  SELECT USUBJID, PARAMCD, CAST(r AS BIGINT) AS AVAL, CASE r WHEN 1 THEN 'CR' WHEN 2 THEN 'PR' WHEN 3 THEN 'SD' WHEN 4 THEN 'PD' ELSE 'NE' END AS AVALC FROM (
    SELECT USUBJID, 'BOR' AS PARAMCD, min(k) AS r FROM ranked GROUP BY 1
    UNION ALL SELECT USUBJID, 'CBOR', min(CASE WHEN k = 1 AND EXISTS (SELECT 1 FROM ranked y WHERE y.USUBJID = x.USUBJID AND y.k = 1 AND date_diff('day', x.ADT, y.ADT) >= 10) THEN 1
        WHEN k = 2 AND EXISTS (SELECT 1 FROM ranked y WHERE y.USUBJID = x.USUBJID AND y.k <= 2 AND date_diff('day', x.ADT, y.ADT) >= 10) THEN 2
        WHEN k <= 2 THEN 3 ELSE k END) FROM ranked x GROUP BY 1)""", resp=_RESP,
  ranked="SELECT *, CASE AVALC WHEN 'CR' THEN 1 WHEN 'PR' THEN 2 WHEN 'SD' THEN 3 WHEN 'PD' THEN 4 ELSE 5 END AS k FROM resp"))
def _(spark, sf):
    r = _responses(spark, sf)
    return d.best_response(r).unionByName(d.best_response(r, 10))


@query("timepoint_params", with_views("obs", """
  SELECT USUBJID, PARAMCD || '_' || CASE ASEQ % 2 WHEN 0 THEN 'SUPINE' ELSE 'STAND1' END AS PARAMCD, ADT, r6(avg(AVAL)) AS AVAL FROM obs GROUP BY ALL"""))
def _(spark, sf):
    df = obs(spark, sf).withColumns({"VSTESTCD": F.col("PARAMCD"), "ATPT": F.lit(None).cast("string"),
                                     "VSPOS": F.when(F.col("ASEQ") % 2 == 0, "SUPINE").otherwise("STAND1")})
    return d.timepoint_params(df)


@query("occurrence_dataset", with_views("ae", """
  SELECT AESEQ, d AS ASTDT, AENDT, CASE WHEN d >= TRTSDT THEN date_diff('day', TRTSDT, d) + 1 ELSE date_diff('day', TRTSDT, d) END AS ASTDY,
    CASE WHEN d < TRTSDT THEN 'Y' END AS PREFL, f AS ASTDTF
  FROM (SELECT *, CASE WHEN AESEQ % 4 = 0 THEN CAST(date_trunc('month', CAST(ASTDT AS DATE)) AS DATE) ELSE ASTDT END AS d,
          CASE WHEN AESEQ % 4 = 0 AND ASTDT IS NOT NULL THEN 'D' END AS f FROM ae)"""))
def _(spark, sf):
    df = ae(spark, sf)
    text = F.date_format("ASTDT", "yyyy-MM-dd")
    domain = df.select("USUBJID", "AESEQ", F.when(F.col("AESEQ") % 4 == 0, F.substring(text, 1, 7)).otherwise(text).alias("AESTDTC"),
                       F.date_format("AENDT", "yyyy-MM-dd").alias("AEENDTC"))
    return d.occurrence_dataset(domain, subjects(spark, sf), "AESTDTC", "AEENDTC", ["TRTSDT", "TRTEDT"], overlap=True).select(
        "AESEQ", "ASTDT", "AENDT", "ASTDY", "PREFL", "ASTDTF")


@query("derive_extreme_records", with_views("analysis", """
  SELECT USUBJID, PARAMCD, AVISITN, AVAL, CAST(NULL AS VARCHAR) AS DTYPE FROM analysis
  UNION ALL SELECT USUBJID, PARAMCD, CAST(99 AS BIGINT), AVAL, 'MAXIMUM' FROM (SELECT * FROM analysis WHERE AVISITN > 0
    QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVAL DESC, ASEQ DESC) = 1)"""))
def _(spark, sf):
    return d.derive_extreme_records(analysis(spark, sf), ["USUBJID", "PARAMCD"], ["AVAL", "ASEQ"], "last",
                                    {"AVISITN": 99, "DTYPE": "MAXIMUM"}, "AVISITN > 0").select("USUBJID", "PARAMCD", "AVISITN", "AVAL", "DTYPE")


@query("toxicity_grade", with_views("based", """
  SELECT ASEQ, g AS ATOXGR, max(CASE WHEN ABLFL = 'Y' THEN g END) OVER (PARTITION BY USUBJID, PARAMCD) AS BTOXGR
  FROM (SELECT *, CAST(CASE WHEN PARAMCD NOT IN ('view', 'error') THEN NULL WHEN AVAL > 120 THEN 3 WHEN AVAL > 60 THEN 2 WHEN AVAL > 30 THEN 1 ELSE 0 END AS BIGINT) AS g FROM based)"""))
def _(spark, sf):
    criteria = spark.createDataFrame([(p, g, lo, hi) for p in ("view", "error") for g, lo, hi in
                                      ((1, 30.0, 60.0), (2, 60.0, 120.0), (3, 120.0, None))],
                                     "PARAMCD string, GRADE int, LOWER double, UPPER double")
    df = w.flag_baseline(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'"))
    return d.toxicity_grade(df, criteria).select("ASEQ", "ATOXGR", "BTOXGR")


@query("distinct_subjects_and_columns", with_views("obs", """
  SELECT USUBJID, count(DISTINCT PARAMCD) AS n_params FROM obs WHERE ADY > 0 GROUP BY 1"""))
def _(spark, sf):
    # distinct first, so a hot subject is reduced before it is counted
    return obs(spark, sf).filter("ADY > 0").select("USUBJID", "PARAMCD").distinct().groupBy("USUBJID").agg(
        F.count(F.lit(1)).alias("n_params"))


@query("column_differences", sql("m_adam m_cand", """
  SELECT dataset, variable, CASE WHEN min(side) = 1 THEN 'left' ELSE 'right' END AS only_in FROM (SELECT study_id || dataset AS dataset, variable, 1 AS side FROM m_adam
    UNION ALL SELECT study_id || adam, 'V' || (length(title) + 5), 2 FROM m_cand WHERE adam <> '') GROUP BY 1, 2 HAVING min(side) = max(side)"""))
def _(spark, sf):
    """Columns that only the specification or only the data of each study's data sets name."""
    spec = meta(spark, sf, "m_adam").select(F.concat("study_id", "dataset").alias("dataset"), "variable")
    data = meta(spark, sf, "m_cand").filter(F.size("req_adam") > 0).select(
        F.concat("study_id", F.element_at("req_adam", 1)).alias("dataset"), F.concat(F.lit("V"), (F.length("title") + 5).cast("string")).alias("variable"))
    return q.column_differences(spec, data, ["dataset"])


# ---- sources and sinks ---------------------------------------------------------

_WRITTEN = """SELECT event_id AS SEQ, user_id AS USUBJID, CAST(CAST(ts AS DATE) AS VARCHAR) AS ASTDT, value AS AVAL, event_type || ' [' || props || '] "' || chr(92) || '"' AS TXT, user_id % 2 = 0 AS EVEN,
  CASE WHEN event_id % 3 > 0 THEN event_type END AS GRP FROM events"""


def _to_write(spark, sf):
    """Records with brackets, quotes and backslashes in their texts, and with nulls."""
    e = table(spark, sf, "events")
    text = F.concat("event_type", F.lit(" ["), "props", F.lit('] "\\"'))
    return e.select(F.col("event_id").alias("SEQ"), F.col("user_id").alias("USUBJID"), F.col("ts").cast("date").alias("ASTDT"), F.col("value").alias("AVAL"), text.alias("TXT"),
                    (F.col("user_id") % 2 == 0).alias("EVEN"), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("GRP"))


def _new_folder(spark):
    return f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"


@query("read_dataset_json", _WRITTEN)
def _(spark, sf):
    """One JSON document, written and read back by ranges of bytes."""
    path = _new_folder(spark)
    wr.write_adam(_to_write(spark, sf), path, "dataset-json")
    return rd.read_dataset_json(spark, path).withColumn("ASTDT", F.col("ASTDT").cast("string"))


@query("write_adam", "SELECT * FROM (" + _WRITTEN + ") CROSS JOIN (VALUES ('ndjson'), ('parquet')) f(fmt)")
def _(spark, sf):
    """Records written in the newline form and as Parquet, and read back."""
    df, out = _to_write(spark, sf), []
    for fmt, read in (("ndjson", rd.read_dataset_ndjson), ("parquet", lambda session, path: session.read.parquet(path))):
        path = _new_folder(spark)
        wr.write_adam(df, path, fmt)
        out.append(read(spark, path).withColumn("fmt", F.lit(fmt)))
    return out[0].unionByName(out[1]).withColumn("ASTDT", F.col("ASTDT").cast("string"))
