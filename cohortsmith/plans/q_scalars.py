"""Scalar derivations and filters over the test tables."""

from pyspark.sql import functions as F

from ..functions import scalars as s
from .registry import query
from .views import ARM_LEVELS, dosing, obs, subjects, table, with_views


@query("apply_subset", with_views("obs", """
  SELECT USUBJID, PARAMCD, ASEQ, AVAL FROM obs WHERE ITTFL = 'Y' AND PARAMCD = 'view' AND ADY >= 7"""))
def _(spark, sf):
    return s.apply_subset(obs(spark, sf), "ITTFL = 'Y'", "PARAMCD = 'view' AND ADY >= 7").select(
        "USUBJID", "PARAMCD", "ASEQ", "AVAL")


@query("where_clause", with_views("obs", """
  SELECT USUBJID, ASEQ FROM obs
  WHERE PARAMCD IN ('view', 'click') AND AVAL >= 20 AND NOT (ARM = 'Placebo') AND (ADY < 5 OR ADY > 20)"""))
def _(spark, sf):
    leaf = lambda v, c, *x, order=0: {"order": order, "condition": {"variable": v, "comparator": c, "value": list(x)}}
    node = lambda op, *cs: {"compoundExpression": {"logicalOperator": op, "whereClauses": list(cs)}}
    clause = node("AND", leaf("PARAMCD", "IN", "view", "click"), leaf("AVAL", "GE", 20), node("NOT", leaf("ARM", "EQ", "Placebo")),
                  node("OR", leaf("ADY", "LT", 5), leaf("ADY", "GT", 20)))
    return obs(spark, sf).filter(s.where_clause(clause)).select("USUBJID", "ASEQ")


_DTC_SQL = """SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m-%d'), 1,
    CASE o_orderkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END)
    || CASE WHEN o_orderkey % 5 = 3 THEN 'T08:30' WHEN o_orderkey % 5 = 4 THEN 'T23:59:59' ELSE '' END AS DTC FROM orders"""


def _dtc(spark, sf):
    k = F.col("o_orderkey") % 5
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    cut = F.when(k == 0, F.substring(text, 1, 4)).when(k == 1, F.substring(text, 1, 7)).otherwise(text)
    tail = F.when(k == 3, "T08:30").when(k == 4, "T23:59:59").otherwise("")
    return table(spark, sf, "orders").select("o_orderkey", F.concat(cut, tail).alias("DTC"))


@query("derive_dt", with_views("", f"""
  SELECT o_orderkey, DTC,
    CASE WHEN n = 10 THEN CAST(substr(DTC, 1, 10) AS DATE) WHEN n = 7 THEN CAST(DTC || '-01' AS DATE)
         ELSE CAST(DTC || '-01-01' AS DATE) END AS FIRSTDT,
    CASE n WHEN 7 THEN 'D' WHEN 4 THEN 'M' END AS FIRSTDTF,
    CASE WHEN n = 10 THEN CAST(substr(DTC, 1, 10) AS DATE) WHEN n = 7 THEN last_day(CAST(DTC || '-01' AS DATE)) END AS LASTDT,
    CASE n WHEN 7 THEN 'D' END AS LASTDTF,
    CASE WHEN n = 10 THEN CAST(substr(DTC, 1, 10) AS DATE) END AS PLAINDT
  FROM (SELECT *, least(length(DTC), 10) AS n FROM ({_DTC_SQL}))"""))
def _(spark, sf):
    df = s.derive_dt(_dtc(spark, sf), "DTC", "FIRST", highest="M")
    df = s.derive_dt(df, "DTC", "LAST", highest="D", date_imputation="last")
    return s.derive_dt(df, "DTC", "PLAIN").drop("PLAINDTF")


@query("derive_dtm", with_views("", f"""
  SELECT o_orderkey, strftime(CASE WHEN length(DTC) >= 10 THEN CAST(replace(DTC, 'T', ' ') ||
      CASE length(DTC) WHEN 10 THEN ' 00:00:00' WHEN 16 THEN ':00' ELSE '' END AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS ADTM
  FROM ({_DTC_SQL})"""))
def _(spark, sf):
    df = s.derive_dtm(_dtc(spark, sf), "DTC", "A")
    return df.select("o_orderkey", F.date_format("ADTM", "yyyy-MM-dd HH:mm:ss").alias("ADTM"))


@query("study_day_and_duration", with_views("obs", """
  SELECT ASEQ, ADY, date_diff('day', TRTSDT, TRTEDT) + 1 AS TRTDURD,
    r6(date_diff('day', ADT, TRTEDT) / 30.4375) AS MONTHS FROM obs"""))
def _(spark, sf):
    return obs(spark, sf).select(
        "ASEQ", s.study_day("ADT", "TRTSDT").alias("ADY"), s.duration("TRTSDT", "TRTEDT").alias("TRTDURD"),
        s.months_between_days("ADT", "TRTEDT").alias("MONTHS"))


@query("age_years", with_views("", """
  SELECT o_orderkey, CAST(date_diff('year', b, r) - CASE WHEN (month(r), day(r)) < (month(b), day(b)) THEN 1 ELSE 0 END
    AS BIGINT) AS AGE
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(5000 + o_orderkey % 20000 AS INTEGER) AS b,
          CAST(o_orderdate AS DATE) AS r FROM orders)"""))
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.date_sub(F.to_date("o_orderdate"), (F.lit(5000) + F.col("o_orderkey") % 20000).cast("int")).alias("b"),
        F.to_date("o_orderdate").alias("r"))
    return df.select("o_orderkey", s.age_years("b", "r").alias("AGE"))


@query("band", with_views("", """
  SELECT p_partkey, CASE WHEN a < 65 THEN '<65' WHEN a <= 80 THEN '65-80' WHEN a > 80 THEN '>80' END AS AGEGR1,
    CAST(CASE WHEN a < 65 THEN 1 WHEN a <= 80 THEN 2 WHEN a > 80 THEN 3 END AS BIGINT) AS AGEGR1N,
    CASE WHEN a < 25 THEN '<25' WHEN a < 30 THEN '25-<30' WHEN a >= 30 THEN '>=30' END AS BMIBLGR1,
    CASE WHEN a < 12 THEN '<12' WHEN a >= 12 THEN '>=12' END AS DURDSGR1
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 > 0 THEN p_size * 2 END AS a FROM part)"""))
def _(spark, sf):
    a = F.col("a")
    df = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 11 > 0, F.col("p_size") * 2).alias("a"))
    return df.select("p_partkey", s.band(a, *s.AGE_BANDS).alias("AGEGR1"),
                     s.band(a, [("<", 65, 1), ("<=", 80, 2)], 3).alias("AGEGR1N"),
                     s.band(a, *s.BMI_BANDS).alias("BMIBLGR1"), s.band(a, *s.DURATION_BANDS).alias("DURDSGR1"))


@query("code_map", with_views("subjects", """
  SELECT USUBJID, CAST(CASE ARM WHEN 'Placebo' THEN 0 WHEN 'Low Dose' THEN 1 WHEN 'High Dose' THEN 2 END AS BIGINT) AS TRTN,
    CAST(CASE SEG WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 END AS BIGINT) AS SEGN FROM subjects"""))
def _(spark, sf):
    return subjects(spark, sf).select(
        "USUBJID", s.code_map("ARM", {a: i for i, a in enumerate(ARM_LEVELS)}).alias("TRTN"),
        s.code_map("SEG", {"BUILDING": 1, "MACHINERY": 2}).alias("SEGN"))


@query("body_measures", with_views("", """
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, r6(floor(w / power(h / 100.0, 2) * 10 + 0.5) / 10) AS BMI,
    r6(sqrt(h * w / 3600.0)) AS BSA
  FROM (SELECT *, 40 + l_quantity AS w, 140 + l_linenumber * 7 AS h FROM lineitem)"""))
def _(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({"w": 40 + F.col("l_quantity"), "h": 140 + F.col("l_linenumber") * 7})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", s.bmi("w", "h").alias("BMI"), s.bsa("w", "h").alias("BSA"))


@query("range_and_shift_label", with_views("", """
  SELECT event_id, r, coalesce(r, 'NULL') || ' to ' || CASE WHEN value > 60 THEN 'HIGH' ELSE 'NORMAL' END AS SHIFT1
  FROM (SELECT *, CASE WHEN event_id % 13 = 0 THEN NULL WHEN value < 10 THEN 'LOW' WHEN value > 50 THEN 'HIGH'
          ELSE 'NORMAL' END AS r FROM events)"""))
def _(spark, sf):
    lo = F.when(F.col("event_id") % 13 != 0, 10.0)
    df = table(spark, sf, "events").withColumn("r", s.range_indicator("value", lo, F.lit(50.0)))
    return df.select("event_id", "r", s.shift_label("r", s.range_indicator("value", F.lit(-1.0), F.lit(60.0))).alias("SHIFT1"))


@query("change_and_percent_change", with_views("based", """
  SELECT ASEQ, r6(CHG) AS CHG, r6(CASE WHEN BASE <> 0 THEN 100.0 * CHG / BASE END) AS PCHG FROM based"""))
def _(spark, sf):
    from ..operators.windows import baseline

    df = baseline(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'"))
    return df.select("ASEQ", s.chg().alias("CHG"), s.pchg().alias("PCHG"))


@query("display_round", with_views("", """
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, x AS X, CAST(printf('%.2f', x) AS VARCHAR) AS T, CAST(l_orderkey AS DOUBLE) * 1e13 AS L
  FROM (SELECT *, sign(v) * floor(abs(v) * 100 + 0.5) / 100 + 0.0 AS x
        FROM (SELECT *, l_extendedprice * l_discount * CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END AS v FROM lineitem))"""))
def _(spark, sf):
    v = F.col("l_extendedprice") * F.col("l_discount") * F.when(F.col("l_partkey") % 2 == 0, 1).otherwise(-1)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s.display_round(v, 2).alias("X"), s.fixed_text(v, 2).alias("T"),
        s.display_round(F.col("l_orderkey") * 1e13, 6).alias("L"))


@query("treatment_columns", with_views("subjects", """
  SELECT USUBJID, ARM AS TRTP, ARM AS TRTA, TRT01PN AS TRTPN FROM subjects"""))
def _(spark, sf):
    df = subjects(spark, sf).select("USUBJID", F.col("ARM").alias("TRT01P"), F.col("ARM").alias("TRT01A"), "TRT01PN")
    return s.treatment_columns(df).select("USUBJID", "TRTP", "TRTA", "TRTPN")


@query("qualified_param", with_views("", """
  SELECT event_id, upper(event_type) || '_' || CASE event_id % 3 WHEN 0 THEN 'SUPINE' WHEN 1 THEN 'STAND1' ELSE 'STAND3' END
    AS PARAMCD FROM events"""))
def _(spark, sf):
    pos = F.element_at(F.array(F.lit("SUPINE"), F.lit("STAND1"), F.lit("STAND3")), (F.col("event_id") % 3 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", s.qualified_param(F.upper("event_type"), pos).alias("PARAMCD"))
