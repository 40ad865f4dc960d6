"""Summary statistics, displays and gates over the clinical views."""

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import ard, derive as d, display as disp_, quality as q, windows as w
from ..session import shared_folder
from ..sources import writers as wr
from . import views as v
from .meta import meta, sql
from .registry import ORACLE, query
from .views import ARM_LEVELS, ENDPOINT, VISITS, ae, analysis, disp, dosing, endpoint, locf, obs, subjects, table, with_views

_DESC = """count({x}) AS N, avg({x}) AS mean, stddev_samp({x}) AS sd, quantile_cont({x}, 0.25) AS p25, median({x}) AS median,
  quantile_cont({x}, 0.75) AS p75, min({x}) AS min, max({x}) AS max"""


def _desc_long(names, group, source, var="'AVAL'", x="AVAL"):
    """SQL: the descriptive statistics in long form."""
    stats = [("N", f"CAST(count({x}) AS DOUBLE)"), ("mean", f"avg({x})"), ("sd", f"stddev_samp({x})"), ("median", f"median({x})"),
             ("min", f"min({x})"), ("max", f"max({x})")]
    return "\nUNION ALL ".join(
        f"SELECT {names}, {var} AS variable, '{n}' AS stat_name, r6({e}) AS stat FROM {source} GROUP BY {group}"
        for n, e in stats)


@query("ard_continuous", with_views("endpoint", "\nUNION ALL ".join(
    _desc_long("ARM AS group1_level, PARAMCD", "ARM, PARAMCD", "endpoint", f"'{x}'", x) for x in ("BASE", "AVAL", "CHG"))))
def _(spark, sf):
    return ard.ard_continuous(endpoint(spark, sf), ["ARM", "PARAMCD"], ["BASE", "AVAL", "CHG"]).select(
        "group1_level", "PARAMCD", "variable", "stat_name", "stat")


@query("exact_quantiles", with_views("", """
  SELECT l_returnflag, count(l_extendedprice) AS cnt, r6(quantile_cont(l_extendedprice, 0.25)) AS p25, r6(median(l_extendedprice)) AS median,
    r6(quantile_cont(l_extendedprice, 0.75)) AS p75 FROM lineitem GROUP BY 1"""))
def _(spark, sf):
    from ..operators.groups import exact_quantiles

    li = table(spark, sf, "lineitem")
    n = li.groupBy("l_returnflag").agg(F.count("l_extendedprice").alias("cnt"))
    return n.join(exact_quantiles(li, ["l_returnflag"], "l_extendedprice", ard.QUANTILES), "l_returnflag")


@query("population_n", with_views("subjects", """
  SELECT coalesce(ARM, 'Screen failure') AS ARM, count(*) AS N FROM subjects WHERE SAFFL = 'Y' GROUP BY 1
  UNION ALL SELECT 'Total', count(*) FROM subjects WHERE SAFFL = 'Y'"""))
def _(spark, sf):
    return ard.population_n(subjects(spark, sf).fillna({"ARM": "Screen failure"}), "SAFFL", total="Total")


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NOT SEEN"]


@query("ard_categorical", with_views("subjects", f"""
  SELECT a AS ARM, 'SEG' AS variable, l AS level, count(USUBJID) AS hits, (SELECT count(*) FROM subjects x WHERE x.ARM = a) AS N,
    r6(100.0 * count(USUBJID) / (SELECT count(*) FROM subjects x WHERE x.ARM = a)) AS pct
  FROM (VALUES ('Placebo'), ('Low Dose'), ('High Dose')) t(a) CROSS JOIN (VALUES {', '.join(f"('{x}')" for x in _SEGS)}) u(l)
  LEFT JOIN subjects ON ARM = a AND SEG = l AND ITTFL = 'Y' GROUP BY a, l"""))
def _(spark, sf):
    adsl = subjects(spark, sf).filter("ITTFL = 'Y'")
    return ard.ard_categorical(adsl, "ARM", "SEG", _SEGS, ARM_LEVELS, ard.population_n(adsl, "ITTFL"))


@query("write_ard", ORACLE["ard_categorical"])
def _(spark, sf):
    """Statistics written as CSV and JSON and read back from JSON."""
    adsl = subjects(spark, sf).filter("ITTFL = 'Y'")
    df = ard.ard_categorical(adsl, "ARM", "SEG", _SEGS, ARM_LEVELS, ard.population_n(adsl, "ITTFL"))
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    wr.write_ard(df, path)
    return spark.read.schema(df.schema).json(f"{path}/json")


_HIER = """
  SELECT g.a AS ARM, g.AESOC, g.AEDECOD, CAST(g.depth AS BIGINT) AS depth, coalesce(c.s, 0) AS subjects, coalesce(c.e, 0) AS events, n.N,
    r6(100.0 * coalesce(c.s, 0) / n.N) AS pct
  FROM (SELECT * FROM (SELECT DISTINCT CAST(NULL AS VARCHAR) AS AESOC, CAST(NULL AS VARCHAR) AS AEDECOD, 0 AS depth FROM ev
        UNION ALL SELECT DISTINCT AESOC, NULL, 1 FROM ev UNION ALL SELECT DISTINCT AESOC, AEDECOD, 2 FROM ev)
        CROSS JOIN (VALUES ('Placebo'), ('Low Dose'), ('High Dose')) t(a)) g
  LEFT JOIN (SELECT ARM, CAST(NULL AS VARCHAR) AS AESOC, CAST(NULL AS VARCHAR) AS AEDECOD, 0 AS depth, count(DISTINCT USUBJID) AS s, count(*) AS e FROM ev GROUP BY ARM
    UNION ALL SELECT ARM, AESOC, NULL, 1, count(DISTINCT USUBJID), count(*) FROM ev GROUP BY ARM, AESOC
    UNION ALL SELECT ARM, AESOC, AEDECOD, 2, count(DISTINCT USUBJID), count(*) FROM ev GROUP BY ARM, AESOC, AEDECOD) c
    ON c.ARM = g.a AND c.depth = g.depth AND c.AESOC IS NOT DISTINCT FROM g.AESOC AND c.AEDECOD IS NOT DISTINCT FROM g.AEDECOD
  LEFT JOIN (SELECT ARM, count(*) AS N FROM subjects WHERE SAFFL = 'Y' GROUP BY ARM) n ON n.ARM = g.a"""


def _teae(spark, sf):
    return d.flag_teae(ae(spark, sf)).filter("TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y'")


def _safety_n(spark, sf):
    return ard.population_n(subjects(spark, sf).filter("ARM IS NOT NULL"), "SAFFL")


@query("incidence_teae", with_views("teae subjects", _HIER, ev="SELECT * FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y'"))
def _(spark, sf):
    return ard.by_frequency(ard.ard_hierarchical(_teae(spark, sf), _safety_n(spark, sf), ARM_LEVELS))


@query("incidence_serious", with_views("teae subjects", _HIER, ev="SELECT * FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y' AND AESER = 'Y'"))
def _(spark, sf):
    return ard.ard_hierarchical(_teae(spark, sf).filter("AESER = 'Y'"), _safety_n(spark, sf), ARM_LEVELS)


@query("incidence_max_severity", with_views("teae subjects", """
  SELECT x.ARM, AESOC, AEDECOD, AESEVN, count(*) AS subjects, any_value(n.N) AS N, r6(100.0 * count(*) / any_value(n.N)) AS pct
  FROM (SELECT ARM, AESOC, AEDECOD, USUBJID, max(AESEVN) AS AESEVN FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y' GROUP BY ALL) x
  JOIN (SELECT ARM, count(*) AS N FROM subjects WHERE SAFFL = 'Y' GROUP BY ARM) n ON n.ARM = x.ARM GROUP BY x.ARM, AESOC, AEDECOD, AESEVN"""))
def _(spark, sf):
    return ard.ard_max_severity(_teae(spark, sf), _safety_n(spark, sf), ARM_LEVELS)


_REL = "SELECT *, CASE AESEQ % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END::BIGINT AS AERELN, CASE WHEN AESEQ % 11 = 0 THEN 'DRUG WITHDRAWN' ELSE 'DOSE NOT CHANGED' END AS AEACN, CASE WHEN AESEQ % 97 = 0 THEN 'FATAL' ELSE 'RECOVERED' END AS AEOUT FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y'"


def _related(spark, sf):
    """Events with relationship (1 to 3), action taken and outcome."""
    n = F.col("AESEQ")
    return _teae(spark, sf).withColumns({
        "AERELN": (n % 3 + 1).cast("bigint"), "AEACN": F.when(n % 11 == 0, "DRUG WITHDRAWN").otherwise("DOSE NOT CHANGED"),
        "AEOUT": F.when(n % 97 == 0, "FATAL").otherwise("RECOVERED")})


@query("incidence_by_relationship", with_views("teae subjects", """
  SELECT x.ARM, AESOC, AEDECOD, AERELN, count(*) AS subjects, any_value(n.N) AS N, r6(100.0 * count(*) / any_value(n.N)) AS pct
  FROM (SELECT ARM, AESOC, AEDECOD, USUBJID, max(AERELN) AS AERELN FROM rel GROUP BY ALL) x
  JOIN (SELECT ARM, count(*) AS N FROM subjects WHERE SAFFL = 'Y' GROUP BY ARM) n ON n.ARM = x.ARM GROUP BY x.ARM, AESOC, AEDECOD, AERELN""", rel=_REL))
def _(spark, sf):
    """Subjects per term by their closest relationship to the drug."""
    return ard.ard_max_severity(_related(spark, sf), _safety_n(spark, sf), ARM_LEVELS, severity="AERELN")


@query("incidence_discontinuation", with_views("teae subjects", _HIER, rel=_REL, ev="SELECT * FROM rel WHERE AEACN = 'DRUG WITHDRAWN'"))
def _(spark, sf):
    """Events that led to the end of treatment, by class and term."""
    return ard.ard_hierarchical(_related(spark, sf).filter("AEACN = 'DRUG WITHDRAWN'"), _safety_n(spark, sf), ARM_LEVELS)


@query("incidence_deaths", with_views("teae subjects", _HIER, rel=_REL, ev="SELECT * FROM rel WHERE AEOUT = 'FATAL'"))
def _(spark, sf):
    """Fatal events by class and term."""
    return ard.ard_hierarchical(_related(spark, sf).filter("AEOUT = 'FATAL'"), _safety_n(spark, sf), ARM_LEVELS)


@query("conmeds_by_class", with_views("subjects", _HIER.replace("AESOC", "CMCLAS").replace("AEDECOD", "CMDECOD"), ev="""
  SELECT s.ARM, s.USUBJID, 'Class ' || l_suppkey % 5 AS CMCLAS, 'Drug ' || l_suppkey % 5 || l_returnflag || l_linestatus AS CMDECOD FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN subjects s ON s.USUBJID = o_custkey WHERE SAFFL = 'Y' AND ARM IS NOT NULL AND CAST(l_shipdate AS DATE) >= TRTSDT - 10000"""))
def _(spark, sf):
    """Concomitant medication by class and drug: subjects and records."""
    from ..operators.groups import keyed_join

    doses = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_suppkey") % 5).cast("string").alias("__c"), "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("CMDT"))
    who = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("USUBJID"))
    adsl = subjects(spark, sf).filter("SAFFL = 'Y' AND ARM IS NOT NULL").select("USUBJID", "ARM", "TRTSDT")
    taken = keyed_join(keyed_join(doses, who, ["o_orderkey"], "inner"), adsl, ["USUBJID"], "inner").filter(F.col("CMDT") >= F.date_sub("TRTSDT", 10000))
    taken = taken.select("ARM", "USUBJID", F.concat(F.lit("Class "), "__c").alias("CMCLAS"), F.concat(F.lit("Drug "), "__c", "l_returnflag", "l_linestatus").alias("CMDECOD"))
    return ard.ard_hierarchical(taken, _safety_n(spark, sf), ARM_LEVELS, levels=("CMCLAS", "CMDECOD"))


_SHIFT = """CASE WHEN {} < 10 THEN 'LOW' WHEN {} > 50 THEN 'HIGH' ELSE 'NORMAL' END"""


def _ranges(spark, sf):
    ind = lambda c: s.range_indicator(c, F.lit(10.0), F.lit(50.0))
    return analysis(spark, sf).filter("AVISITN > 0 AND BASE IS NOT NULL").withColumns({"BNRIND": ind("BASE"), "ANRIND": ind("AVAL")})


_RANGES = f"SELECT *, {_SHIFT.format('BASE', 'BASE')} AS BNRIND, {_SHIFT.format('AVAL', 'AVAL')} AS ANRIND FROM analysis WHERE AVISITN > 0 AND BASE IS NOT NULL"


@query("shift_by_visit", with_views("analysis", "SELECT ARM, PARAMCD, AVISITN, BNRIND, ANRIND, count(*) AS n FROM rng GROUP BY ALL", rng=_RANGES))
def _(spark, sf):
    return ard.ard_shift(_ranges(spark, sf), ["ARM", "PARAMCD", "AVISITN"])


@query("shift_worst_post_baseline", with_views("analysis", """
  SELECT ARM, PARAMCD, BNRIND, CASE wst WHEN 1 THEN 'NORMAL' WHEN 2 THEN 'LOW' ELSE 'HIGH' END AS ANRIND, count(*) AS n FROM (
    SELECT ARM, PARAMCD, USUBJID, any_value(BNRIND) AS BNRIND, max(CASE ANRIND WHEN 'NORMAL' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END) AS wst FROM rng GROUP BY ALL)
  GROUP BY ALL""", rng=_RANGES))
def _(spark, sf):
    return ard.worst_shift(_ranges(spark, sf), ["ARM", "PARAMCD"], ["USUBJID"], ["NORMAL", "LOW", "HIGH"])


@query("beyond_normal_range", with_views("analysis", """
  SELECT ARM, PARAMCD, count(*) FILTER (ANRIND = 'NORMAL') AS normal, count(*) FILTER (ANRIND <> 'NORMAL') AS abnormal, count(*) AS n
  FROM rng GROUP BY ALL""", rng=_RANGES))
def _(spark, sf):
    return ard.beyond_range(_ranges(spark, sf), ["ARM", "PARAMCD"])


_EOS = """SELECT s.*, CASE WHEN DSDECOD = 'COMPLETED' THEN 'COMPLETED' WHEN DSDECOD IS NOT NULL THEN 'DISCONTINUED' ELSE 'ONGOING' END AS EOSSTT,
  CASE WHEN DSDECOD <> 'COMPLETED' THEN DSDECOD END AS DCSREAS FROM subjects s
  LEFT JOIN (SELECT * FROM disp QUALIFY row_number() OVER (PARTITION BY USUBJID ORDER BY DSDT DESC, DSSEQ DESC) = 1) USING (USUBJID) WHERE ITTFL = 'Y'"""


@query("ard_disposition", with_views("subjects disp", """
  SELECT ARM, EOSSTT, DCSREAS, count(*) AS n, sum(count(*)) OVER (PARTITION BY ARM)::BIGINT AS total,
    r6(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ARM)) AS pct FROM eos GROUP BY ARM, EOSSTT, DCSREAS""", eos=_EOS))
def _(spark, sf):
    return ard.ard_disposition(d.disposition(subjects(spark, sf).filter("ITTFL = 'Y'"), disp(spark, sf)))


@query("subjects_by_site", with_views("subjects", """
  SELECT SITEID AS SITEGR1, ARM, count(*) AS n, count(*) FILTER (ITTFL = 'Y') AS n_itt FROM subjects GROUP BY 1, 2"""))
def _(spark, sf):
    return ard.ard_sites(subjects(spark, sf), site="SITEID").withColumnRenamed("SITEID", "SITEGR1")


@query("mean_over_time", with_views("analysis", "\nUNION ALL ".join(f"""
  SELECT PARAMCD, ARM, AVISITN, '{x}' AS variable, count({x}) AS N, r6(avg({x})) AS mean, r6(stddev_samp({x})) AS sd, min({x}) AS min, max({x}) AS max,
    r6(stddev_samp({x}) / sqrt(count({x}))) AS se FROM (SELECT PARAMCD, ARM, AVISITN, AVAL, r6(CHG) AS CHG FROM analysis) GROUP BY ALL""" for x in ("AVAL", "CHG"))))
def _(spark, sf):
    df = analysis(spark, sf).withColumn("CHG", s.display_round("CHG", 6))
    return ard.mean_over_time(df)


@query("subject_mean", with_views("analysis", """
  SELECT USUBJID, PARAMCD, ARM, r6(avg(AVAL)) AS AVAL, count(AVAL) AS n_visits FROM analysis WHERE AVISITN BETWEEN 7 AND 21 GROUP BY ALL"""))
def _(spark, sf):
    return ard.subject_mean(analysis(spark, sf), 7, 21, keep=["ARM"])


@query("event_rate", with_views("teae subjects", """
  SELECT x.ARM, days, coalesce(events, 0) AS events, r6(coalesce(events, 0) * 365.25 / days) AS rate
  FROM (SELECT ARM, sum(date_diff('day', TRTSDT, TRTEDT) + 1)::BIGINT AS days FROM subjects WHERE ITTFL = 'Y' AND SAFFL = 'Y' AND TRTEDT IS NOT NULL GROUP BY 1) x
  LEFT JOIN (SELECT ARM, count(*) AS events FROM teae WHERE TRTEMFL = 'Y' AND ITTFL = 'Y' AND SAFFL = 'Y' AND AESOC = 'error' GROUP BY 1) y ON x.ARM = y.ARM"""))
def _(spark, sf):
    exposure = subjects(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y' AND TRTEDT IS NOT NULL").withColumn("TRTDUR", s.duration("TRTSDT", "TRTEDT"))
    return ard.event_rate(_teae(spark, sf).filter("AESOC = 'error'"), exposure)


@query("ard_geometric", with_views("", """
  SELECT l_returnflag, l_linestatus, count(*) AS N, r6(exp(avg(ln(l_extendedprice)))) AS gmean,
    r6(100 * sqrt(exp(var_samp(ln(l_extendedprice))) - 1)) AS gcv, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
    r6(median(l_extendedprice)) AS median FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2"""))
def _(spark, sf):
    return ard.ard_geometric(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


_WILSON = """(r + 1.959963984540054 * 1.959963984540054 / (2 * N)) / (1 + 1.959963984540054 * 1.959963984540054 / N) {sign}
   1.959963984540054 * sqrt(r * (1 - r) / N + 1.959963984540054 * 1.959963984540054 / (4.0 * N * N)) / (1 + 1.959963984540054 * 1.959963984540054 / N)"""


@query("response_rate_wilson", with_views("endpoint", f"""
  SELECT ARM, PARAMCD, hits, N, r6(r) AS rate, r6({_WILSON.format(sign='-')}) AS lower, r6({_WILSON.format(sign='+')}) AS upper
  FROM (SELECT ARM, PARAMCD, count(*) FILTER (CHG < 0) AS hits, count(*) AS N, count(*) FILTER (CHG < 0) / count(*) AS r FROM endpoint GROUP BY 1, 2)"""))
def _(spark, sf):
    return ard.ard_proportion_ci(ard.response_counts(endpoint(spark, sf), ["ARM", "PARAMCD"], "CHG < 0"), "wilson")


@query("response_rate_exact")
def _(spark, sf):
    return ard.ard_proportion_ci(ard.response_counts(endpoint(spark, sf), ["ARM", "PARAMCD"], "CHG < 0"), "exact")


@query("ada_status", with_views("obs", """
  SELECT USUBJID, CASE WHEN bp THEN 'Y' ELSE 'N' END AS BASEPOS, CASE WHEN em THEN 'Y' ELSE 'N' END AS TEADA,
    CASE WHEN em AND pe THEN 'Y' ELSE 'N' END AS PERSIST, CASE WHEN em AND NOT pe THEN 'Y' ELSE 'N' END AS TRANSIENT, mt AS MAXTITRE
  FROM (SELECT *, coalesce(pp AND (NOT bp OR mt >= 4 * bt), false) AS em, coalesce(date_diff('day', fp, lp) >= 20 OR lp = lt, false) AS pe
    FROM (SELECT USUBJID, coalesce(bool_or(AVAL > 60 AND pre), false) AS bp, max(AVAL) FILTER (AVAL > 60 AND pre) AS bt,
        coalesce(bool_or(AVAL > 60 AND NOT pre), false) AS pp, max(AVAL) FILTER (AVAL > 60 AND NOT pre) AS mt,
        min(ADT) FILTER (AVAL > 60 AND NOT pre) AS fp, max(ADT) FILTER (AVAL > 60 AND NOT pre) AS lp, max(ADT) FILTER (NOT pre) AS lt
      FROM (SELECT *, ADT <= TRTSDT AS pre FROM obs WHERE PARAMCD = 'click') GROUP BY 1))"""))
def _(spark, sf):
    df = obs(spark, sf).filter("PARAMCD = 'click'").withColumns(
        {"RESULT": F.when(F.col("AVAL") > 60, "POSITIVE").otherwise("NEGATIVE"), "TITRE": F.col("AVAL")})
    return ard.ada_status(df, persist_days=20)


def _ada(spark, sf):
    df = obs(spark, sf).filter("PARAMCD = 'click'").withColumns(
        {"RESULT": F.when(F.col("AVAL") > 60, "POSITIVE").otherwise("NEGATIVE"), "TITRE": F.col("AVAL"),
         "NABRES": F.when(F.col("ASEQ") % 3 == 0, "POSITIVE").when(F.col("ASEQ") % 3 == 1, "NEGATIVE")})
    return ard.ada_status(df, ("USUBJID", "ARM"), persist_days=20), df


_ADA = ORACLE["ada_status"][ORACLE["ada_status"].rindex("SELECT USUBJID, CASE WHEN bp"):]


@query("ada_summary", with_views("obs subjects", """
  SELECT ARM, CAST(N AS BIGINT) AS N, status, CAST(hits AS BIGINT) AS hits, r6(100.0 * hits / N) AS pct FROM (SELECT ARM, count(*) AS N, unnest(['baseline_positive', 'treatment_emergent', 'persistent', 'transient']) AS status,
    unnest([count(*) FILTER (BASEPOS = 'Y'), count(*) FILTER (TEADA = 'Y'), count(*) FILTER (PERSIST = 'Y'), count(*) FILTER (TRANSIENT = 'Y')]) AS hits FROM st JOIN subjects USING (USUBJID) GROUP BY ARM)""", st=_ADA))
def _(spark, sf):
    return ard.ada_summary(_ada(spark, sf)[0])


@query("ada_titres", with_views("obs subjects", """
  SELECT ARM, count(*) AS N, r6(exp(avg(ln(MAXTITRE)))) AS gmean, r6(100 * sqrt(exp(var_samp(ln(MAXTITRE))) - 1)) AS gcv, min(MAXTITRE) AS min, max(MAXTITRE) AS max, r6(median(MAXTITRE)) AS median
  FROM st JOIN subjects USING (USUBJID) WHERE TEADA = 'Y' GROUP BY ARM""", st=_ADA))
def _(spark, sf):
    return ard.ada_titres(_ada(spark, sf)[0])


@query("nab_incidence", with_views("obs subjects", """
  SELECT s.ARM, count(*) AS ada_positive, count(*) FILTER (tested) AS tested, count(*) FILTER (pos) AS nab_positive, r6(100.0 * count(*) FILTER (pos) / count(*)) AS pct
  FROM st JOIN subjects s USING (USUBJID) LEFT JOIN (SELECT USUBJID, coalesce(bool_or(ADT > TRTSDT AND ASEQ % 3 = 0), false) AS pos, coalesce(bool_or(ADT > TRTSDT AND ASEQ % 3 < 2), false) AS tested
    FROM obs WHERE PARAMCD = 'click' GROUP BY 1) r USING (USUBJID) WHERE BASEPOS = 'Y' OR TEADA = 'Y' GROUP BY s.ARM""", st=_ADA))
def _(spark, sf):
    return ard.nab_incidence(*_ada(spark, sf))


@query("pro_responders", with_views("endpoint", """
  SELECT ARM, PARAMCD, count(*) FILTER (CHG <= -5) AS hits, count(*) AS N FROM endpoint GROUP BY 1, 2"""))
def _(spark, sf):
    df = ard.responder_flag(endpoint(spark, sf), 5.0)
    return ard.response_counts(df, ["ARM", "PARAMCD"], "RESPFL = 'Y'")


@query("pro_completion", with_views("analysis subjects", """
  SELECT e.ARM, e.AVISITN, e.expected, coalesce(c.n, 0) AS completed, r6(100.0 * coalesce(c.n, 0) / e.expected) AS rate FROM
    (SELECT ARM, AVISITN, count(*) AS expected FROM subjects CROSS JOIN (VALUES (CAST(0 AS BIGINT)), (7), (14), (21), (28)) t(AVISITN)
     WHERE ITTFL = 'Y' AND SAFFL = 'Y' GROUP BY 1, 2) e
  LEFT JOIN (SELECT ARM, AVISITN, count(DISTINCT USUBJID) AS n FROM analysis WHERE PARAMCD = 'view' GROUP BY 1, 2) c ON e.ARM = c.ARM AND e.AVISITN = c.AVISITN"""))
def _(spark, sf):
    adsl = subjects(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'")
    return ard.completion_rate(analysis(spark, sf).filter("PARAMCD = 'view'"), adsl, w.visit_table(spark, VISITS))


@query("waterfall", with_views("analysis", """
  SELECT USUBJID, ARM, r6(min(100.0 * (AVAL - BASE) / BASE)) AS BESTPCHG FROM analysis WHERE PARAMCD = 'view' AND AVISITN > 0 AND BASE <> 0 GROUP BY 1, 2"""))
def _(spark, sf):
    return ard.best_pct_change(analysis(spark, sf).filter("PARAMCD = 'view' AND AVISITN > 0"))


@query("spider", with_views("analysis", """
  SELECT USUBJID, ARM, ADY, r6(CASE WHEN BASE <> 0 THEN 100.0 * (AVAL - BASE) / BASE END) AS PCHG FROM analysis WHERE PARAMCD = 'view'"""))
def _(spark, sf):
    return ard.pct_change_over_time(analysis(spark, sf).filter("PARAMCD = 'view'"))


@query("swimmer", with_views("tte", "SELECT USUBJID, ARM, AVAL AS DAYS, CNSR = 0 AS EVENT FROM tte"))
def _(spark, sf):
    return ard.swimmer(v.tte(spark, sf))


@query("by_subgroup", with_views("endpoint", """
  SELECT ARM, PARAMCD, REGION, 'CHG' AS variable, count(CHG) AS N, r6(avg(CHG)) AS mean, r6(stddev_samp(CHG)) AS sd, r6(min(CHG)) AS min, r6(max(CHG)) AS max
  FROM endpoint GROUP BY ARM, PARAMCD, REGION"""))
def _(spark, sf):
    return ard.by_subgroup(lambda x, by: ard.continuous_wide(x, by, ["CHG"], {}), endpoint(spark, sf), "REGION", ["ARM", "PARAMCD"])


# ---- displays -----------------------------------------------------------------


_LAYOUT = [("n", "{N}", {"N": 0}), ("Mean (SD)", "{mean} ({sd})", {"mean": 1, "sd": 2}),
           ("Median (Range)", "{median} ({min};{max})", {"median": 1, "min": 0, "max": 0})]


def _cell(col, digits):
    """SQL: fixed-decimals text after display rounding."""
    k = 10 ** digits
    return f"printf('%.{digits}f', sign({col}) * floor(abs({col}) * {k} + 0.5) / {k} + 0.0)"


@query("render_table", with_views("endpoint", f"""
  SELECT PARAMCD, variable, CAST(line AS BIGINT) AS line, label, max(cell) FILTER (ARM = 'Placebo') AS "Placebo",
    max(cell) FILTER (ARM = 'Low Dose') AS "Low Dose", max(cell) FILTER (ARM = 'High Dose') AS "High Dose" FROM (
    SELECT ARM, PARAMCD, variable, 0 AS line, 'n' AS label, {_cell('N', 0)} AS cell FROM st
    UNION ALL SELECT ARM, PARAMCD, variable, 1, 'Mean (SD)', {_cell('mean', 1)} || ' (' || {_cell('sd', 2)} || ')' FROM st
    UNION ALL SELECT ARM, PARAMCD, variable, 2, 'Median (Range)', {_cell('md', 1)} || ' (' || {_cell('mn', 0)} || ';' || {_cell('mx', 0)} || ')' FROM st)
  GROUP BY PARAMCD, variable, line, label""", st="\nUNION ALL ".join(
    f"SELECT ARM, PARAMCD, '{x}' AS variable, CAST(count({x}) AS DOUBLE) AS N, r6(avg({x})) AS mean, r6(stddev_samp({x})) AS sd, r6(median({x})) AS md, r6(min({x})) AS mn, r6(max({x})) AS mx FROM endpoint GROUP BY 1, 2"
    for x in ("BASE", "AVAL", "CHG"))))
def _(spark, sf):
    long = ard.ard_continuous(endpoint(spark, sf), ["ARM", "PARAMCD"], ["BASE", "AVAL", "CHG"])
    # statistics are held at six decimals first, so both engines cut the same number
    long = long.withColumn("stat", s.display_round("stat", 6))
    return disp_.render_table(long, _LAYOUT, ARM_LEVELS, ["PARAMCD", "variable"])


@query("listing", with_views("teae", "SELECT USUBJID, ARM, AESOC, AEDECOD, ASTDT, AESEVN FROM teae WHERE AESER = 'Y' AND TRTEMFL = 'Y'"))
def _(spark, sf):
    df = d.flag_teae(ae(spark, sf))
    return disp_.listing(df, ["USUBJID", "ARM", "AESOC", "AEDECOD", "ASTDT", "AESEVN"], ["USUBJID", "ASTDT", "AEDECOD"],
                         "AESER = 'Y' AND TRTEMFL = 'Y'")


# ---- gates --------------------------------------------------------------------


@query("gate_analysis_n", with_views("locf subjects obs", """
  SELECT s.ARM, s.n AS n_flag, coalesce(a.n, 0) AS n_analysis, s.n - coalesce(a.n, 0) AS shortfall,
    CASE WHEN s.n = coalesce(a.n, 0) THEN 'OK' ELSE 'FAILED' END AS status
  FROM (SELECT ARM, count(*) AS n FROM subjects WHERE SAFFL = 'Y' AND ITTFL = 'Y' GROUP BY 1) s
  LEFT JOIN (SELECT ARM, count(DISTINCT USUBJID) AS n FROM locf WHERE PARAMCD = 'view' AND AVISITN = 28 GROUP BY 1) a ON s.ARM = a.ARM"""))
def _(spark, sf):
    return q.gate_n(locf(spark, sf), subjects(spark, sf).filter("ITTFL = 'Y'"), "SAFFL", "PARAMCD = 'view' AND AVISITN = 28")


@query("gate_one_primary", with_views("windowed", """
  SELECT CAST(USUBJID AS VARCHAR) || '|' || PARAMCD AS subject_key, 'one_primary' AS check_id, 'error' AS severity,
    CAST(count(*) AS VARCHAR) || ' primary records at the endpoint' AS message
  FROM windowed WHERE AVISITN = 28 GROUP BY USUBJID, PARAMCD HAVING count(*) > 1"""))
def _(spark, sf):
    df = v.windowed(spark, sf).withColumn("ANL01FL", F.lit("Y"))
    return q.gate_one_primary(df, 28).select("subject_key", "check_id", "severity", "message")


@query("gate_dropped", with_views("analysis", """
  SELECT CAST(USUBJID AS VARCHAR) || '|' || PARAMCD AS subject_key, 'dropped_from_endpoint' AS check_id FROM analysis
  GROUP BY USUBJID, PARAMCD HAVING bool_or(BASE IS NOT NULL) AND bool_or(AVISITN > 0) AND NOT bool_or(AVISITN = 28)"""))
def _(spark, sf):
    return q.gate_dropped(analysis(spark, sf).withColumn("ANL01FL", F.lit("Y")), 28).select("subject_key", "check_id")


@query("gate_sites", with_views("subjects", """
  SELECT coalesce(a.g, b.g) AS SITEGR1, coalesce(a.n, 0) AS n_stored, coalesce(b.n, 0) AS n_rule,
    CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'OK' ELSE 'FAILED' END AS status
  FROM (SELECT CASE WHEN coalesce(m, 0) >= 10 THEN SITEID ELSE '900' END AS g, count(*) AS n FROM subjects LEFT JOIN mins USING (SITEID) GROUP BY 1) a
  FULL JOIN (SELECT CASE WHEN coalesce(m, 0) >= 12 THEN SITEID ELSE '900' END AS g, count(*) AS n FROM subjects LEFT JOIN mins USING (SITEID) GROUP BY 1) b ON a.g = b.g""",
  mins="""SELECT SITEID, least(count(*) FILTER (TRT01PN = 0), count(*) FILTER (TRT01PN = 54), count(*) FILTER (TRT01PN = 81)) AS m
          FROM subjects WHERE ITTFL = 'Y' GROUP BY 1"""))
def _(spark, sf):
    stored = d.pool_sites(subjects(spark, sf), list(v.ARMS.values()), threshold=10)
    return q.gate_sites(stored, list(v.ARMS.values()), threshold=12)


@query("assert_unique", with_views("analysis", """
  SELECT sum(n)::BIGINT AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys, sum(z)::BIGINT AS null_ARM,
    CASE WHEN count(*) FILTER (n > 1) = 0 AND sum(z) = 0 THEN 'OK' ELSE 'FAILED' END AS status
  FROM (SELECT USUBJID, count(*) AS n, count(*) FILTER (ARM IS NULL) AS z FROM analysis WHERE PARAMCD = 'view' GROUP BY 1)"""))
def _(spark, sf):
    return q.assert_unique(analysis(spark, sf).filter("PARAMCD = 'view'"), ["USUBJID"], ["ARM"])


@query("check_controlled_terms", with_views("", """
  SELECT 'c_mktsegment' AS variable, c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD') GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer WHERE c_nationkey > 20 GROUP BY 2"""))
def _(spark, sf):
    codelist = [("c_mktsegment", "BUILDING"), ("c_mktsegment", "HOUSEHOLD")] + [("c_nationkey", str(i)) for i in range(21)]
    return q.check_ct(table(spark, sf, "customer"), spark.createDataFrame(codelist, "variable string, value string"), ["c_mktsegment", "c_nationkey"])


@query("check_labels", with_views("", """
  SELECT 'code_length' AS check_id, 'error' AS severity, p AS subject_key, p || ' has more than 8 characters' AS message
  FROM (SELECT DISTINCT upper(p_brand) || '_' || p_type AS p FROM part) WHERE length(p) > 8
  UNION ALL SELECT 'label_missing', 'warning', 'p_size', 'variable has no label'"""))
def _(spark, sf):
    df = table(spark, sf, "part").select(F.concat_ws("_", F.upper("p_brand"), "p_type").alias("PARAMCD"), "p_size", "p_partkey")
    df = q.with_labels(df, {"PARAMCD": "Parameter Code", "p_partkey": "Key"})
    return q.check_labels(df).select("check_id", "severity", "subject_key", "message")


@query("check_variables", sql("m_adam m_cand", """
  SELECT a.dataset || '.' || a.variable AS subject_key, CASE WHEN h.have IS NULL THEN 'required variable is absent' ELSE 'type is ' || h.have || ', specified as ' || a.type END AS message
  FROM (SELECT study_id || dataset AS dataset, variable, min(CASE WHEN role LIKE '%records' THEN 'integer' ELSE 'text' END) AS type FROM m_adam GROUP BY 1, 2) a
  LEFT JOIN (SELECT study_id || adam AS dataset, 'V' || (length(title) + 5) AS variable, max(CASE WHEN type = 'Table' THEN 'text' ELSE 'date' END) AS have FROM m_cand WHERE adam <> '' GROUP BY 1, 2) h
    ON h.dataset = a.dataset AND h.variable = a.variable WHERE h.have IS NULL OR h.have <> a.type"""))
def _(spark, sf):
    """Specified variables of every study's data sets against what the data sets hold."""
    spec = meta(spark, sf, "m_adam").groupBy(F.concat("study_id", "dataset").alias("dataset"), "variable").agg(
        F.min(F.when(F.col("role").endswith("records"), "integer").otherwise("text")).alias("type"))
    have = meta(spark, sf, "m_cand").filter(F.size("req_adam") > 0).groupBy(
        F.concat("study_id", F.element_at("req_adam", 1)).alias("dataset"), F.concat(F.lit("V"), (F.length("title") + 5).cast("string")).alias("variable")).agg(
        F.max(F.when(F.col("type") == "Table", "text").otherwise("date")).alias("have"))
    return q.check_variables(spark, have, spec).select("subject_key", "message")


@query("undeclared_qualifiers", with_views("", """
  SELECT 'event_id.' || event_type AS subject_key, count(*) || ' records of an undeclared qualifier' AS message FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY event_type"""))
def _(spark, sf):
    supp = table(spark, sf, "events").select(F.lit("event_id").alias("IDVAR"), F.col("event_type").alias("QNAM"))
    return q.undeclared_qualifiers(supp, {"event_id": ["view", "click"], None: ["error"]}).select("subject_key", "message")


@query("sanity_profile", with_views("analysis", """
  SELECT count(*) AS rows, count(DISTINCT USUBJID) AS subjects, count(DISTINCT PARAMCD) AS params, count(DISTINCT ARM) AS arms,
    count(*) FILTER (ABLFL = 'Y') AS n_ABLFL FROM analysis"""))
def _(spark, sf):
    return q.sanity(analysis(spark, sf), ["ABLFL"])


@query("tally_and_gate", with_views("", """
  SELECT CAST(o_custkey % 50 AS VARCHAR) AS study_id, count(*) FILTER (b) AS errors, count(*) FILTER (NOT b) AS others, count(*) AS total,
    CASE WHEN count(*) FILTER (b) = 0 THEN 'pass' WHEN o_custkey % 50 >= 40 THEN 'give-up' ELSE 'fail' END AS gate
  FROM (SELECT *, o_orderpriority = '1-URGENT' AND o_totalprice > 470000 AS b FROM orders) GROUP BY o_custkey % 50"""))
def _(spark, sf):
    bad = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 470000)
    found = table(spark, sf, "orders").select((F.col("o_custkey") % 50).cast("string").alias("study_id"),
                                              F.when(bad, "Critical").otherwise("Notice").alias("severity"))
    attempts = F.when(F.col("study_id").cast("int") >= 40, 3).otherwise(1)
    return q.gate_status(q.tally_findings(found), attempts, 3)
