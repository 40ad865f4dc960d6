"""Inference over the clinical views. Oracles cover estimates and statistics in closed form; p-values are unit-tested."""

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import ard, derive as d, display as disp_, glm as g, mmrm as mm, models as md, survival as sv
from . import views as v
from .registry import query
from .views import ARM_LEVELS, VISITS, analysis, endpoint, obs, subjects, table, with_views

_GROUPS = """SELECT PARAMCD, ARM, count(*) AS n, avg(BASE) AS xb, avg(CHG) AS yb, regr_sxx(CHG, BASE) AS sxx,
  regr_sxy(CHG, BASE) AS sxy, regr_syy(CHG, BASE) AS syy FROM endpoint GROUP BY 1, 2"""
_POOL = """SELECT PARAMCD, sum(n) AS n, sum(n * xb) / sum(n) AS x, sum(sxx) AS sxx, sum(sxy) AS sxy, sum(syy) AS syy, sum(sxy) / sum(sxx) AS b,
  (sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1) AS s2, sum(n) - count(*) - 1 AS df, count(*) AS k FROM gr GROUP BY 1"""
_PAIRS = "(VALUES ('Low Dose', 'Placebo'), ('High Dose', 'Placebo'), ('High Dose', 'Low Dose')) pr(hi, lo)"
_ARMS = "(VALUES ('Placebo'), ('Low Dose'), ('High Dose')) arms(ARM)"
_ANCOVA_ROWS = f"""
  SELECT PARAMCD, 'lsmean' AS kind, ARM AS term, r6(yb + p.b * (p.x - xb)) AS estimate, r6(sqrt(s2 * (1.0 / g.n + power(p.x - xb, 2) / p.sxx))) AS se,
    CAST(df AS DOUBLE) AS df FROM (SELECT * FROM pool, {_ARMS}) p LEFT JOIN gr g USING (PARAMCD, ARM) WHERE p.n > 1
  UNION ALL SELECT p.PARAMCD, 'contrast', hi || ' - ' || lo, r6((a.yb - p.b * a.xb) - (c.yb - p.b * c.xb)),
    r6(sqrt(s2 * (1.0 / a.n + 1.0 / c.n + power(a.xb - c.xb, 2) / p.sxx))), CAST(df AS DOUBLE)
  FROM (SELECT * FROM pool, {_PAIRS}) p LEFT JOIN gr a ON a.ARM = hi AND a.PARAMCD = p.PARAMCD LEFT JOIN gr c ON c.ARM = lo AND c.PARAMCD = p.PARAMCD WHERE p.n > 1"""


@query("flagship_change_from_baseline", with_views("endpoint", f"""
  SELECT PARAMCD, kind, term, estimate, se FROM (
    SELECT PARAMCD, 'mean' AS kind, ARM AS term, r6(avg(CHG)) AS estimate, r6(stddev_samp(CHG) / sqrt(count(CHG))) AS se FROM endpoint GROUP BY 1, 3
    UNION ALL SELECT PARAMCD, kind, term, estimate, se FROM ({_ANCOVA_ROWS}))""", gr=_GROUPS, pool=_POOL))
def _(spark, sf):
    """Mean change at the endpoint visit (observed or carried forward), adjusted means and their differences."""
    df = endpoint(spark, sf)
    means = df.groupBy("PARAMCD", "ARM").agg(F.avg("CHG").alias("estimate"), (F.stddev_samp("CHG") / F.sqrt(F.count("CHG"))).alias("se"))
    fit = md.ancova(df, "CHG", "ARM", ARM_LEVELS, by=["PARAMCD"]).filter("kind IN ('lsmean', 'contrast')")
    return means.select("PARAMCD", F.lit("mean").alias("kind"), F.col("ARM").alias("term"), "estimate", "se").unionByName(
        fit.select("PARAMCD", "kind", "term", "estimate", "se"))


@query("ancova_lsmeans_contrasts", with_views("endpoint", _ANCOVA_ROWS, gr=_GROUPS, pool=_POOL))
def _(spark, sf):
    return md.ancova(endpoint(spark, sf), "CHG", "ARM", ARM_LEVELS, by=["PARAMCD"]).filter(
        "kind IN ('lsmean', 'contrast')").select("PARAMCD", "kind", "term", "estimate", "se", "df")


@query("ancova_type3", with_views("endpoint", """
  SELECT PARAMCD, 'BASE' AS term, r6(b * b * sxx / s2) AS statistic, 1.0::DOUBLE AS df FROM pool
  UNION ALL SELECT PARAMCD, 'ARM', r6((t.syy - t.sxy * t.sxy / t.sxx - s2 * df) / (k - 1) / s2), CAST(k - 1 AS DOUBLE)
  FROM pool JOIN (SELECT PARAMCD, regr_sxx(CHG, BASE) AS sxx, regr_sxy(CHG, BASE) AS sxy, regr_syy(CHG, BASE) AS syy FROM endpoint GROUP BY 1) t USING (PARAMCD)""",
  gr=_GROUPS, pool=_POOL))
def _(spark, sf):
    return md.ancova(endpoint(spark, sf), "CHG", "ARM", ARM_LEVELS, by=["PARAMCD"]).filter("kind = 'type3'").select(
        "PARAMCD", "term", "statistic", "df")


@query("ancova_with_pooled_sites")
def _(spark, sf):
    """Treatment, pooled site and baseline: the full model with p-values; unit-tested against least squares."""
    df = endpoint(spark, sf)
    return md.ancova(df, "CHG", "ARM", ARM_LEVELS, {"REGION": md.factor_levels(df, "REGION")}, by=["PARAMCD"])


@query("dose_response", with_views("endpoint", """
  SELECT PARAMCD, r6(bd) AS estimate, r6(sqrt(s2 * sbb / det)) AS se, r6(bd / sqrt(s2 * sbb / det)) AS statistic, CAST(n - 1 - rank AS DOUBLE) AS df
  FROM (SELECT *, (syy - bd * sdy - bb * sby) / (n - 3) AS s2 FROM (SELECT *, (sdy * sbb - sby * sdb) / det AS bd, (sby * sdd - sdy * sdb) / det AS bb FROM (
    SELECT *, CASE WHEN sdd * sbb - sdb * sdb > 1e-10 * sdd * sbb THEN sdd * sbb - sdb * sdb END AS det,
      CASE WHEN sdd * sbb - sdb * sdb > 1e-10 * sdd * sbb THEN 2 WHEN sdd > 0 OR sbb > 0 THEN 1 ELSE 0 END AS rank FROM (SELECT PARAMCD, count(*) AS n, regr_sxx(CHG, TRT01PN) AS sdd, regr_sxx(CHG, BASE) AS sbb,
      regr_sxy(BASE, TRT01PN) AS sdb, regr_sxy(CHG, TRT01PN) AS sdy, regr_sxy(CHG, BASE) AS sby, regr_syy(CHG, BASE) AS syy FROM endpoint GROUP BY 1))))"""))
def _(spark, sf):
    return md.dose_response(endpoint(spark, sf), "CHG", "TRT01PN", by=["PARAMCD"]).select("PARAMCD", "estimate", "se", "statistic", "df")


@query("anova", with_views("endpoint", """
  SELECT PARAMCD, r6(ssb / (k - 1) / (ssw / (n - k))) AS statistic, CAST(k - 1 AS DOUBLE) AS df FROM (
    SELECT PARAMCD, sum(n * power(yb - gm, 2)) AS ssb, sum(syy) AS ssw, sum(n) AS n, count(*) AS k FROM (
      SELECT *, sum(n * yb) OVER (PARTITION BY PARAMCD) / sum(n) OVER (PARTITION BY PARAMCD) AS gm FROM gr) GROUP BY 1)""", gr=_GROUPS))
def _(spark, sf):
    return md.anova(endpoint(spark, sf), "CHG", "ARM", ARM_LEVELS, by=["PARAMCD"]).filter("kind = 'type3'").select("PARAMCD", "statistic", "df")


def _responders(spark, sf):
    return endpoint(spark, sf).withColumn("RESP", F.when(F.col("CHG") < 0, "Y").otherwise("N"))


_RESPONDERS = "SELECT *, CASE WHEN CHG < 0 THEN 'Y' ELSE 'N' END AS RESP FROM endpoint"


@query("cmh_general", with_views("endpoint", """
  SELECT PARAMCD, 'general' AS kind, CASE WHEN sum(r1 * r2 * c1 * c2) > 0 THEN r6(power(sum(a - r1 * c1 / n), 2) / sum(r1 * r2 * c1 * c2 / (n * n * (n - 1)))) END AS statistic,
    CASE WHEN sum(r1 * r2 * c1 * c2) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS df FROM (
    SELECT PARAMCD, REGION, count(*)::DOUBLE AS n, (count(*) FILTER (ARM = 'Placebo' AND RESP = 'Y'))::DOUBLE AS a, (count(*) FILTER (ARM = 'Placebo'))::DOUBLE AS r1,
      (count(*) FILTER (ARM <> 'Placebo'))::DOUBLE AS r2, (count(*) FILTER (RESP = 'Y'))::DOUBLE AS c1, (count(*) FILTER (RESP = 'N'))::DOUBLE AS c2
    FROM resp WHERE ARM IN ('Placebo', 'High Dose') GROUP BY 1, 2) WHERE n > 1 GROUP BY 1""", resp=_RESPONDERS))
def _(spark, sf):
    return md.cmh(_responders(spark, sf), "ARM", ["Placebo", "High Dose"], "RESP", ["Y", "N"], ["REGION"], by=["PARAMCD"]).drop("p")


@query("cmh_row_mean_score", with_views("endpoint", """
  SELECT PARAMCD, 'correlation' AS kind, CASE WHEN sum(sxx * syy) > 0 THEN r6(power(sum(sxy), 2) / sum(sxx * syy / (n - 1))) END AS statistic,
    CASE WHEN sum(sxx * syy) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS df FROM (
    SELECT PARAMCD, REGION, count(*) AS n, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM (
      SELECT PARAMCD, REGION, CASE ARM WHEN 'Placebo' THEN 1 WHEN 'Low Dose' THEN 2 ELSE 3 END AS x,
        CASE WHEN CHG < -20 THEN 1 WHEN CHG < 0 THEN 2 WHEN CHG < 20 THEN 3 ELSE 4 END AS y FROM endpoint) GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1"""))
def _(spark, sf):
    c = F.col("CHG")
    df = endpoint(spark, sf).withColumn("CAT", F.when(c < -20, "1").when(c < 0, "2").when(c < 20, "3").otherwise("4"))
    return md.cmh(df, "ARM", ARM_LEVELS, "CAT", ["1", "2", "3", "4"], ["REGION"], kind="correlation", by=["PARAMCD"]).drop("p")


@query("cmh_row_means_two_arms", with_views("endpoint", """
  SELECT PARAMCD, 'row_mean' AS kind, CASE WHEN sum(sxx * syy) > 0 THEN r6(power(sum(sxy), 2) / sum(sxx * syy / (n - 1))) END AS statistic,
    CASE WHEN sum(sxx * syy) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS df FROM (
    SELECT PARAMCD, REGION, count(*) AS n, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM (
      SELECT PARAMCD, REGION, CASE ARM WHEN 'Placebo' THEN 1 ELSE 0 END AS x,
        CASE WHEN CHG < -20 THEN 1 WHEN CHG < 0 THEN 2 WHEN CHG < 20 THEN 3 ELSE 4 END AS y FROM endpoint WHERE ARM IN ('Placebo', 'High Dose')) GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1"""))
def _(spark, sf):
    """Row-mean score test of an ordered response between two arms, over regions."""
    c = F.col("CHG")
    df = endpoint(spark, sf).withColumn("CAT", F.when(c < -20, "1").when(c < 0, "2").when(c < 20, "3").otherwise("4"))
    return md.cmh(df, "ARM", ["Placebo", "High Dose"], "CAT", ["1", "2", "3", "4"], ["REGION"], kind="row_mean", by=["PARAMCD"]).drop("p")


@query("ancova_site_baseline", with_views("endpoint", """
  SELECT PARAMCD, term, r6(b) AS estimate, r6(sqrt(s2 * v)) AS se, CAST(df AS DOUBLE) AS df FROM (
    SELECT PARAMCD, df, (syy - b1 * l1 - b2 * l2 - b3 * l3) / df AS s2, unnest([{term: 'ARM=Low Dose', b: b1, v: i11}, {term: 'ARM=High Dose', b: b2, v: i22}, {term: 'BASE', b: b3, v: i33}], recursive := true)
    FROM (SELECT *, i11 * l1 + i12 * l2 + i13 * l3 AS b1, i12 * l1 + i22 * l2 + i23 * l3 AS b2, i13 * l1 + i23 * l2 + i33 * l3 AS b3 FROM (
      SELECT *, (c * f - e * e) / det AS i11, (d * e - b * f) / det AS i12, (b * e - c * d) / det AS i13, (a * f - d * d) / det AS i22, (b * d - a * e) / det AS i23, (a * c - b * b) / det AS i33 FROM (
        SELECT *, a * (c * f - e * e) - b * (b * f - e * d) + d * (b * e - c * d) AS det FROM (
          SELECT PARAMCD, sum(lo * lo) AS a, sum(lo * hi) AS b, sum(hi * hi) AS c, sum(lo * ba) AS d, sum(hi * ba) AS e, sum(ba * ba) AS f,
            sum(lo * y) AS l1, sum(hi * y) AS l2, sum(ba * y) AS l3, sum(y * y) AS syy, count(*) - count(DISTINCT SITEGR1) - 3 AS df FROM centred GROUP BY 1 HAVING count(*) >= 100)))))""",
  pooled="""SELECT s.SITEID, CASE WHEN m >= 12 THEN s.SITEID ELSE '900' END AS SITEGR1 FROM (SELECT DISTINCT SITEID FROM subjects) s LEFT JOIN
    (SELECT SITEID, least(count(*) FILTER (TRT01PN = 0), count(*) FILTER (TRT01PN = 54), count(*) FILTER (TRT01PN = 81)) AS m FROM subjects WHERE ITTFL = 'Y' GROUP BY 1) USING (SITEID)""",
  centred="""SELECT PARAMCD, SITEGR1, lo - avg(lo) OVER w AS lo, hi - avg(hi) OVER w AS hi, BASE - avg(BASE) OVER w AS ba, CHG - avg(CHG) OVER w AS y FROM (
    SELECT PARAMCD, SITEGR1, BASE, CHG, (ARM = 'Low Dose')::INT::DOUBLE AS lo, (ARM = 'High Dose')::INT::DOUBLE AS hi FROM endpoint JOIN pooled USING (SITEID)) WINDOW w AS (PARTITION BY PARAMCD, SITEGR1)"""))
def _(spark, sf):
    """Change on treatment, pooled site and baseline; the oracle centres within site, which absorbs the site factor. Parameters of 100 subjects or more."""
    sites = d.pool_sites(subjects(spark, sf), list(v.ARMS.values()), threshold=12).select("USUBJID", "SITEGR1")
    df = endpoint(spark, sf).join(sites, "USUBJID")
    fit = md.ancova(df, "CHG", "ARM", ARM_LEVELS, {"SITEGR1": md.factor_levels(sites, "SITEGR1")}, by=["PARAMCD"])
    return fit.filter("kind = 'coefficient' AND (term LIKE 'ARM=%' OR term = 'BASE') AND n >= 100").select("PARAMCD", "term", "estimate", "se", "df")


@query("chi_square", with_views("endpoint", """
  SELECT *, CASE WHEN df = 2 THEN r6(exp(-statistic / 2)) END AS p FROM (SELECT PARAMCD, sum(n)::BIGINT AS total, r6(sum(n) * (sum(n * n / (r::DOUBLE * c)) - 1)) AS statistic,
    ((count(DISTINCT ARM) - 1) * (count(DISTINCT RESP) - 1)) AS df FROM (
    SELECT *, sum(n) OVER (PARTITION BY PARAMCD, ARM) AS r, sum(n) OVER (PARTITION BY PARAMCD, RESP) AS c
    FROM (SELECT PARAMCD, ARM, RESP, count(*) AS n FROM resp GROUP BY 1, 2, 3)) GROUP BY 1)""", resp=_RESPONDERS))
def _(spark, sf):
    """With two degrees of freedom the tail is closed, so p is compared there."""
    return md.chisq(_responders(spark, sf), "ARM", "RESP", ["PARAMCD"]).withColumn("p", F.when(F.col("df") == 2, F.col("p")))


_LC = "(lgamma(({0}) + 1.0) - lgamma(({1}) + 1.0) - lgamma(({0}) - ({1}) + 1.0))"


@query("fisher_exact", with_views("endpoint", f"""
  SELECT PARAMCD, any_value(n11)::DOUBLE AS n11, any_value(n12)::DOUBLE AS n12, any_value(n21)::DOUBLE AS n21, any_value(n22)::DOUBLE AS n22,
    r6(sum(pr) FILTER (pr <= p0 * (1 + 1e-7))) AS p, r6(any_value(n11 * n22 / (n12::DOUBLE * n21))) AS odds_ratio FROM (
    SELECT *, max(pr) FILTER (x = n11) OVER (PARTITION BY PARAMCD) AS p0 FROM (
      SELECT *, exp({_LC.format('n11 + n12', 'x')} + {_LC.format('n21 + n22', 'n11 + n21 - x')} - {_LC.format('n11 + n12 + n21 + n22', 'n11 + n21')}) AS pr FROM (
        SELECT *, unnest(range(greatest(0, n11 + n21 - n21 - n22), least(n11 + n12, n11 + n21) + 1)) AS x FROM (
          SELECT PARAMCD, count(*) FILTER (ARM = 'High Dose' AND RESP = 'Y') AS n11, count(*) FILTER (ARM = 'High Dose' AND RESP = 'N') AS n12,
            count(*) FILTER (ARM = 'Placebo' AND RESP = 'Y') AS n21, count(*) FILTER (ARM = 'Placebo' AND RESP = 'N') AS n22 FROM resp GROUP BY 1)))) GROUP BY 1""",
  resp=_RESPONDERS))
def _(spark, sf):
    return md.fisher2x2(_responders(spark, sf), "ARM", ["High Dose", "Placebo"], "RESP", ["Y", "N"], ["PARAMCD"])


# ---- survival -----------------------------------------------------------------

_RISK = """SELECT ARM, t, d, c, sum(d + c) OVER (PARTITION BY ARM ORDER BY t DESC)::BIGINT AS at_risk FROM (
  SELECT ARM, AVAL AS t, count(*) FILTER (CNSR = 0) AS d, count(*) FILTER (CNSR <> 0) AS c FROM tte GROUP BY 1, 2)"""
_KM = """SELECT *, CASE WHEN dead THEN 0.0 ELSE exp(ls) END AS survival, CASE WHEN NOT dead THEN gv END AS vv FROM (
  SELECT *, bool_or(d = at_risk) OVER w AS dead, sum(CASE WHEN d < at_risk THEN ln(1 - d::DOUBLE / at_risk) ELSE 0 END) OVER w AS ls,
    sum(CASE WHEN d < at_risk THEN d::DOUBLE / (at_risk::DOUBLE * (at_risk - d)) ELSE 0 END) OVER w AS gv FROM risk WINDOW w AS (PARTITION BY ARM ORDER BY t))"""


@query("kaplan_meier", with_views("tte", """
  SELECT ARM, t, d, c, at_risk, r6(survival) AS survival, r6(survival * sqrt(vv)) AS se, r6(survival / exp(1.959963984540054 * sqrt(vv))) AS lower,
    CASE WHEN vv IS NOT NULL THEN r6(least(1.0, survival * exp(1.959963984540054 * sqrt(vv)))) END AS upper FROM km""", risk=_RISK, km=_KM))
def _(spark, sf):
    return sv.kaplan_meier(v.tte(spark, sf))


@query("km_landmarks", with_views("tte", """
  SELECT ARM, CAST(x AS DOUBLE) AS time, r6(coalesce(max_by(survival, t) FILTER (t <= x), 1.0)) AS survival, coalesce(max(at_risk) FILTER (t >= x), 0) AS at_risk
  FROM km CROSS JOIN (VALUES (5), (10), (20)) tt(x) GROUP BY 1, 2, x""", risk=_RISK, km=_KM))
def _(spark, sf):
    return sv.km_landmarks(sv.kaplan_meier(v.tte(spark, sf)), [5, 10, 20])


_MEDIAN = """SELECT *, r6(CASE WHEN flat IS NOT NULL THEN (lo + coalesce(hi, lo)) / 2.0 ELSE lo END) AS median FROM (
  SELECT ARM, sum(d + c)::BIGINT AS subjects, sum(d)::BIGINT AS events, sum(c)::BIGINT AS censored, min(t) FILTER (d > 0 AND survival <= 0.5 + 1e-9) AS lo,
    min(t) FILTER (d > 0 AND survival < 0.5 - 1e-9) AS hi, min(t) FILTER (d > 0 AND abs(survival - 0.5) <= 1e-9) AS flat,
    min(t) FILTER (d > 0 AND survival / exp(1.959963984540054 * sqrt(vv)) <= 0.5 + 1e-9) AS median_lower,
    min(t) FILTER (d > 0 AND least(1.0, survival * exp(1.959963984540054 * sqrt(vv))) <= 0.5 + 1e-9) AS median_upper FROM km GROUP BY 1)"""


@query("km_summary", with_views("tte", "SELECT ARM, subjects, events, censored, median FROM med", risk=_RISK, km=_KM, med=_MEDIAN))
def _(spark, sf):
    return sv.km_summary(sv.kaplan_meier(v.tte(spark, sf))).select("ARM", "subjects", "events", "censored", "median")


@query("km_median_with_limits", with_views("tte", "SELECT ARM, subjects, events, censored, median_lower, median_upper, median FROM med", risk=_RISK, km=_KM, med=_MEDIAN))
def _(spark, sf):
    """Median survival with its limits per arm."""
    return sv.km_summary(sv.kaplan_meier(v.tte(spark, sf)))


@query("km_points", with_views("tte", """
  SELECT ARM, CAST(t AS DOUBLE) AS time, r6(survival) AS survival, c > 0 AS censor_mark, at_risk FROM km
  UNION ALL SELECT ARM, 0.0, 1.0, false, max(at_risk) FROM km GROUP BY 1""", risk=_RISK, km=_KM))
def _(spark, sf):
    return sv.km_points(sv.kaplan_meier(v.tte(spark, sf)))


@query("logrank", with_views("tte", """
  SELECT r6(power(sum(d1 - d * n1 / n), 2) / sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END)) AS statistic, 1.0::DOUBLE AS df,
    CAST(sum(d1) AS DOUBLE) AS observed_0, CAST(sum(d - d1) AS DOUBLE) AS observed_1, r6(sum(d * n1 / n)) AS expected_0, r6(sum(d * (n - n1) / n)) AS expected_1
  FROM (SELECT t, sum(e)::DOUBLE AS d, sum(e) FILTER (ARM = 'Placebo')::DOUBLE AS d1x, coalesce(sum(e) FILTER (ARM = 'Placebo'), 0)::DOUBLE AS d1,
      (SELECT count(*) FROM two x WHERE x.AVAL >= t)::DOUBLE AS n, (SELECT count(*) FROM two x WHERE x.AVAL >= t AND ARM = 'Placebo')::DOUBLE AS n1
    FROM (SELECT ARM, AVAL AS t, CASE WHEN CNSR = 0 THEN 1 ELSE 0 END AS e FROM two) GROUP BY t) WHERE d > 0""",
  two="SELECT * FROM tte WHERE ARM IN ('Placebo', 'High Dose')"))
def _(spark, sf):
    return sv.logrank(v.tte(spark, sf), "ARM", ["Placebo", "High Dose"]).drop("p")


_THREE = """SELECT * FROM (SELECT REGION, t, d, d0, d1, d2, sum(m) OVER w AS n, sum(m0) OVER w AS n0, sum(m1) OVER w AS n1, sum(m2) OVER w AS n2 FROM (
    SELECT REGION, AVAL AS t, (count(*) FILTER (CNSR = 0))::DOUBLE AS d, count(*)::DOUBLE AS m, (count(*) FILTER (ARM = 'Placebo'))::DOUBLE AS m0, (count(*) FILTER (ARM = 'Low Dose'))::DOUBLE AS m1,
      (count(*) FILTER (ARM = 'High Dose'))::DOUBLE AS m2, (count(*) FILTER (ARM = 'Placebo' AND CNSR = 0))::DOUBLE AS d0, (count(*) FILTER (ARM = 'Low Dose' AND CNSR = 0))::DOUBLE AS d1,
      (count(*) FILTER (ARM = 'High Dose' AND CNSR = 0))::DOUBLE AS d2 FROM tte JOIN (SELECT USUBJID, REGION FROM subjects) USING (USUBJID) GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY REGION ORDER BY t DESC)) WHERE d > 0"""


@query("logrank_three_arms_stratified", with_views("tte", """
  SELECT r6(x) AS statistic, 2.0::DOUBLE AS df, r6(exp(-x / 2)) AS p, o0 AS observed_0, o1 AS observed_1, o2 AS observed_2, r6(e0) AS expected_0, r6(e1) AS expected_1, r6(e2) AS expected_2
  FROM (SELECT *, ((o0 - e0) * (o0 - e0) * v11 - 2 * (o0 - e0) * (o1 - e1) * v01 + (o1 - e1) * (o1 - e1) * v00) / (v00 * v11 - v01 * v01) AS x FROM (
    SELECT sum(d0) AS o0, sum(d1) AS o1, sum(d2) AS o2, sum(d * n0 / n) AS e0, sum(d * n1 / n) AS e1, sum(d * n2 / n) AS e2, sum(h * n0 / n * (1 - n0 / n)) AS v00,
      sum(h * n1 / n * (1 - n1 / n)) AS v11, -sum(h * n0 / n * n1 / n) AS v01 FROM (SELECT *, CASE WHEN n > 1 THEN d * (n - d) / (n - 1) ELSE 0 END AS h FROM three)))""", three=_THREE))
def _(spark, sf):
    """All arms, stratified by region, with p (two degrees of freedom: a closed tail)."""
    tte = v.tte(spark, sf).join(subjects(spark, sf).select("USUBJID", "REGION"), "USUBJID")
    return sv.logrank(tte, "ARM", ARM_LEVELS, ["REGION"])


def _newton_sql(steps: int = 9) -> dict[str, str]:
    """Newton's steps for one coefficient as a chain of views; every tied event sees the risk set less its share of the tied ones."""
    views = {"pair_axis": """SELECT t, d, d1, sum(m) OVER w AS n, sum(m1) OVER w AS n1 FROM (SELECT AVAL AS t, (count(*) FILTER (CNSR = 0))::DOUBLE AS d, count(*)::DOUBLE AS m,
        (count(*) FILTER (ARM = 'High Dose'))::DOUBLE AS m1, (count(*) FILTER (ARM = 'High Dose' AND CNSR = 0))::DOUBLE AS d1 FROM tte WHERE ARM IN ('Placebo', 'High Dose') GROUP BY 1)
      WINDOW w AS (ORDER BY t DESC)""",
             "terms": "SELECT d1 / d AS share, n1 - l / d * d1 AS a, n - n1 - l / d * (d - d1) AS b FROM (SELECT *, unnest(range(0, d::BIGINT)) AS l FROM pair_axis WHERE d > 0)",
             "step0": "SELECT 0.0::DOUBLE AS beta, 0.0::DOUBLE AS info"}
    for k in range(1, steps + 1):
        views[f"step{k}"] = f"""SELECT any_value(beta) + sum(share - p) / sum(p * (1 - p)) AS beta, sum(p * (1 - p)) AS info
          FROM (SELECT share, beta, a * exp(beta) / (a * exp(beta) + b) AS p FROM terms CROSS JOIN step{k - 1})"""
    return views


@query("cox_two_arms", with_views("tte", """
  SELECT 'High Dose' AS term, r6(beta) AS estimate, r6(1 / sqrt(info)) AS se, r6(exp(beta)) AS hazard_ratio, r6(exp(beta - 1.959963984540054 / sqrt(info))) AS lower,
    r6(exp(beta + 1.959963984540054 / sqrt(info))) AS upper FROM step9""", **_newton_sql()))
def _(spark, sf):
    """Hazard ratio of two arms, Efron ties; the oracle takes the same steps in SQL, one tied event at a time."""
    tte = v.tte(spark, sf).filter("ARM IN ('Placebo', 'High Dose')")
    return sv.cox(tte, {"High Dose": F.when(F.col("ARM") == "High Dose", 1.0).otherwise(0.0)}).drop("p")


@query("cox_hazard_ratio")
def _(spark, sf):
    """Arm and a continuous covariate, Efron ties; unit-tested against direct maximisation."""
    tte = v.tte(spark, sf).join(subjects(spark, sf).select("USUBJID", "ACCT"), "USUBJID")
    dummy = lambda l: F.when(F.col("ARM") == l, 1.0).otherwise(0.0)
    return sv.cox(tte, {"Low Dose": dummy("Low Dose"), "High Dose": dummy("High Dose"), "ACCT": F.col("ACCT") / 1000.0})


@query("wilcoxon", with_views("endpoint", """
  SELECT PARAMCD, n1, n - n1 AS n2, r6(rs) AS rank_sum, r6((rs - n1 * (n + 1) / 2.0) / sqrt(n1 * (n - n1) / 12.0 * (n + 1 - ties / (n * (n - 1.0))))) AS z FROM (
    SELECT PARAMCD, count(*) FILTER (ARM = 'High Dose') AS n1, count(*) AS n, sum(mr) FILTER (ARM = 'High Dose') AS rs, sum(m * m - 1)::DOUBLE AS ties FROM (
      SELECT *, rank() OVER (PARTITION BY PARAMCD ORDER BY AVAL) + (m - 1) / 2.0 AS mr FROM (
        SELECT *, count(*) OVER (PARTITION BY PARAMCD, AVAL) AS m FROM endpoint WHERE ARM IN ('High Dose', 'Placebo'))) GROUP BY 1)"""))
def _(spark, sf):
    return sv.wilcoxon(endpoint(spark, sf), "ARM", ["High Dose", "Placebo"], by=["PARAMCD"]).drop("p")


# ---- generalised and repeated-measures models ---------------------------------------


@query("logistic_regression", with_views("endpoint", """
  SELECT 'High Dose' AS term, r6(ln(a * d / (b * c))) AS estimate, r6(sqrt(1 / a + 1 / b + 1 / c + 1 / d)) AS se FROM cells
  UNION ALL SELECT 'intercept', r6(ln(c / d)), r6(sqrt(1 / c + 1 / d)) FROM cells""",
  cells="""SELECT (count(*) FILTER (ARM = 'High Dose' AND CHG < 0))::DOUBLE AS a, (count(*) FILTER (ARM = 'High Dose' AND CHG >= 0))::DOUBLE AS b,
    (count(*) FILTER (ARM = 'Placebo' AND CHG < 0))::DOUBLE AS c, (count(*) FILTER (ARM = 'Placebo' AND CHG >= 0))::DOUBLE AS d
    FROM endpoint WHERE ARM IN ('High Dose', 'Placebo') AND CHG IS NOT NULL"""))
def _(spark, sf):
    df = endpoint(spark, sf).filter("ARM IN ('High Dose', 'Placebo')").withColumn("Y", F.when(F.col("CHG") < 0, 1.0).otherwise(0.0))
    return g.glm(df, "Y", {"High Dose": F.when(F.col("ARM") == "High Dose", 1.0).otherwise(0.0)}).select("term", "estimate", "se")


def _event_counts(spark, sf):
    n = obs(spark, sf).filter("PARAMCD = 'error' AND AVAL > 40").groupBy("USUBJID").agg(F.count(F.lit(1)).alias("Y"))
    base = subjects(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'").select("USUBJID", "ARM")
    return base.join(n, "USUBJID", "left").fillna(0, ["Y"])


_COUNTS = """SELECT s.USUBJID, s.ARM, coalesce(n, 0) AS Y FROM subjects s LEFT JOIN (SELECT USUBJID, count(*) AS n FROM obs WHERE PARAMCD = 'error' AND AVAL > 40 GROUP BY 1) o
  USING (USUBJID) WHERE ITTFL = 'Y' AND SAFFL = 'Y'"""


def _arm_dummies():
    return {l: F.when(F.col("ARM") == l, 1.0).otherwise(0.0) for l in ARM_LEVELS[1:]}


@query("poisson_regression", with_views("obs", """
  SELECT 'intercept' AS term, r6(ln(sy / n)) AS estimate, r6(sqrt(1 / sy)) AS se FROM ct WHERE ARM = 'Placebo'
  UNION ALL SELECT a.ARM, r6(ln(a.sy / a.n) - ln(b.sy / b.n)), r6(sqrt(1 / a.sy + 1 / b.sy)) FROM ct a, ct b WHERE b.ARM = 'Placebo' AND a.ARM <> 'Placebo'""",
  cnt=_COUNTS, ct="SELECT ARM, count(*)::DOUBLE AS n, sum(Y)::DOUBLE AS sy FROM cnt GROUP BY 1"))
def _(spark, sf):
    return g.glm(_event_counts(spark, sf), "Y", _arm_dummies(), "poisson").select("term", "estimate", "se")


@query("negative_binomial_regression", with_views("obs", """
  SELECT 'intercept' AS term, r6(ln(sy / n)) AS estimate FROM ct WHERE ARM = 'Placebo'
  UNION ALL SELECT a.ARM, r6(ln(a.sy / a.n) - ln(b.sy / b.n)) FROM ct a, ct b WHERE b.ARM = 'Placebo' AND a.ARM <> 'Placebo'""",
  cnt=_COUNTS, ct="SELECT ARM, count(*)::DOUBLE AS n, sum(Y)::DOUBLE AS sy FROM cnt GROUP BY 1"))
def _(spark, sf):
    # with one dummy per arm the mean part is the log of the arm means; the size parameter is unit-tested
    return g.negbin(_event_counts(spark, sf), "Y", _arm_dummies()).filter("term <> 'log_size'").select("term", "estimate")


@query("proportional_odds")
def _(spark, sf):
    """Ordered change categories on arm; unit-tested."""
    c = F.col("CHG")
    df = endpoint(spark, sf).withColumn("CAT", F.when(c < -20, "worse").when(c < 0, "low").when(c < 20, "mid").otherwise("high"))
    return g.prop_odds(df, "CAT", ["worse", "low", "mid", "high"], _arm_dummies())


@query("mmrm")
def _(spark, sf):
    """Change at all post-baseline visits per parameter; unit-tested against direct likelihood."""
    df = analysis(spark, sf).filter("AVISITN > 0 AND BASE IS NOT NULL")
    return mm.mmrm(df, "CHG", "AVISITN", [v_.number for v_ in VISITS[1:]], "ARM", ARM_LEVELS, by=["PARAMCD"])


@query("mmrm_complete_visits", with_views("analysis", """
  SELECT m.method, v.PARAMCD, CAST(v.AVISITN AS VARCHAR) AS visit, hi || ' - ' || lo AS term, r6((a.yb - v.b * a.xb) - (c.yb - v.b * c.xb)) AS estimate,
    r6(sqrt(s2 * (1.0 / a.n + 1.0 / c.n + power(a.xb - c.xb, 2) / v.sxx))) AS se, CAST(df AS DOUBLE) AS df
  FROM pool v CROSS JOIN """ + _PAIRS + """ CROSS JOIN (VALUES ('satterthwaite'), ('kenward-roger')) m(method)
  JOIN gr a ON a.ARM = hi AND a.PARAMCD = v.PARAMCD AND a.AVISITN = v.AVISITN JOIN gr c ON c.ARM = lo AND c.PARAMCD = v.PARAMCD AND c.AVISITN = v.AVISITN""",
  two="SELECT * FROM analysis WHERE AVISITN IN (7, 14) AND BASE IS NOT NULL AND CHG IS NOT NULL",
  complete="SELECT t.* FROM two t JOIN (SELECT USUBJID, PARAMCD FROM two GROUP BY 1, 2 HAVING count(*) = 2) USING (USUBJID, PARAMCD)",
  big="SELECT f.* FROM complete f JOIN (SELECT PARAMCD FROM complete GROUP BY 1 HAVING count(*) >= 40 AND count(DISTINCT ARM) = 3) USING (PARAMCD)",
  gr="SELECT PARAMCD, AVISITN, ARM, count(*) AS n, avg(BASE) AS xb, avg(CHG) AS yb, regr_sxx(CHG, BASE) AS sxx, regr_sxy(CHG, BASE) AS sxy, regr_syy(CHG, BASE) AS syy FROM big GROUP BY 1, 2, 3",
  pool="""SELECT PARAMCD, AVISITN, sum(sxx) AS sxx, sum(sxy) / sum(sxx) AS b, (sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1) AS s2,
    sum(n) - count(*) - 1 AS df FROM gr GROUP BY 1, 2"""))
def _(spark, sf):
    """Subjects seen at both of two visits: there the likelihood has a closed solution, an analysis of covariance per visit, and both methods agree with it."""
    df = analysis(spark, sf).filter("AVISITN IN (7, 14) AND BASE IS NOT NULL AND CHG IS NOT NULL")
    both = df.groupBy("USUBJID", "PARAMCD").count().filter("count = 2").drop("count")
    df = df.join(both, ["USUBJID", "PARAMCD"])
    large = df.groupBy("PARAMCD").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ARM").alias("arms")).filter("n >= 40 AND arms = 3")
    df = df.join(large.select("PARAMCD"), "PARAMCD")
    fits = [mm.mmrm(df, "CHG", "AVISITN", [7, 14], "ARM", ARM_LEVELS, by=["PARAMCD"], method=m).withColumn("method", F.lit(m)) for m in ("satterthwaite", "kenward-roger")]
    return fits[0].unionByName(fits[1]).filter("kind = 'contrast'").select("method", "PARAMCD", "visit", "term", "estimate", "se", F.round("df", 3).alias("df"))


@query("display_with_model")
def _(spark, sf):
    """Endpoint display: descriptive cells and model cells of one parameter side by side."""
    df = endpoint(spark, sf).filter("PARAMCD = 'view'")
    long = ard.ard_continuous(df, ["ARM"], ["BASE", "AVAL", "CHG"])
    fit = md.ancova(df, "CHG", "ARM", ARM_LEVELS).filter("kind = 'lsmean'").select(
        F.lit("ARM").alias("group1"), F.col("term").alias("group1_level"), F.lit("LSMEAN").alias("variable"), "estimate", "se")
    model = fit.unpivot(["group1", "group1_level", "variable"], ["estimate", "se"], "stat_name", "stat")
    both = long.select("group1", "group1_level", "variable", "stat_name", "stat").unionByName(model)
    layout = [("Mean (SD)", "{mean} ({sd})", {"mean": 1, "sd": 2}), ("LS mean (SE)", "{estimate} ({se})", {"estimate": 1, "se": 2})]
    return disp_.render_table(both, layout, ARM_LEVELS, ["variable"])
