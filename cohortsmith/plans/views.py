"""Clinical views over the test tables, as DataFrames and as SQL for the oracle.

Roles: customers are subjects, events are findings and adverse events, orders and
line items are dosing and disposition.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.groups import keyed_join
from ..operators.windows import Visit

ARMS = {"Placebo": 0, "Low Dose": 54, "High Dose": 81}
ARM_LEVELS = list(ARMS)
VISITS = [Visit("Baseline", 0, 1), Visit("Day 7", 7, 7), Visit("Day 14", 14, 14), Visit("Day 21", 21, 21),
          Visit("Day 28", 28, 28)]
ENDPOINT = VISITS[-1]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark, sf):
    return table(spark, sf, "events")


def subjects(spark, sf) -> DataFrame:
    dates = events(spark, sf).groupBy(F.col("user_id").alias("__u")).agg(
        F.min(F.when(F.col("event_type") == "signup", F.to_date("ts"))).alias("TRTSDT"),
        F.max(F.when(F.col("event_type") == "purchase", F.to_date("ts"))).alias("TRTEDT"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                               F.col("n_regionkey").cast("string").alias("REGION"))
    k = F.pmod(F.col("c_custkey"), F.lit(4))
    return (
        table(spark, sf, "customer").join(nation, "c_nationkey", "left")
        .join(dates, F.col("c_custkey") == F.col("__u"), "left")
        .select(
            F.col("c_custkey").alias("USUBJID"), F.col("c_nationkey").cast("string").alias("SITEID"), "REGION",
            F.when(k == 0, "Placebo").when(k == 1, "Low Dose").when(k == 2, "High Dose").alias("ARM"),
            F.when(k == 0, 0).when(k == 1, 54).when(k == 2, 81).cast("bigint").alias("TRT01PN"),
            F.when(k < 3, "Y").otherwise("N").alias("ITTFL"),
            F.when(F.col("TRTSDT").isNotNull(), "Y").otherwise("N").alias("SAFFL"),
            "TRTSDT", "TRTEDT", F.col("c_acctbal").alias("ACCT"), F.col("c_mktsegment").alias("SEG"),
        )
    )


def obs(spark, sf) -> DataFrame:
    """Findings with the subject's arm and dates."""
    rec = events(spark, sf).select(
        F.col("user_id").alias("USUBJID"), F.col("event_type").alias("PARAMCD"), F.col("value").alias("AVAL"),
        F.to_date("ts").alias("ADT"), F.col("event_id").alias("ASEQ"))
    adsl = subjects(spark, sf).select("USUBJID", "SITEID", "REGION", "ARM", "TRT01PN", "ITTFL", "SAFFL", "TRTSDT", "TRTEDT")
    from ..functions.scalars import study_day

    return keyed_join(rec, adsl, ["USUBJID"], "inner").withColumn("ADY", study_day("ADT", "TRTSDT").cast("bigint"))


def ae(spark, sf) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    start = F.to_date("ts")
    rec = events(spark, sf).select(
        F.col("user_id").alias("USUBJID"), F.col("event_type").alias("AESOC"),
        F.concat(F.col("event_type"), F.lit("_"), F.floor(k / 20).cast("string")).alias("AEDECOD"),
        F.when(F.col("event_id") % 17 != 0, start).alias("ASTDT"),
        F.date_add(start, (F.col("event_id") % 5).cast("int")).alias("AENDT"), F.col("event_id").alias("AESEQ"),
        (F.lit(1) + k % 3).alias("AESEVN"), F.when(k % 7 == 0, "Y").otherwise("N").alias("AESER"))
    adsl = subjects(spark, sf).select("USUBJID", "ARM", "ITTFL", "SAFFL", "TRTSDT", "TRTEDT")
    return keyed_join(rec, adsl, ["USUBJID"], "inner")


def dosing(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("EXDOSE"), F.to_date("l_shipdate").alias("EXSTDT"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber").cast("int")).alias("EXENDT"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("USUBJID"))
    return keyed_join(li, o, ["o_orderkey"], "inner").drop("o_orderkey")


def disp(spark, sf) -> DataFrame:
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("USUBJID"),
        F.when(s == "F", "COMPLETED").when(s == "P", "ADVERSE EVENT").otherwise("LOST TO FOLLOW-UP").alias("DSDECOD"),
        F.to_date("o_orderdate").alias("DSDT"), F.col("o_orderkey").alias("DSSEQ"))


def windowed(spark, sf) -> DataFrame:
    """Findings of randomised, dosed subjects on analysis visits with baseline and change."""
    from ..operators import windows as w

    base = w.baseline(obs(spark, sf).filter("ITTFL = 'Y' AND SAFFL = 'Y'"))
    return w.window_visits(base, VISITS)


def analysis(spark, sf) -> DataFrame:
    """One record per subject, parameter and visit."""
    from ..operators import windows as w

    return w.analysis_records(windowed(spark, sf), keep=[
        "USUBJID", "SITEID", "REGION", "ARM", "TRT01PN", "PARAMCD", "AVISIT", "AVISITN", "ATARGDY", "AVAL", "BASE", "CHG",
        "ADT", "ADY", "ASEQ", "TRTSDT", "TRTEDT", "ABLFL"])


# ---- the same views for the oracle -----------------------------------------

SQL_VIEWS = {
    "subjects": """
      SELECT c_custkey AS USUBJID, CAST(c_nationkey AS VARCHAR) AS SITEID, CAST(n_regionkey AS VARCHAR) AS REGION,
        CASE c_custkey % 4 WHEN 0 THEN 'Placebo' WHEN 1 THEN 'Low Dose' WHEN 2 THEN 'High Dose' END AS ARM,
        CAST(CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 54 WHEN 2 THEN 81 END AS BIGINT) AS TRT01PN,
        CASE WHEN c_custkey % 4 < 3 THEN 'Y' ELSE 'N' END AS ITTFL,
        CASE WHEN d.TRTSDT IS NOT NULL THEN 'Y' ELSE 'N' END AS SAFFL, d.TRTSDT, d.TRTEDT,
        c_acctbal AS ACCT, c_mktsegment AS SEG
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END) AS TRTSDT,
                   max(CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS TRTEDT
                 FROM events GROUP BY user_id) d ON c_custkey = d.user_id""",
    "obs": """
      SELECT e.*, s.SITEID, s.REGION, s.ARM, s.TRT01PN, s.ITTFL, s.SAFFL, s.TRTSDT, s.TRTEDT,
        CASE WHEN e.ADT >= s.TRTSDT THEN date_diff('day', s.TRTSDT, e.ADT) + 1
             ELSE date_diff('day', s.TRTSDT, e.ADT) END AS ADY
      FROM (SELECT user_id AS USUBJID, event_type AS PARAMCD, value AS AVAL, CAST(ts AS DATE) AS ADT,
              event_id AS ASEQ FROM events) e JOIN subjects s USING (USUBJID)""",
    "ae": """
      SELECT e.*, s.ARM, s.ITTFL, s.SAFFL, s.TRTSDT, s.TRTEDT
      FROM (SELECT user_id AS USUBJID, event_type AS AESOC,
              event_type || '_' || CAST(k // 20 AS VARCHAR) AS AEDECOD,
              CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS DATE) END AS ASTDT,
              CAST(CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) AS DATE) AS AENDT, event_id AS AESEQ,
              1 + k % 3 AS AESEVN, CASE WHEN k % 7 = 0 THEN 'Y' ELSE 'N' END AS AESER
            FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)) e
      JOIN subjects s USING (USUBJID)""",
    "dosing": """
      SELECT o_custkey AS USUBJID, l_quantity AS EXDOSE, CAST(l_shipdate AS DATE) AS EXSTDT,
        CAST(CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) AS DATE) AS EXENDT
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "disp": """
      SELECT o_custkey AS USUBJID, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'ADVERSE EVENT'
        ELSE 'LOST TO FOLLOW-UP' END AS DSDECOD, CAST(o_orderdate AS DATE) AS DSDT, o_orderkey AS DSSEQ FROM orders""",
    "based": """
      SELECT o.*, b.BASE, CASE WHEN b.ASEQ = o.ASEQ THEN 'Y' END AS ABLFL, o.AVAL - b.BASE AS CHG
      FROM (SELECT * FROM obs WHERE ITTFL = 'Y' AND SAFFL = 'Y') o
      LEFT JOIN (SELECT USUBJID, PARAMCD, AVAL AS BASE, ASEQ FROM obs WHERE ADT <= TRTSDT AND AVAL IS NOT NULL
                 QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD ORDER BY ADT DESC, ASEQ DESC) = 1) b
        USING (USUBJID, PARAMCD)""",
    "windowed": """
      SELECT *, CASE AVISITN WHEN 0 THEN 'Baseline' ELSE 'Day ' || CAST(AVISITN AS VARCHAR) END AS AVISIT,
        CAST(CASE AVISITN WHEN 0 THEN 1 ELSE AVISITN END AS BIGINT) AS ATARGDY
      FROM (SELECT *, CAST(CASE WHEN ADY <= 1 THEN 0 WHEN ADY <= 10.5 THEN 7 WHEN ADY <= 17.5 THEN 14
              WHEN ADY <= 24.5 THEN 21 ELSE 28 END AS BIGINT) AS AVISITN
            FROM based WHERE ADY IS NOT NULL AND AVAL IS NOT NULL)""",
    "analysis": """
      SELECT * FROM windowed
      QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD, AVISITN
                                 ORDER BY abs(ADY - ATARGDY), ADY DESC, ASEQ) = 1""",
    "locf": """
      SELECT USUBJID, PARAMCD, ARM, SITEID, REGION, TRT01PN, AVISITN, AVAL, BASE, CHG, ADY, ASEQ,
        CAST(NULL AS VARCHAR) AS DTYPE FROM analysis
      UNION ALL
      SELECT USUBJID, PARAMCD, ARM, SITEID, REGION, TRT01PN, CAST(28 AS BIGINT), AVAL, BASE, AVAL - BASE, ADY, ASEQ, 'LOCF'
      FROM (SELECT * FROM analysis a WHERE AVISITN > 0 AND BASE IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM analysis e WHERE e.USUBJID = a.USUBJID AND e.PARAMCD = a.PARAMCD
                              AND e.AVISITN = 28)
            QUALIFY row_number() OVER (PARTITION BY USUBJID, PARAMCD ORDER BY AVISITN DESC) = 1)""",
    "endpoint": """
      SELECT * FROM locf WHERE AVISITN = 28 AND BASE IS NOT NULL""",
    "teae": """
      SELECT *, CASE WHEN ASTDT >= TRTSDT OR (ASTDT IS NULL AND AENDT >= TRTSDT) THEN 'Y' END AS TRTEMFL FROM ae""",
    "tte": """
      SELECT USUBJID, ARM, CAST(date_diff('day', TRTSDT, coalesce(ev, ce)) + 1 AS BIGINT) AS AVAL,
        CAST(CASE WHEN ev IS NOT NULL THEN 0 ELSE 1 END AS BIGINT) AS CNSR
      FROM (SELECT s.USUBJID, s.ARM, s.TRTSDT,
              min(CASE WHEN o.PARAMCD = 'error' AND o.AVAL > 50 AND o.ADT >= s.TRTSDT THEN o.ADT END) AS ev,
              max(CASE WHEN o.ADT >= s.TRTSDT THEN o.ADT END) AS ce
            FROM subjects s JOIN obs o USING (USUBJID)
            WHERE s.ITTFL = 'Y' AND s.TRTSDT IS NOT NULL GROUP BY ALL) WHERE coalesce(ev, ce) IS NOT NULL""",
}
_NEEDS = {"obs": ["subjects"], "ae": ["subjects"], "based": ["obs"], "windowed": ["based"], "analysis": ["windowed"],
          "locf": ["analysis"], "endpoint": ["locf"], "teae": ["ae"], "tte": ["obs", "subjects"]}


def tte(spark, sf) -> DataFrame:
    """Days from first dose to the first large error, censored at the last record."""
    from ..operators.derive import Source, derive_tte

    o = obs(spark, sf)
    adsl = subjects(spark, sf).filter("ITTFL = 'Y'")
    return derive_tte(
        adsl, "TRTSDT", [Source(o, "ADT", "Error", "PARAMCD = 'error' AND AVAL > 50")],
        [Source(o, "ADT", "Last record", None, "Last record")], {"PARAMCD": "TTERR"})


def locf(spark, sf) -> DataFrame:
    from ..operators import windows as w

    return w.locf_endpoint(analysis(spark, sf).withColumn("ANL01FL", F.lit("Y")), ENDPOINT)


def endpoint(spark, sf) -> DataFrame:
    return locf(spark, sf).filter("AVISITN = 28 AND BASE IS NOT NULL")


def _expand(sql: str) -> str:
    """Replace ``r6(x)`` by display rounding to six decimals, innermost last."""
    while True:
        m = re.search(r"\br6\(", sql)
        if not m:
            return sql
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        x = sql[m.end():i - 1]
        sql = f"{sql[:m.start()]}(sign({x}) * floor(abs({x}) * 1e6 + 0.5) / 1e6 + 0.0){sql[i:]}"


def with_views(names: str, body: str, **extra: str) -> str:
    """A query over the named views (and what they need) as one WITH statement."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _NEEDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        add(n)
    ctes = [f"{n} AS ({SQL_VIEWS[n]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return _expand(("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body)


def r6(df: DataFrame, *keep: str) -> DataFrame:
    """Round doubles to six decimals for display and widen integers, so results compare across engines."""
    from ..functions.scalars import display_round

    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        if kind in ("double", "float"):
            c = display_round(c, 6)
        elif kind in ("integer", "short", "byte", "long"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = display_round(c.cast("double"), 6)
        out.append(c.alias(f.name))
    return df.select(*out)
