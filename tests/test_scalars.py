import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortsmith.functions import scalars as s


def col(df, name):
    return [r[name] for r in df.collect()]


def test_partial_dates(spark):
    texts = ["2013", "2013-05", "2013-05-07", "2013-02-30", "", None, "2012-02", "2013-05-07T08:30", "garbage"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, DTC string").coalesce(1)
    plain = s.derive_dt(df, "DTC", "A").orderBy("i")
    assert col(plain, "ADT") == [None, None, dt.date(2013, 5, 7), None, None, None, None, dt.date(2013, 5, 7), None]
    first = s.derive_dt(df, "DTC", "A", highest="M").orderBy("i")
    assert col(first, "ADT")[:3] == [dt.date(2013, 1, 1), dt.date(2013, 5, 1), dt.date(2013, 5, 7)]
    assert col(first, "ADTF") == ["M", "D", None, None, None, None, "D", None, None]
    last = s.derive_dt(df, "DTC", "A", highest="M", date_imputation="last").orderBy("i")
    assert col(last, "ADT")[:2] == [dt.date(2013, 12, 31), dt.date(2013, 5, 31)]
    assert col(last, "ADT")[6] == dt.date(2012, 2, 29)
    day_only = s.derive_dt(df, "DTC", "A", highest="D").orderBy("i")
    assert col(day_only, "ADT")[0] is None
    stamps = s.derive_dtm(df, "DTC", "A").orderBy("i")
    assert col(stamps, "ADTM")[2] == dt.datetime(2013, 5, 7)
    assert col(stamps, "ADTM")[7] == dt.datetime(2013, 5, 7, 8, 30)
    assert col(stamps, "ADTM")[1] is None


def test_study_day_has_no_zero(spark):
    df = spark.sql("SELECT date_add(DATE'2020-01-10', x) AS d, DATE'2020-01-10' AS r FROM VALUES (-2), (-1), (0), (1) AS t(x)")
    assert [r[0] for r in df.select(s.study_day("d", "r")).collect()] == [-2, -1, 1, 2]


def test_display_round(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (-2.5,), (2.5,), (-0.004,), (None,)], "x double").coalesce(1)
    assert [r[0] for r in df.select(s.display_round("x", 2)).collect()] == [1.0, 0.28, -2.5, 2.5, 0.0, None]
    assert [r[0] for r in df.select(s.display_round("x", 0)).collect()] == [1.0, 0.0, -3.0, 3.0, 0.0, None]
    assert [r[0] for r in df.select(s.fixed_text("x", 1)).collect()] == ["1.0", "0.3", "-2.5", "2.5", "0.0", None]


def test_bands_and_ranges_keep_null(spark):
    df = spark.createDataFrame([(64.9,), (65.0,), (80.0,), (80.1,), (None,)], "a double").coalesce(1)
    assert [r[0] for r in df.select(s.band("a", *s.AGE_BANDS)).collect()] == ["<65", "65-80", "65-80", ">80", None]
    lo, hi = F.lit(65.0), F.lit(80.0)
    assert [r[0] for r in df.select(s.range_indicator("a", lo, hi)).collect()] == ["LOW", "NORMAL", "NORMAL", "HIGH", None]
    one = spark.sql("SELECT CAST(NULL AS STRING) AS b, 'HIGH' AS p")
    assert one.select(s.shift_label("b", "p")).first()[0] == "NULL to HIGH"


def test_where_clause(spark):
    df = spark.createDataFrame([("A", 1), ("A", 5), ("B", 5)], "P string, V int")
    leaf = lambda v, c, *x, order=0: {"order": order, "condition": {"variable": v, "comparator": c, "value": list(x)}}
    node = lambda op, *cs: {"compoundExpression": {"logicalOperator": op, "whereClauses": list(cs)}}
    clause = node("AND", leaf("V", "GE", 5, order=2), node("NOT", leaf("P", "EQ", "B")))
    assert df.filter(s.where_clause(clause)).count() == 1
    assert df.filter(s.where_clause(node("OR", leaf("P", "NE", "A"), leaf("V", "IN", 1, 2)))).count() == 2


def test_endpoint_text(spark):
    texts = ["Score, total of 11 items at Weeks 8 and 16", "NPI-X from Week 4 to Week 24", "*** To be determined from protocol ***", " ",
             "Adverse events", None]
    df = s.parse_endpoint(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, TEXT string")).orderBy("i")
    rows = df.collect()
    assert rows[0]["MEASURE"] == "ADAS-Cog (11)" and rows[0]["TIMEPOINTS"] == ["Week 8", "Week 16"] and not rows[0]["WINDOWED"]
    assert rows[1]["WINDOWED"] and rows[1]["TIMEPOINTS"] == ["Week 4", "Week 24"]
    assert [r["RESOLVED"] for r in rows] == [True, True, False, False, True, False]
    assert rows[2]["DOMAIN_HINT"] is None and rows[4]["DOMAIN_HINT"] == "safety-ae"


def test_infer_domains(spark):
    df = spark.createDataFrame([("from DM and EX", ["DM", "EX", "DS"]), ("a DMX thing", ["DM", "DS"]), ("x", [])], "r string, s array<string>").coalesce(1)
    assert [r[0] for r in df.select(s.infer_domains("r", "s")).collect()] == [["DM", "EX"], ["DM", "DS"], ["*"]]


def test_ordinal_endpoints_and_unknown_operators(spark):
    df = spark.createDataFrame([("Ordinal scale of improvement at Week 8",), ("Shift from baseline",)], "TEXT string")
    assert [r["MEASURE_TYPE"] for r in s.parse_endpoint(df).collect()] == ["ordinal", "categorical"]
    leaf = {"condition": {"variable": "A", "comparator": "EQ", "value": ["1"]}}
    with pytest.raises(ValueError):
        s.where_clause({"compoundExpression": {"logicalOperator": "XOR", "whereClauses": [leaf, leaf]}})


def test_age_on_leap_days(spark):
    rows = [("2000-02-29", "2019-02-28", 18), ("2000-02-29", "2019-03-01", 19), ("2000-02-29", "2020-02-29", 20), ("2000-01-31", "2020-01-30", 19)]
    df = spark.createDataFrame(rows, "b string, r string, want int").select(s.age_years(F.to_date("b"), F.to_date("r")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in df.collect())


def test_rounding_of_large_values(spark):
    got = spark.sql("SELECT 1e13D AS a, 2e13D AS b, -3.25e15D AS c").select(*[s.display_round(x, 6).alias(x) for x in "abc"]).first()
    assert tuple(got) == (1e13, 2e13, -3.25e15)
