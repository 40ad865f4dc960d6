import json

import pytest
from pyspark.sql import functions as F

from cohortsmith.operators import ard, models as md, portfolio as p, quality as q, recipes as rc
from cohortsmith.sources import readers as rd


def leaf(variable, comparator, *value):
    return {"condition": {"variable": variable, "comparator": comparator, "value": list(value)}}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, ["P", "L", None][i % 3], "XY"[i % 2], f"T{i % 4}", float(i * i % 17) if i % 5 else None, float(i % 7), ["LOW", "HIGH", None][i % 7 % 3]) for i in range(400)]
    return spark.createDataFrame(rows, "USUBJID int, ARM string, PARAMCD string, TERM string, CHG double, BASE double, IND string").cache()


def key(rows, *names):
    return {tuple(r[n] for n in names): r["stat"] for r in rows}


def test_twenty_recipes_equal_direct_calls_on_one_scan(spark, records):
    either = {"compoundExpression": {"logicalOperator": "OR", "whereClauses": [leaf("BASE", "GE", "5"), {"compoundExpression": {
        "logicalOperator": "NOT", "whereClauses": [leaf("PARAMCD", "EQ", "X")]}}]}}
    many = [rc.Recipe(f"D{k}", "Descriptive", ("CHG",), by="PARAMCD", clauses=(leaf("BASE", "GE", str(k)),)) for k in range(7)]
    many += [rc.Recipe(f"C{k}", "Categories", ("IND",), clauses=(leaf("BASE", "EQ", str(k)),)) for k in range(6)]
    many += [rc.Recipe(f"I{k}", "Incidence", ("TERM",), clauses=(leaf("BASE", "LE", str(k)),)) for k in range(6)]
    many += [rc.Recipe("E", "Descriptive", ("CHG", "BASE"), clauses=(either,))]
    out = rc.run_recipes(records, many, records.select("USUBJID", "ARM")).collect()
    assert len({r["analysis_id"] for r in out}) == 20
    got = key([r for r in out if r["analysis_id"] == "D3"], "group1_level", "group2_level", "stat_name")
    want = ard.ard_continuous(records.filter("BASE >= 3"), ["ARM", "PARAMCD"], ["CHG"]).collect()
    assert got == pytest.approx({(r["group1_level"], r["PARAMCD"], r["stat_name"]): r["stat"] for r in want})
    got = key([r for r in out if r["analysis_id"] == "E" and r["variable"] == "CHG"], "group1_level", "stat_name")
    want = ard.ard_continuous(records.filter("BASE >= 5 OR NOT PARAMCD = 'X'"), ["ARM"], ["CHG"]).collect()
    assert got == pytest.approx({(r["group1_level"], r["stat_name"]): r["stat"] for r in want})
    got = key([r for r in out if r["analysis_id"] == "C1" and r["stat_name"] == "n"], "group1_level", "variable_level")
    want = records.filter("BASE = 1").groupBy("ARM", "IND").count().collect()
    assert got == {(r["ARM"], r["IND"]): r["count"] for r in want}
    got = key([r for r in out if r["analysis_id"] == "I2" and r["stat_name"] == "n"], "group1_level", "variable_level")
    want = records.filter("BASE <= 2").groupBy("ARM", "TERM").agg(F.countDistinct("USUBJID").alias("n")).collect()
    assert got == {(r["ARM"], r["TERM"]): r["n"] for r in want}
    assert {r["stat"] for r in out if r["context"] == "Incidence" and r["stat_name"] == "N" and r["group1_level"] == "P"} == {134.0}


def test_recipes_share_one_scan(spark, sf):
    src = spark.read.parquet(f"{sf}/lineitem.parquet")
    tagged = rc.tag(src, [rc.Recipe(f"R{k}", "Descriptive", ("l_quantity", "l_tax"), arm="l_returnflag", clauses=(leaf("l_linenumber", "EQ", str(k)),)) for k in range(20)])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_models_are_fitted_side_by_side(spark, records):
    rows = [rc.Recipe(f"A{x}", "ANCOVA", ("CHG",), clauses=(leaf("PARAMCD", "EQ", x),), levels=("P", "L")) for x in "XY"]
    out = key(rc.run_recipes(records, rows).collect(), "analysis_id", "variable_level", "stat_name")
    want = md.ancova(records, "CHG", "ARM", ["P", "L"], by=["PARAMCD"]).filter("kind IN ('lsmean', 'contrast')").collect()
    assert out == pytest.approx({(f"A{r['PARAMCD']}", r["term"], n): r[n] for r in want for n in ("estimate", "se", "df")})


def test_refusals_and_no_rows(spark, records):
    one = rc.Recipe("A", "Descriptive", ("CHG",), clauses=(leaf("BASE", "GT", "1000"),))
    assert rc.run_recipes(records, [one]).count() == 0
    assert rc.run_recipes(records.limit(0), [one]).count() == 0
    with pytest.raises(ValueError):
        rc.run_recipes(records, [one, one])
    with pytest.raises(ValueError):
        rc.run_recipes(records, [])
    with pytest.raises(ValueError):
        rc.run_recipes(records, [rc.Recipe("I", "Incidence", ("TERM",))])


def test_a_group_without_a_value_keeps_its_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("b", None)], "ARM string, CHG double")
    got = {r["ARM"]: r for r in ard.continuous_wide(df, ["ARM"], ["CHG"]).collect()}
    assert got["b"]["N"] == 0 and got["b"]["mean"] is None and got["b"]["median"] is None and (got["a"]["N"], got["a"]["median"]) == (2, 2.0)


def test_plan_to_recipes(spark):
    rows = [("S", "C1", "Table", "efficacy", "Change - LOCF", "ANCOVA", "Efficacy", "Week 24", "LOCF", "Sex=Male", "planned", ["E1"], ["ADSL", "ADQS"], "T-14-3.01", "Dose-response"),
            ("S", "C2", "Table", "safety-lab", "Shift", "ShiftTable", "All Subjects", None, "none", None, "planned", [], ["ADLB"], "T-14-6.01", "CMH"),
            ("S", "C3", "Table", "safety-lab", "Later", "Descriptive", "Safety", None, "none", None, "blocked", [], ["ADLB"], None, None)]
    numbered = spark.createDataFrame(rows, "study_id string, candidate_id string, type string, category string, title string, method string, population string, timepoint string, "
                                     "imputation string, subgroup string, status string, endpoint_ids array<string>, req_adam array<string>, final_id string, comparison string"
                                     ).withColumn("objective_ids", F.array().cast("array<string>"))
    got = {r["table_id"]: r for r in rc.recipe_rows(numbered).collect()}
    assert set(got) == {"14-3.01", "14-6.01"}
    a, b = got["14-3.01"], got["14-6.01"]
    assert (a["reason"], a["dataset"], a["response"], a["baseline"]) == ("SPECIFIED IN SAP", "ADQS", "CHG", "BASE") and (b["reason"], b["dataset"]) == ("CONVENTION", "ADLB")
    assert b["analysis_set"] is None and b["subset"] is None and b["subgroup"] is None
    data = spark.createDataFrame([(1, "Y", "Week 24", "Y", "M"), (2, "N", "Week 24", "Y", "M"), (3, "Y", "Week 8", "Y", "M"), (4, "Y", "Week 24", None, "M"), (5, "Y", "Week 24", "Y", "F")],
                                 "i int, EFFFL string, AVISIT string, ANL01FL string, SEX string")
    from cohortsmith.functions.scalars import where_clause
    for name in ("analysis_set", "subset", "subgroup"):
        data = data.filter(where_clause(json.loads(a[name])))
    assert [r["i"] for r in data.collect()] == [1]
    steps = [(r["table_id"] if "table_id" in r else r["analysis_id"], r["method_type"]) for r in rc.method_rows(numbered).orderBy("analysis_id", "method_order", "operation_order").collect()]
    assert list(dict.fromkeys(steps)) == [("AN-14-3.01", "Descriptive"), ("AN-14-3.01", "ANCOVA"), ("AN-14-3.01", "DoseResponse"), ("AN-14-6.01", "ShiftTable"), ("AN-14-6.01", "CMH")]


def test_contents_of_any_depth_in_one_scan(spark, tmp_path):
    deep = {"name": "leaf", "analysisId": 7}
    for k in range(19):
        deep = {"name": f"level {k}", "sublist": {"listItems": [deep]}}
    rows = [("S", json.dumps({"mainListOfContents": {"contentsList": {"listItems": [deep, {"name": None}]}}})), ("T", "{broken"), ("U", None), ("V", "[]"),
            ("W", json.dumps({"otherListsOfContents": [{"contentsList": {"listItems": [{"name": "x"}]}}, None]}))]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "study_id string, doc string").write.parquet(path)
    out = rd.flatten_contents(spark.read.parquet(path))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = out.collect()
    assert len(got) == 22 and {(r["depth"], r["analysis_id"]) for r in got if r["name"] == "leaf"} == {(20, "7")}
    assert [(r["list"], r["path"]) for r in got if r["study_id"] == "W"] == [("other", "listItems/0")]


def test_flags_of_a_profile_from_data(spark):
    studies = spark.createDataFrame([(s, "Phase I Trial", "A study") for s in "ABC"], "study_id string, phase string, title string")
    ends = spark.createDataFrame([("A", "Adverse events leading to discontinuation", "safety-ae"), ("B", "Score", None)], "study_id string, text string, domain_hint string")
    arms = spark.createDataFrame([("A", "Drug", "Active")], "study_id string, name string, type string")
    est = spark.createDataFrame([("B", "Main", "Adults, subgroups by sex")], "study_id string, name string, population_summary string")
    reg = spark.createDataFrame([("A", "EU"), ("A", "US"), ("A", None), ("B", "EU"), ("B", "EU")], "study_id string, region string")
    inv = spark.createDataFrame([("C", "dd"), ("C", "MH")], "study_id string, domain string")
    got = {r["study_id"]: r.asDict() for r in p.profile_studies(studies, ends, arms, inventory=inv, estimands=est, regions=reg).collect()}
    of = lambda f: {s for s, r in got.items() if r[f]}
    assert of("needs_subgroup_by_region") == {"A"} and of("needs_subgroup_by_sex") == {"B"} and of("reports_ae_discontinuation") == {"A"}
    assert of("reports_deaths") == {"C"} and of("medical_history_available") == {"C"} and of("not_covered_by_safety") == {"B", "C"}


def test_undeclared_qualifiers_are_found(spark):
    supp = spark.createDataFrame([("AESEQ", "KNOWN"), ("AESEQ", "OTHER"), ("AESEQ", "OTHER"), (None, "RACE"), ("", "X")], "IDVAR string, QNAM string")
    got = {(r["subject_key"], r["message"]) for r in q.undeclared_qualifiers(supp, {"AESEQ": ["KNOWN"], None: ["RACE"]}).collect()}
    assert got == {("AESEQ.OTHER", "2 records of an undeclared qualifier"), ("X", "1 records of an undeclared qualifier")}


def test_neutralising_antibodies_and_titres(spark):
    day = lambda n: f"2020-01-{n:02d}"
    rows = [(1, "A", day(1), "NEGATIVE", None, None), (1, "A", day(9), "POSITIVE", 8.0, "POSITIVE"), (2, "A", day(1), "POSITIVE", 4.0, "POSITIVE"), (2, "A", day(9), "NEGATIVE", None, None),
            (3, "B", day(9), "POSITIVE", 2.0, "NEGATIVE"), (4, "B", day(9), "NEGATIVE", None, "POSITIVE")]
    df = spark.createDataFrame(rows, "USUBJID int, ARM string, d string, RESULT string, TITRE double, NABRES string").withColumns({"ADT": F.to_date("d"), "TRTSDT": F.lit("2020-01-02").cast("date")})
    status = ard.ada_status(df, ("USUBJID", "ARM"))
    nab = {r["ARM"]: (r["ada_positive"], r["tested"], r["nab_positive"]) for r in ard.nab_incidence(status, df).collect()}
    assert nab == {"A": (2, 1, 1), "B": (1, 1, 0)}
    assert {(r["ARM"], r["status"]): r["hits"] for r in ard.ada_summary(status).collect()}[("A", "baseline_positive")] == 1
    assert {r["ARM"]: (r["N"], round(r["gmean"], 6)) for r in ard.ada_titres(status).collect()} == {"A": (1, 8.0), "B": (1, 2.0)}
