import json

import pytest

from cohortsmith.operators import quality as q
from cohortsmith.sources import readers as rd, writers as wr

DOC = {"columns": [{"name": "usubjid", "dataType": "string", "label": "Subject"}, {"name": "age", "dataType": "integer", "label": "Age"}],
       "rows": [["S1", 40], ["S2", None], ["", 50]]}


def test_first_format_wins_and_text_is_tidied(spark, tmp_path):
    (tmp_path / "dm.csv").write_text('usubjid,age\n"A",\n"","7"\n')
    df = rd.read_domain(spark, str(tmp_path), "DM")
    assert df.columns == ["USUBJID", "AGE"] and {tuple(r) for r in df.collect()} == {("A", None), (None, "7")}
    (tmp_path / "dm.json").write_text(json.dumps(DOC))
    df = rd.read_domain(spark, str(tmp_path), "dm")
    assert dict(df.dtypes) == {"USUBJID": "string", "AGE": "bigint"} and df.filter("USUBJID IS NULL").first()["AGE"] == 50
    with pytest.raises(FileNotFoundError):
        rd.read_domain(spark, str(tmp_path), "ae")


def test_round_trips(spark, tmp_path):
    df = q.with_labels(spark.createDataFrame([('a "q", b', 1, 2.5, None), (None, 2, None, True)], "T string, I bigint, D double, B boolean"), {"T": "Text"})
    for fmt in ("parquet", "csv", "json", "ndjson"):
        wr.write_adam(df, str(tmp_path / f"x.{fmt}"), fmt)
    back = rd.read_dataset_ndjson(spark, str(tmp_path / "x.ndjson"))
    assert dict(back.dtypes) == dict(df.dtypes) and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert back.schema["T"].metadata["label"] == "Text"
    wr.write_adam(df, str(tmp_path / "x.dsjson"), "dataset-json")
    again = rd.read_dataset_json(spark, str(tmp_path / "x.dsjson"))
    assert again.schema == back.schema and sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    wr.write_ard(df, str(tmp_path / "ard"))
    assert spark.read.json(str(tmp_path / "ard" / "json")).count() == 2


def test_one_document_in_many_ranges(spark, tmp_path):
    """Rows with brackets, quotes and backslashes inside texts, read by several tasks; ranges end anywhere, within texts too."""
    odd = ["plain", "a ] b", '"quoted" ], [', "back\\\\slash\\\\", "\\\\]", "]]]] [[", "{ brace } : [", "é 日本 \n new ] line", "", None, '],["x",1', "tail\\\""]
    rows = [[f"S{i}", odd[i % len(odd)] if i % 5 else "] " * 300, i if i % 7 else None, i / 4] for i in range(3000)]
    doc = {"datasetJSONVersion": "1.1.0", "note": "a [ b ] \"c", "columns": [{"name": n, "dataType": t, "label": f"Label [{n}]"} for n, t in
           (("usubjid", "string"), ("txt", "string"), ("num", "integer"), ("val", "double"))], "records": 3000, "rows": rows, "after": {"rows": "x"}}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        for k, text in enumerate((json.dumps(doc), json.dumps(doc, indent=1, ensure_ascii=False), json.dumps({"rows": rows, "columns": doc["columns"]}))):
            (tmp_path / f"d{k}.json").write_text(text)
            df = rd.read_dataset_json(spark, str(tmp_path / f"d{k}.json"))
            assert sorted(map(str, df.collect())) == sorted(map(str, spark.createDataFrame([tuple(r) for r in rows], df.schema).collect()))
            assert df.schema["txt"].metadata["label"] == "Label [txt]"
        assert spark.read.text(str(tmp_path / "d0.json"), lineSep="]").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "none.json").write_text(json.dumps(doc | {"rows": []}))
    assert rd.read_dataset_json(spark, str(tmp_path / "none.json")).count() == 0


def test_a_failing_task_leaves_no_part_files(spark, tmp_path):
    from pyspark.sql import functions as F

    bad = spark.range(1000).repartition(4).select(F.when(F.col("id") == 777, F.raise_error("no")).otherwise(F.col("id").cast("string")).alias("x"))
    for fmt in ("parquet", "ndjson", "dataset-json"):
        with pytest.raises(Exception):
            wr.write_adam(bad, str(tmp_path / fmt), fmt)
        assert not list((tmp_path / fmt).rglob("part-*"))


def test_numeric_only_when_all_parse(spark):
    df = spark.createDataFrame([("1", "1", None), ("2.5", "x", None)], "a string, b string, c string")
    assert dict(rd.coerce_numeric(df).dtypes) == {"a": "double", "b": "string", "c": "double"}


def test_study_document(spark):
    doc = {"usdmVersion": "4.0.0", "study": {"name": "N", "versions": [{"titles": [{"text": "Full", "type": {"decode": "Official Study Title"}}], "studyDesigns": [{
        "studyPhase": {"standardCode": {"decode": "Phase II Trial"}},
        "objectives": [{"id": "O1", "level": {"code": "C85826"}, "endpoints": [{"id": "E1", "text": "CIBIC+ at Week 8", "level": {"code": "x", "decode": "Primary Endpoint"}}]}],
        "estimands": [{"id": "M1", "variableOfInterestId": "E1", "intercurrentEvents": [{"name": "i", "strategy": "Treatment Policy - go on"}]}],
        "arms": [{"id": "A1", "name": "Low 54 mg", "type": {"decode": "Active"}}], "encounters": [{"id": "V1", "name": "E4", "label": "Week 2"}]}]}]}}
    flat = rd.flatten_usdm(spark.createDataFrame([("S", json.dumps(doc))], "study_id string, doc string"))
    assert flat["study"].first()["title"] == "Full" and flat["study"].first()["phase"] == "Phase II Trial"
    e = flat["endpoints"].first()
    assert (e["endpoint_id"], e["level"], e["MEASURE"], e["TIMEPOINTS"]) == ("E1", "Primary", "CIBIC+", ["Week 8"])
    assert flat["estimands"].first()["strategy"] == "Treatment Policy" and flat["arms"].first()["dose"] == 54.0 and flat["visits"].first()["name"] == "Week 2"


def test_contents_to_a_depth(spark):
    tree = {"mainListOfContents": {"contentsList": {"listItems": [{"name": "a", "analysisId": "AN1", "sublist": {"listItems": [
        {"name": "b", "outputId": "OUT1", "sublist": {"listItems": [{"name": "c", "outputId": "OUT2"}]}}]}}]}},
        "otherListsOfContents": [{"name": "extra", "contentsList": {"listItems": [{"name": "d", "outputId": "OUT3"}]}}]}
    docs = spark.createDataFrame([("S", json.dumps(tree))], "study_id string, doc string")
    got = {(r["list"], r["name"], r["depth"]): r["path"] for r in rd.flatten_contents(docs).collect()}
    assert got[("main", "b", 2)] == "listItems/0/sublist/listItems/0" and ("extra", "d", 1) in got and len(got) == 4
    assert rd.flatten_contents(docs).filter("name = 'c'").first()["output_id"] == "OUT2"
    deep = {"name": "leaf", "outputId": "OUT9"}
    for k in range(6):
        deep = {"name": f"level {k}", "sublist": {"listItems": [deep]}}
    docs = spark.createDataFrame([("S", json.dumps({"mainListOfContents": {"contentsList": {"listItems": [deep]}}}))], "study_id string, doc string")
    leaf = rd.flatten_contents(docs).filter("name = 'leaf'").first()
    assert leaf["depth"] == 7 and leaf["output_id"] == "OUT9"
