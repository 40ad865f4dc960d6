from pyspark.sql import functions as F

from cohortsmith.functions.scalars import parse_endpoint
from cohortsmith.operators import lineage as g, portfolio as p

TEXTS = [
    ("O1", "E1", "Primary", "Cognitive scale, total of 11 items at Week 24"), ("O1", "E2", "Primary", "Clinician's impression of change (CIBIC+) at Week 24"),
    ("O2", "E3", "Primary", "Adverse events"), ("O2", "E4", "Primary", "Vital signs (weight, blood pressure)"), ("O2", "E5", "Primary", "Laboratory evaluations (change)"),
    ("O3", "E6", "Secondary", "Cognitive scale, total of 11 items at Weeks 8 and 16"), ("O3", "E7", "Secondary", "Impression of change (CIBIC+) at Weeks 8 and 16"),
    ("O3", "E8", "Secondary", "Mean NPI-X total from Week 4 to Week 24"),
    ("O4", "E9", "Secondary", "*** To be determined ***"), ("O5", "E10", "Secondary", "*** To be determined ***"), ("O6", "E11", "Secondary", "*** To be determined ***"),
]


def model(spark):
    ends = parse_endpoint(spark.createDataFrame([("S", *t) for t in TEXTS], "study_id string, objective_id string, endpoint_id string, level string, text string"), "text").cache()
    objs = spark.createDataFrame([("S", f"O{i}", f"Objective {i}") for i in range(1, 7)], "study_id string, objective_id string, text string")
    arms = spark.createDataFrame([("S", "Placebo", "Placebo Control Arm", 0), ("S", "Low", "Active", 1), ("S", "High", "Active", 2)], "study_id string, name string, type string, position int")
    studies = spark.createDataFrame([("S", "Phase II Trial", "A study")], "study_id string, phase string, title string")
    extra = spark.createDataFrame([("S", True, True)], "study_id string, needs_tte_safety_figure boolean, needs_subgroup_by_sex boolean")
    return ends, objs, arms, p.profile_studies(studies, ends, arms, extra).cache()


def test_expected_outputs_of_a_pilot_like_study(spark):
    ends, objs, arms, prof = model(spark)
    row = prof.first()
    assert (row["control_type"], row["design"], row["blinding"], row["therapeutic_area"], row["multi_site"]) == ("placebo", "parallel", "double-blind", "CNS", True)
    eff, saf, sca, spe = p.efficacy(ends), p.safety(ends, prof), p.scaffolding(prof), p.special(prof)
    assert (eff.count(), saf.count(), sca.count(), spe.count()) == (10, 12, 6, 0)
    full = p.expand_variants(eff.unionByName(saf).unionByName(sca), prof).cache()
    assert full.select("candidate_id").distinct().count() == full.count() == 13 + 12 + 6
    survivors, merges = p.dedup_candidates(full)
    survivors = survivors.cache()
    assert merges.count() == 0 and survivors.count() == 31
    inv = spark.createDataFrame([("S", x) for x in "AE CM DM DS EX LB QS VS".split()], "study_id string, domain string")
    extra = p.candidates(spark.createDataFrame([("S", "dev", "other", ["DV"], "rule"), ("S", "dad", "efficacy", ["QS"], None)],
                                               "study_id string, candidate_id string, category string, req_sdtm array<string>, regulatory_rule string").withColumn(
        "endpoint_ids", F.when(F.col("candidate_id") == "dad", F.array(F.lit("E9")))))
    ready = p.feasibility(survivors.drop("n_merged").unionByName(extra), ends.filter("NOT RESOLVED"), inv).cache()
    assert {r["candidate_id"]: r["status"] for r in ready.filter("status <> 'planned'").collect()} == {"dev": "blocked", "dad": "needs-clarification"}
    numbered = p.number_outputs(ready).cache()
    ids = {r["final_id"] for r in numbered.filter("status = 'planned'").collect()}
    assert len(ids) == 31 and "F-14-1" in ids and "T-14-3.13" in ids and "T-14-6.06" in ids and "T-14-7.04" in ids
    assert numbered.filter("status <> 'planned' AND final_id IS NOT NULL").count() == 0
    planned = numbered.filter("status = 'planned'").cache()
    cov = p.coverage(ends, planned).cache()
    assert {r["coverage"]: r["count"] for r in cov.groupBy("coverage").count().collect()} == {"covered": 8, "clarification": 3}
    objective = {r["objective_id"]: r["coverage"] for r in p.objective_coverage(objs, cov, planned).collect()}
    assert objective == {"O1": "covered", "O2": "covered", "O3": "covered", "O4": "clarification", "O5": "clarification", "O6": "clarification"}
    v = p.verdict(cov, p.orphans(planned, objs, ends)).first()
    assert (v["verdict"], v["gaps"], v["orphans"], v["clarifications"]) == ("clean-with-caveats", 0, 0, 3)
    fired = {r["check_id"] for r in p.completeness(objs, ends, planned, prof).collect()}
    assert fired == {"C1", "C2"}
    spec = {r["candidate_id"]: r for r in p.assemble_specs(numbered).collect()}
    assert spec["eff-e1-ancova-locf"]["record_condition"] == "ANL01FL = 'Y' AND AVISIT = 'Week 24'" and spec["eff-e1-ancova-locf"]["set_condition"] == "EFFFL = 'Y'"


def test_duplicates_merge_into_the_fuller_one(spark):
    rows = [("S", "a", "exposure", "Summary of Exposure", ["ADEX"], [], None, "scaffolding"), ("S", "b", "exposure", "Summary of Exposure (Safety)", ["ADEX"], ["E1"], None, "safety"),
            ("S", "c", "exposure", "Summary of exposure.", [], ["E2"], "rule", "safety")]
    df = p.candidates(spark.createDataFrame(rows, "study_id string, candidate_id string, category string, title string, req_adam array<string>, endpoint_ids array<string>, regulatory_rule string, produced_by string"))
    survivors, merges = p.dedup_candidates(df)
    one = survivors.first()
    assert one["candidate_id"] == "b" and one["endpoint_ids"] == ["E1", "E2"] and one["regulatory_rule"] == "rule" and one["n_merged"] == 3
    assert {r["merged_id"] for r in merges.collect()} == {"a", "c"}


def test_graph(spark):
    objs = spark.createDataFrame([("S", "O1", "x"), ("S", "O2", "y")], "study_id string, objective_id string, text string")
    ends = spark.createDataFrame([("S", "O1", "E1", "t", True), ("S", "O2", "E2", "u", False)], "study_id string, objective_id string, endpoint_id string, text string, RESOLVED boolean")
    tlfs = p.candidates(spark.createDataFrame([("S", "c1", ["E1"], ["O1"], ["ADX"], ["AA", "BB"], None, "planned"), ("S", "c2", [], ["O2"], ["ADX"], ["ZZ"], "r", "blocked")],
        "study_id string, candidate_id string, endpoint_ids array<string>, objective_ids array<string>, req_adam array<string>, req_sdtm array<string>, regulatory_rule string, status string")).withColumn(
        "final_id", F.when(F.col("candidate_id") == "c1", "T-14-3.01"))
    adam = spark.createDataFrame([("S", "ADX", ["AA"]), ("S", "ADY", ["BB"])], "study_id string, dataset string, sdtm_source array<string>")
    uses = spark.createDataFrame([("S", "ADY", "14-3.01")], "study_id string, dataset string, table_id string")
    edges = {(r["source"], r["target"], r["dashed"]) for r in g.build_edges(objs, ends, tlfs, adam, uses).collect()}
    assert edges == {("obj:O1", "end:E1", False), ("obj:O2", "end:E2", False), ("end:E1", "tlf:c1", False), ("obj:O2", "tlf:c2", False), ("reg:ICH-E3", "tlf:c2", False),
                     ("tlf:c1", "adam:ADY", False), ("tlf:c2", "adam:ADX", False), ("adam:ADX", "sdtm:AA", False), ("adam:ADY", "sdtm:BB", False),
                     ("tlf:c1", "sdtm:AA", True), ("tlf:c2", "sdtm:ZZ", True)}
    nodes = g.build_nodes(objs, ends, tlfs, adam, uses).cache()
    assert {r["id"]: r["absent"] for r in nodes.filter("type = 'SDTM'").collect()} == {"sdtm:AA": False, "sdtm:BB": False, "sdtm:ZZ": True}
    root = spark.createDataFrame([("S", "adam:ADY")], "study_id string, id string")
    around = {(r["id"], r["direction"]) for r in g.lineage(g.build_edges(objs, ends, tlfs, adam, uses), root).collect()}
    assert around == {("adam:ADY", "self"), ("sdtm:BB", "descendant"), ("tlf:c1", "ancestor"), ("end:E1", "ancestor"), ("obj:O1", "ancestor")}
    issues = {(r["severity"], r["node_id"]) for r in g.build_issues(objs, ends, tlfs, nodes).collect()}
    assert issues == {("blocked", "tlf:c2"), ("clarification", "end:E2"), ("blocked", "sdtm:ZZ")}
    related = {(r["node_id"], r["related"]) for r in g.issue_relations(tlfs, nodes).collect()}
    assert related == {("sdtm:ZZ", "tlf:c2"), ("tlf:c2", "sdtm:ZZ")}


def test_lineage_of_a_long_chain_and_a_cycle(spark):
    """A chain of 200 edges takes a logarithm of rounds; a cycle reaches all of its nodes, the root too, and ends."""
    chain = [("S", f"n{i}", f"n{i + 1}") for i in range(200)] + [("T", f"c{i}", f"c{(i + 1) % 7}") for i in range(7)]
    edges = spark.createDataFrame(chain, "study_id string, source string, target string")
    roots = spark.createDataFrame([("S", "n0"), ("S", "n150"), ("T", "c3"), ("S", "alone")], "study_id string, id string")
    got = {}
    for r in g.lineage(edges, roots).collect():
        got.setdefault((r["root"], r["direction"]), set()).add(r["id"])
    assert got["n0", "descendant"] == {f"n{i}" for i in range(1, 201)} and ("n0", "ancestor") not in got
    assert got["n150", "ancestor"] == {f"n{i}" for i in range(150)} and len(got["n150", "descendant"]) == 50
    assert got["c3", "descendant"] == got["c3", "ancestor"] == {f"c{i}" for i in range(7)} and got["alone", "self"] == {"alone"}


def test_lineage_walks_codes_that_are_proved_different(spark, monkeypatch):
    """The walk moves numbers, not texts; codes that two nodes share are found and replaced; a null id is one node, met once."""
    edges = spark.createDataFrame([(None, "obj:a", "tlf:b"), (None, "tlf:b", "adam:c"), (None, "adam:c", "sdtm:d"), (None, "obj:a", "sdtm:d"),
                                   ("S", "obj:a", "tlf:b"), ("S", "tlf:b", None), ("S", None, "sdtm:d"), ("S", None, "sdtm:d"), ("S", "sdtm:d", "x:e"), ("S", "x:e", "tlf:b")],
                                  "study_id string, source string, target string")
    roots = spark.createDataFrame([(None, "obj:a"), ("S", "obj:a"), ("S", "x:e"), ("S", "x:e"), ("T", "obj:a")], "study_id string, id string")
    down = {(None, "obj:a"): ["tlf:b", "adam:c", "sdtm:d"], ("S", "obj:a"): ["tlf:b", None, "sdtm:d", "x:e"], ("S", "x:e"): ["tlf:b", None, "sdtm:d", "x:e"], ("T", "obj:a"): []}
    up = {("S", "x:e"): ["obj:a", "tlf:b", None, "sdtm:d", "x:e"]}
    want = sorted([(*k, k[1], "self") for k in down] + [(*k, n, "descendant") for k, v in down.items() for n in v] + [(*k, n, "ancestor") for k, v in up.items() for n in v], key=str)
    code, keep, kept, seeds = g._code, g.checkpointed, [], []
    monkeypatch.setattr(g, "checkpointed", lambda df: kept.append(df.dtypes) or keep(df))
    monkeypatch.setattr(g, "_code", lambda node, seed: seeds.append(seed) or (code(node, seed) if seed else F.lit(16).cast("long")))
    got = sorted([tuple(r) for r in g.lineage(edges, roots).select("study_id", "root", "id", "direction").collect()], key=str)
    assert got == want and set(seeds) == {0, 1}
    texts = [names for names in kept if any(kind == "string" for _, kind in names)]
    assert len(texts) == 3 and len(kept) > len(texts)  # the edges and, per seed, the nodes; never what a hop finds
