import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from cohortsmith.operators import derive as d, groups as g, merge as m, quality as q, windows as w
from cohortsmith.operators.windows import Visit

VISITS = [Visit("Baseline", 0, 1), Visit("Week 8", 8, 56), Visit("Week 16", 16, 112), Visit("Week 24", 24, 168)]
DAY0 = dt.date(2020, 1, 1)


def obs(spark, rows):
    """rows: subject, parameter, day, value, seq."""
    data = [(s, p, day, v, seq, DAY0 + dt.timedelta(days=(day or 1) - 1), DAY0) for s, p, day, v, seq in rows]
    return spark.createDataFrame(data, "USUBJID string, PARAMCD string, ADY int, AVAL double, ASEQ int, ADT date, TRTSDT date")


def test_windows_cover_every_day(spark):
    days = spark.range(-200, 400).select(F.lit("S").alias("USUBJID"), F.lit("P").alias("PARAMCD"), F.col("id").cast("int").alias("ADY"), F.lit(1.0).alias("AVAL"))
    out = {r["ADY"]: r["AVISITN"] for r in w.window_visits(days, VISITS).collect()}
    assert len(out) == 600
    assert (out[-200], out[1], out[2], out[84], out[85], out[140], out[141], out[399]) == (0, 0, 8, 8, 16, 16, 24, 24)
    mid = {r["ADY"]: r["AVISITN"] for r in w.window_visits(days, VISITS, baseline_upper=None).collect()}
    assert mid[28] == 0 and mid[29] == 8


def test_record_choice_ties(spark):
    df = w.window_visits(obs(spark, [("S", "P", 50, 1.0, 1), ("S", "P", 62, 2.0, 2), ("S", "P", 62, 3.0, 3), ("S", "P", None, 9.0, 4), ("S", "P", 60, None, 5)]), VISITS)
    assert df.count() == 3  # no day or no value: dropped
    flagged = w.pick_analysis_record(df).filter("ANL01FL = 'Y'").collect()
    assert [r["ASEQ"] for r in flagged] == [2]  # same distance: later day, then lower sequence
    assert [r["ASEQ"] for r in w.analysis_records(df).collect()] == [2]


def test_locf_by_parameter_and_baseline(spark):
    rows = [("S", "A", 1, 10.0, 1), ("S", "A", 56, 12.0, 2), ("S", "B", 1, 5.0, 3), ("S", "B", 168, 6.0, 4), ("T", "A", 56, 7.0, 5), ("U", "A", 1, 7.0, 6)]
    df = w.analysis_records(w.window_visits(w.baseline(obs(spark, rows)), VISITS))
    out = w.locf_endpoint(df, VISITS[-1])
    added = {(r["USUBJID"], r["PARAMCD"]): r for r in out.filter("DTYPE = 'LOCF'").collect()}
    assert set(added) == {("S", "A")}  # B was observed, T has no baseline, U has nothing after it
    assert added["S", "A"]["AVISITN"] == 24 and added["S", "A"]["CHG"] == 2.0
    assert set((r["USUBJID"]) for r in w.locf_endpoint(df, VISITS[-1], require_baseline=False).filter("DTYPE = 'LOCF'").collect()) == {"S", "T"}
    # an observed record is never changed
    assert sorted(map(str, df.collect())) == sorted(str(r) for r in out.filter("DTYPE IS NULL").select(*df.columns).collect())
    assert q.gate_one_primary(out, 24).count() == 0


def test_locf_to_every_later_visit_replay(spark):
    """One observed record per subject, carried to each later visit with its value and day."""
    seen = [("A", "Q", 8), ("B", "Q", 8), ("C", "Q", 16), ("D", "Q", 24)]
    df = spark.createDataFrame([(s, p, v, float(i), i) for i, (s, p, v) in enumerate(seen)], "USUBJID string, PARAMCD string, AVISITN int, AVAL double, ADY int")
    out = w.locf_all_visits(df, w.visit_table(spark, VISITS[1:]), values=["AVAL", "ADY"])
    locf = {(r["USUBJID"], r["AVISITN"]): (r["AVAL"], r["ADY"]) for r in out.filter("DTYPE = 'LOCF'").collect()}
    assert locf == {("A", 16): (0.0, 0), ("A", 24): (0.0, 0), ("B", 16): (1.0, 1), ("B", 24): (1.0, 1), ("C", 24): (2.0, 2)}
    assert out.filter("DTYPE IS NULL").count() == 4


def test_pooling_counts_absent_arms(spark):
    rows = [(f"{s}{a}{i}", s, a, "Y") for s, sizes in {"1": (3, 3, 3), "2": (9, 9, 0), "3": (9, 9, 2)}.items() for a, n in zip((0, 54, 81), sizes) for i in range(n)]
    rows += [(f"f{i}", "3", 81, "N") for i in range(5)]
    df = d.pool_sites(spark.createDataFrame(rows, "USUBJID string, SITEID string, TRT01PN int, ITTFL string"), (0, 54, 81))
    assert {r["SITEID"]: r["SITEGR1"] for r in df.collect()} == {"1": "1", "2": "900", "3": "900"}


def test_merge_refuses_repeated_keys(spark):
    a = spark.createDataFrame([("S",), ("T",)], "USUBJID string")
    ok = spark.createDataFrame([("S", 1)], "USUBJID string, V int")
    assert {r["USUBJID"]: r["V"] for r in m.merge_vars(a, ok, ["USUBJID"], ["V"]).collect()} == {"S": 1, "T": None}
    with pytest.raises(Exception, match="repeated key"):
        m.merge_vars(a, ok.unionByName(ok), ["USUBJID"], ["V"]).collect()


def test_supp_with_repeats_and_several_idvars(spark):
    ae = spark.createDataFrame([("S", 1, 10), ("S", 2, 20)], "USUBJID string, AESEQ int, AEGRP int")
    supp = spark.createDataFrame([("S", "AESEQ", "1", "X", "a"), ("S", "AESEQ", "1", "X", "b"), ("S", "AEGRP", "20", "G", "g"), ("S", None, None, "R", "r")],
                                 "USUBJID string, IDVAR string, IDVARVAL string, QNAM string, QVAL string")
    out = {r["AESEQ"]: (r["X"], r["G"], r["R"]) for r in m.combine_supp(ae, supp, {"AESEQ": ["X"], "AEGRP": ["G"], None: ["R"]}).collect()}
    assert out == {1: ("b", None, "r"), 2: (None, "g", "r")}


def test_treatment_emergent_missing_start(spark):
    one = dt.timedelta(days=1)
    rows = [(1, None, DAY0 + one), (2, None, DAY0 - one), (3, DAY0, None), (4, DAY0 - one, None), (5, DAY0 + 40 * one, None)]
    df = spark.createDataFrame([(i, a, b, DAY0, DAY0 + 5 * one) for i, a, b in rows], "i int, ASTDT date, AENDT date, TRTSDT date, TRTEDT date")
    got = lambda x: {r["i"] for r in x.collect() if r["TRTEMFL"] == "Y"}
    assert got(d.flag_teae(df)) == {1, 3, 5}
    assert got(d.flag_teae(df, missing_start="always")) == {1, 2, 3, 5}
    assert got(d.flag_teae(df, cutoff_days=30)) == {1, 3}


def test_time_to_event_rules(spark):
    day = lambda n: DAY0 + dt.timedelta(days=n)
    adsl = spark.createDataFrame([("A", DAY0, day(30), "x"), ("B", DAY0, day(20), "x"), ("C", None, day(9), "x"), ("D", DAY0, None, "x")],
                                 "USUBJID string, TRTSDT date, TRTEDT date, ARM string")
    ev = spark.createDataFrame([("A", day(5)), ("A", day(3)), ("A", day(-2)), ("B", day(-1))], "USUBJID string, D date")
    out = d.derive_tte(adsl, "TRTSDT", [d.Source(ev, "D", "event")], [d.Source(adsl, "TRTEDT", "end", None, "last dose")], {"PARAMCD": "T"})
    got = {r["USUBJID"]: (r["AVAL"], r["CNSR"], r["EVNTDESC"], r["CNSDTDSC"]) for r in out.collect()}
    assert got == {"A": (4, 0, "event", None), "B": (21, 1, "end", "last dose")}


def test_confirmed_response(spark):
    day = lambda n: DAY0 + dt.timedelta(days=n)
    rows = [("A", "CR", 0), ("A", "CR", 28), ("B", "PR", 0), ("B", "CR", 30), ("C", "CR", 0), ("C", "PR", 40), ("D", "PR", 0), ("D", "PR", 10), ("E", "PD", 3), ("F", "NE", 1)]
    df = spark.createDataFrame([(s, c, day(n)) for s, c, n in rows], "USUBJID string, AVALC string, ADT date")
    assert {r["USUBJID"]: r["AVALC"] for r in d.best_response(df).collect()} == {"A": "CR", "B": "CR", "C": "CR", "D": "PR", "E": "PD", "F": "NE"}
    assert {r["USUBJID"]: r["AVALC"] for r in d.best_response(df, 28).collect()} == {"A": "CR", "B": "PR", "C": "SD", "D": "SD", "E": "PD", "F": "NE"}


def test_worst_carried_forward(spark):
    df = spark.createDataFrame([("A", "Q", 8, 5.0), ("A", "Q", 16, 3.0)], "USUBJID string, PARAMCD string, AVISITN int, AVAL double")
    out = {r["AVISITN"]: (r["AVAL"], r["DTYPE"]) for r in w.wocf(df, w.visit_table(spark, VISITS[1:])).collect()}
    assert out == {8: (5.0, None), 16: (3.0, None), 24: (5.0, "WOCF")}


def test_bucketed_as_of_equals_brute_force(spark):
    rng = random.Random(1)
    left = [(i, rng.choice("ab"), rng.randrange(60)) for i in range(80)]
    add = [(i, rng.choice("ab"), rng.randrange(60), float(i)) for i in range(60)]
    day = lambda n: DAY0 + dt.timedelta(days=n)
    out = m.merge_as_of_by_bucket(
        spark.createDataFrame([(i, k, day(n)) for i, k, n in left], "i int, k string, DT date"),
        spark.createDataFrame([(i, k, day(n), v) for i, k, n, v in add], "s int, k string, ADT date, v double"), ["k"], "DT", "ADT", 7, ["s"], {"V": "v"}, ["i"])
    got = {r["i"]: r["V"] for r in out.collect()}
    for i, k, n in left:
        fit = [(n2, s, v) for s, k2, n2, v in add if k2 == k and n2 <= n <= n2 + 7]
        assert got[i] == (max(fit)[2] if fit else None)


@pytest.mark.parametrize("bounds, closed, mode", [(("lo", "hi"), (True, True), "first"), (("lo", "hi"), (False, False), "last"), ((None, "hi"), (True, False), "last"),
                                                  (("lo", None), (False, True), "first"), ((None, None), (True, True), "last")])
def test_range_merge_equals_brute_force(spark, bounds, closed, mode):
    rng = random.Random(7)
    pick = lambda: rng.choice([None, *[x / 4 for x in range(-4, 44)]])
    left = [(i, rng.choice(["a", "b", "c", None]), pick(), pick()) for i in range(150)]
    add = [(i, rng.choice(["a", "b", None]), pick(), rng.randrange(9)) for i in range(120)]
    out = m.merge_in_range(spark.createDataFrame(left, "i int, k string, lo double, hi double"), spark.createDataFrame(add, "s int, k string, x double, o int"),
                           ["k"], "x", *bounds, ["o", "s"], mode, {"S": "s", "O": "o", "K": "k"}, ["i"], closed)
    got = {r["i"]: (r["S"], r["O"], r["K"]) for r in out.collect()}
    assert len(got) == 150
    for i, k, lo, hi in left:
        above = lambda x: bounds[0] is None or (lo is not None and (x > lo or (closed[0] and x == lo)))
        below = lambda x: bounds[1] is None or (hi is not None and (x < hi or (closed[1] and x == hi)))
        fit = sorted((o, s) for s, k2, x, o in add if k2 == k and x is not None and above(x) and below(x))
        best = (fit[0] if mode == "first" else fit[-1]) if fit else None
        assert got[i] == ((best[1], best[0], k) if best else (None, None, None))


def test_range_merge_of_a_hot_key(spark):
    """One key with 100,000 rows on both sides and wide ranges: a row meets at most two blocks of each size, not all records."""
    import numpy as np

    n = 100_000
    add = spark.range(n).select(F.lit("hot").alias("k"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 8).alias("x"), F.pmod(F.col("id") * 104_729, F.lit(n)).alias("v"))
    left = spark.range(n).select("id", F.lit("hot").alias("k"), (F.pmod(F.col("id") * 31, F.lit(n)) / 8 - 5000).alias("lo"), (F.pmod(F.col("id") * 31, F.lit(n)) / 8).alias("hi"))
    got = m.merge_in_range(left, add, ["k"], "x", "lo", "hi", ["v"], "last", {"V": "v"}, ["id"]).toPandas().set_index("id").V
    i = np.arange(n)
    by_place = np.empty(n, np.int64)
    by_place[i * 7919 % n] = i * 104_729 % n
    table = [by_place]
    while 2 ** len(table) <= n:  # highest of runs of 1, 2, 4, ... values
        half = 2 ** (len(table) - 1)
        table.append(np.maximum(table[-1][:-half], table[-1][half:]))
    hi = i * 31 % n
    lo = np.maximum(hi - 40_000, 0)
    level = np.floor(np.log2(hi - lo + 1)).astype(int)
    want = [max(table[k][a], table[k][b - 2**k + 1]) for k, a, b in zip(level, lo, hi)]
    assert got.loc[i].astype(int).tolist() == want
    sizes = left.select(F.size(m._tree_nodes(F.greatest(F.col("lo") * 8, F.lit(0)).cast("long"), (F.col("hi") * 8 + 1).cast("long"))).alias("n")).agg(F.max("n"), F.avg("n")).first()
    assert sizes[0] <= 32 and sizes[1] < 20


def test_exact_quantiles_any_group(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = [("hot", float(x)) for x in rng.normal(size=5000).round(2)] + [("one", 4.0)] + [("two", x) for x in (1.0, 2.0)]
    df = spark.createDataFrame(data, "k string, v double")
    out = {r["k"]: r for r in g.exact_quantiles(df, ["k"], "v", {"p25": 0.25, "median": 0.5, "p90": 0.9}).collect()}
    for k in ("hot", "one", "two"):
        vals = [v for kk, v in data if kk == k]
        for name, p in (("p25", 25), ("median", 50), ("p90", 90)):
            assert out[k][name] == pytest.approx(np.percentile(vals, p))


def test_null_keys_and_flags(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (None, 2, 6.0), ("a", 3, 7.0)], "k string, s int, v double")
    out = {r["s"]: r["F"] for r in w.flag_extreme(df, ["k"], ["s"], "F", "first", "v > 5").collect()}
    assert out == {1: None, 2: "Y", 3: "Y"}


def test_hot_key_join_is_split(spark):
    """A key with most rows is split by the runtime even though the other side comes from an aggregate."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5000).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = g.attach_aggregates(df, ["k"], n=F.count(F.lit(1)))
        rows = out.groupBy((F.col("k") == 0).alias("hot")).agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).collect()
        assert {r["hot"]: r["c"] for r in rows} == {True: 100_000, False: 100_000}
        assert max(r["n"] for r in rows) == 100_000
        out.write.format("noop").mode("overwrite").save()
        parts = out.select(F.spark_partition_id().alias("p"), "k").filter("k = 0").groupBy("p").count().count()
        assert parts > 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_spread_row_numbers(spark):
    from cohortsmith.operators.portfolio import row_numbers

    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("o"), "id")
    key = lambda x: {r["id"]: r["n"] for r in x.collect()}
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert key(row_numbers(df, ["g"], [F.col("o")], "n")) == key(plain)


def test_gates(spark):
    adsl = spark.createDataFrame([("A", "P", "Y"), ("B", "P", "Y"), ("C", "H", "Y")], "USUBJID string, ARM string, EFFFL string")
    adam = spark.createDataFrame([("A", "P"), ("A", "P"), ("C", "H")], "USUBJID string, ARM string")
    got = {r["ARM"]: (r["shortfall"], r["status"]) for r in q.gate_n(adam, adsl, "EFFFL", "true").collect()}
    assert got == {"P": (1, "FAILED"), "H": (0, "OK")}
    assert q.assert_unique(adam, ["USUBJID"], ["ARM"]).first()["repeated_keys"] == 1
