"""Small cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortsmith.llm import cascade, mixing, nearby, passages, pieces, preference, ring, suffixes, topk, toxicity
from cohortsmith.llm.common import Rolling, minimizers, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return [f"w{int(x)}" for x in draw.integers(0, 10**6, n)]


@pytest.fixture(scope="module")
def odd(spark):
    """A table with every awkward row."""
    base = prose(1, 120)
    texts = [(1, " ".join(base)), (2, " ".join(base)), (2, " ".join(base)), (3, None), (4, ""), (5, " \n\t "), (None, " ".join(base)), (6, " ".join(prose(2, 30) + base[:60])),
             (7, " ".join(prose(3, 40_000))), (8, "a"), (9, "é \x00 🙂 ▁x"), (10, " ".join(base[:119] + ["other"]))]
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None if i in (1, 5) else f"s{(i or 0) % 3}", None) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(df):
    """Columns whose names the operators use themselves."""
    for name in ("n_words", "kept_text", "spans", "score", "size", "positions", "tokens", "kept", "rank"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def by_id(df):
    return df.toPandas().sort_values("doc_id").set_index("doc_id")


def test_minimizers_match_a_plain_search():
    h = np.random.default_rng(0).integers(0, 50, 400).astype(np.uint64) << np.uint64(40)
    place, first, last = minimizers(h, 7)
    want = [int(np.argmin(h[i:i + 7])) + i for i in range(len(h) - 6)]
    assert [int(p) for p, a, b in zip(place, first, last) for _ in range(a, b + 1)] == want


def test_word_hashes_split_like_words():
    r = Rolling()
    text = "  a b\x0bc d a "
    h = word_hashes(text.encode(), r)
    assert len(h) == len(text.encode().split()) and h[0] == h[-1] and len(set(h.tolist())) == 3


def test_passages_odd_rows(odd, nothing):
    got = passages.remove_repeats(odd, ["doc_id"], block_bytes=2000).toPandas()
    n = {None if pd.isna(i) else int(i): int(r) for i, r in zip(got.doc_id, got.n_removed)}
    assert len(got) == 12 and n[1] == 0 and n[2] == 120 and n[None] == 0 and n[3] == n[4] == n[5] == n[7] == n[8] == 0 and n[6] == 60 and n[10] == 119
    assert passages.remove_repeats(nothing, ["doc_id"]).count() == 0


def test_passages_cover_offsets(spark):
    """Windows around a shared stretch of any length near the limit, with other words between."""
    base = prose(5, 300)
    rows = [(0, " ".join(base))] + [(k, " ".join(prose(10 + k, 7) + base[k:k + 44 + k] + prose(50 + k, 5))) for k in range(1, 12)]
    got = by_id(passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], block_bytes=1500))
    assert [int(got.loc[k].n_removed) for k in range(1, 12)] == [44 + k if 44 + k >= 50 else 0 for k in range(1, 12)]
    assert got.loc[11].spans.tolist() == [7, 62]


def test_suffixes_odd_rows(odd, nothing):
    got = suffixes.remove_repeated_bytes(odd, ["doc_id"], block_bytes=2000).toPandas()
    n = {None if pd.isna(i) else int(i): (int(a), int(b)) for i, a, b in zip(got.doc_id, got.n_bytes, got.n_removed)}
    assert n[1][1] == 0 and n[2][0] == n[2][1] and n[None][1] == 0 and n[3] == (0, 0) and n[4] == (0, 0) and n[6][1] > 300
    assert suffixes.remove_repeated_bytes(nothing, ["doc_id"]).count() == 0


def test_suffixes_within_one_text(spark):
    df = spark.createDataFrame([(1, "ab" * 400), (2, "ab" * 60)], "doc_id long, text string")
    got = by_id(suffixes.remove_repeated_bytes(df, ["doc_id"]))
    assert got.loc[1].n_removed == 800 - 2 and got.loc[2].n_removed == 120


def test_topk_ties_and_unusable(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [float("inf"), 0.0]), (8, [1.0]), (None, [9.0, 9.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 4096), (0, 2, 2, 4096), (0, 3, 2, 4096), (20, 1, 0, 2048), (20, 2, 1, 2048), (20, 3, 2, 2048)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("k", [1, 5, 40])
def test_topk_block_against_sorting(k):
    draw = np.random.default_rng(k)
    x = np.floor(draw.normal(size=(700, 12)) * 20)
    got = topk.best_of_block(np.arange(30), x[:30], np.arange(700), x, k)
    want = []
    for q in range(30):
        s = x @ x[q]
        want += [(q, int(i), int(s[i])) for i in sorted((i for i in range(700) if i != q), key=lambda i: (-s[i], i))[:k]]
    assert list(zip(got["query_id"], got["vec_id"], got["score"])) == want


@pytest.mark.parametrize("copies", [3, 30, 600])
def test_topk_block_with_repeated_query_rows(copies):
    """Rows of a query's own id take no place from its candidates, however many there are."""
    draw = np.random.default_rng(copies)
    x = np.floor(draw.normal(size=(700, 12)) * 20)
    x[:10] *= 2  # a query's best row is itself
    ids = np.concatenate([np.arange(700), np.repeat(np.arange(10), copies)])
    rows = np.concatenate([x, np.repeat(x[:10], copies, 0)])
    got = topk.best_of_block(np.arange(10), x[:10], ids, rows, 20)
    want = []
    for q in range(10):
        s = rows @ x[q]
        want += [(q, int(ids[i]), int(s[i])) for i in sorted((i for i in range(len(rows)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:20]]
    assert list(zip(got["query_id"], got["vec_id"], got["score"])) == want


@pytest.mark.parametrize("block", [8192, 100])
def test_topk_with_a_repeated_query_id(spark, block):
    """25 equal rows of a query's id and 300 of another one, by brute force; no block holds more than k equal rows."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(200, 8)).astype(np.float32)
    rows = [(i, x[i].tolist()) for i in range(200)] + [(0, x[0].tolist())] * 25 + [(7, x[7].tolist())] * 300
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, block=block)
    ids, y = np.array([i for i, _ in rows]), np.floor(64 * np.array([v for _, v in rows], np.float64))
    want = []
    for q in range(0, 200, 20):
        s = y @ y[q]
        want += [(q, n, int(ids[i]), int(s[i])) for n, i in enumerate(sorted((i for i in range(len(y)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:20], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want


def test_topk_of_large_components(spark):
    """Components whose products leave a double, an integer of 64 bits, or both: exact ranks, and scores at the end of the range."""
    draw = np.random.default_rng(9)
    rows = [(i, [float(v) for v in draw.normal(size=4) * 10.0 ** draw.integers(-2, 17)]) for i in range(60)] + [(100, [1e15, 0.5, 0.0, 0.0]), (101, [1e15, 0.484375, 0.0, 0.0]), (102, [1e300, 1.0, 0.0, 0.0]), (103, [1e308, 0.0, 0.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5).collect()
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i != 103}
    want = []
    for q in [i for i in whole if i % 20 == 0]:
        best = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        want += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got if abs(r.score) < 2**63 - 1) == sorted(w[:3] for w in want if -(2**63) < w[3] < 2**63 - 1)
    assert sorted(r.score for r in got) == sorted(w[3] for w in want) and {r.query_id for r in got} == {w[0] for w in want}


def test_string_kernel_of_very_long_words():
    """A word of a million letters and many of 4,000: windows of bounded size that cover all of it, an insult inside included."""
    word = "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 1_000_000))
    got = toxicity.terms("x " + word + "idiot")
    assert max(map(len, got)) <= toxicity.LONG and got[0].startswith(toxicity.START + word[:50])
    at = 0
    for w in [t for t in got if not t.startswith(toxicity.START)][:500]:
        at = (toxicity.START + word).index(w, at)
    near = toxicity.Landmarks([toxicity.START + "idiot" + toxicity.END])
    near.sentences([word, "an idiot " + word[:4000], *[word[k * 4000 : k * 4000 + 4000] for k in range(100)]])
    assert near.known[toxicity.START + "idiot" + toxicity.END][0] == pytest.approx(1)


def test_string_kernel_tolerates_insertions():
    mark = lambda t: toxicity.START + t + toxicity.END
    near = toxicity.Landmarks([mark("scoundrel")])
    near.learn([mark(t) for t in ("scoundrel", "scxoundrel", "table", "scoundrels", "scounddrel")])
    value = {t: near.known[mark(t)] for t in ("scoundrel", "scxoundrel", "table", "scoundrels", "scounddrel")}
    assert value["scoundrel"][0] == pytest.approx(1) and value["table"] is None
    assert all(value[t] is not None and value[t][0] > 0.5 for t in ("scxoundrel", "scoundrels", "scounddrel"))
    assert mark("scoundrel") in toxicity.terms("You sc.oun-drel!") and mark("idiot") in toxicity.terms("an i d i o t here")


def test_string_kernel_counts_subsequences():
    def plain(s, t):
        total = 0.0
        from itertools import combinations
        for i in combinations(range(len(s)), toxicity.ORDER):
            for j in combinations(range(len(t)), toxicity.ORDER):
                if [s[a] for a in i] == [t[b] for b in j]:
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    pairs = [("abcab", "acb"), ("idiot", "i.d.iot"), ("aaaa", "aaa"), ("ab", "ab")]
    assert toxicity.kernel([a for a, _ in pairs], [b for _, b in pairs]) == pytest.approx([plain(a, b) for a, b in pairs])


def test_scores_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 1), (8, 0), (99, 0), (None, 1)], "doc_id long, label int")
    pair = odd.select("doc_id", "text")
    model = preference.train(pair, labels, F.lit(True))
    got = preference.score(clash(odd), ["doc_id", "n_words"], model)
    assert got.count() == 12 and got.where("score is null or score < 0 or score > 1").count() == 0
    assert preference.score(nothing, ["doc_id"], model).count() == 0
    assert not preference.train(nothing.select("doc_id", "text"), labels, F.lit(True)).fitted
    tox = toxicity.train(pair, labels, F.lit(True))
    assert toxicity.score(odd, ["doc_id"], tox).where("score between 0 and 1").count() == 12
    assert toxicity.score(nothing, ["doc_id"], tox).count() == 0


def test_preferences_of_all_pairs(spark):
    """Weights and cut are those of the loss over every pair of a good and a bad document."""
    draw = np.random.default_rng(11)
    rows = []
    for k in range(90):
        bad = k % 3 == 0
        words = [w + "#" * int(draw.random() < (0.3 if bad else 0.1)) for w in prose(7000 + k, int(draw.integers(20, 60 if bad else 120)))]
        rows.append((k, " ".join(w.upper() if draw.random() < 0.1 else w for w in words), int(bad == (k % 15 == 0))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = preference.train(docs.select("doc_id", "text"), docs.select("doc_id", "label"), F.lit(True))
    x, good = np.array([preference.features(t) for _, t, _ in rows]), np.array([y for *_, y in rows]) > 0
    low, high = np.quantile(x, 0.005, axis=0), np.quantile(x, 0.995, axis=0)
    z = np.clip(x, low, high)
    scale = z.std(0)
    z = (z - z.mean(0)) / np.where(scale > 1e-9, scale, 1.0)
    d = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        w = w + np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w)), d.T @ p / len(d) - 1e-3 * w)
    assert got.low == pytest.approx(low) and got.high == pytest.approx(high) and got.weights == pytest.approx(w, abs=5e-3)
    merit = np.sort(z @ got.weights)
    assert got.cut == pytest.approx((merit[(~good).sum() - 1] + merit[(~good).sum()]) / 2)
    assert preference.train(docs.orderBy(F.rand(5)).select("doc_id", "text"), docs.select("doc_id", "label"), F.lit(True)).weights == pytest.approx(got.weights)


def test_preferences_use_every_labelled_document(spark):
    docs = spark.range(20_500).selectExpr("id doc_id", "concat('a b ', id) text")
    found = preference.labelled_features(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) label"), F.lit(True))
    assert found.count() == 20_500 and found.where("good").count() == 10_250


def test_preferences_move_no_text(spark, monkeypatch):
    """Labels too many to be sent to every task meet features, not texts, so what is shuffled does not grow by whole texts."""
    seen = []
    monkeypatch.setattr(preference, "checkpointed", lambda df: seen.append(df) or df)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(k, " ".join(prose(k, 40))) for k in range(30)] + [(3, None), (None, "a b")], "doc_id long, text string")
        labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(4, 1), (50, 1), (None, 0), (21, None)], "doc_id long, label int")
        rows = preference.labelled_features(docs, labels, F.lit(True))
        tree = rows._jdf.queryExecution().optimizedPlan().toString()
        assert tree.index("Join") < tree.index("MapInArrow")  # texts end below the join
        want = [(preference.features(r.text), r.doc_id % 2 == 1) for r in docs.collect() if r.doc_id is not None and r.doc_id < 20]
        assert len(seen) == 1 and sorted((r.x, r.good) for r in rows.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scores_from_features_are_those_from_texts(spark, odd):
    model = preference.train(odd.select("doc_id", "text"), spark.createDataFrame([(1, 1), (2, 0), (8, 1)], "doc_id long, label int"), F.lit(True))
    one = preference.score(odd, ["doc_id"], model)
    two = preference.score_features(preference.text_features(odd, ["doc_id"]), ["doc_id"], model)
    assert model.fitted and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_near_duplicates_move_texts_of_members_only(spark, monkeypatch):
    """Texts of documents that are in no node are left out before the join to the members, and none of a member is."""
    texts = spark.range(-4000, 40_000).selectExpr("id * 7 doc_id", "concat('w ', id) _text")
    ids = [7 * k for k in [*range(-3000, 9000, 3), -4000, 39_999]]
    members = spark.createDataFrame([(d,) for d in [*ids, *ids, 1]], "doc_id long")
    for most in (nearby.MOST, 1):  # one row of marks is shared by all ids
        monkeypatch.setattr(nearby, "MOST", most)
        got = nearby.wanted(texts, members)
        kept = {r.doc_id for r in got.collect()}
        assert set(ids) <= kept and len(kept) < (9000 if most > 1 else 15_000) and got.columns == texts.columns
    assert nearby.wanted(texts, members.limit(0)).count() == 0
    seen, plain = [], nearby.wanted
    monkeypatch.setattr(nearby, "wanted", lambda *a: seen.append(plain(*a)) or seen[-1])
    docs = spark.createDataFrame([(k, " ".join(prose(k % 500 if k < 40 else k, 20))) for k in range(600)] + [(700 + k, " ".join(prose(k, 20) + ["end"])) for k in range(30)], "doc_id long, text string")
    nearby.near_duplicates(docs, shingle=3, percent=85).collect()
    assert seen and all(30 <= x.count() < 150 for x in seen)


def test_near_duplicates_odd_rows(odd, nothing):
    got = nearby.near_duplicates(clash(odd), shingle=3, percent=85)
    seen = {(r.doc_id, r.component_id, r.kept) for r in got.collect()}
    assert got.count() == 12 and {(1, 1, True), (2, 1, False), (10, 1, False), (3, 3, True), (4, 4, True), (None, None, True)} <= seen
    assert nearby.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("node", [3, 800])
def test_near_duplicates_of_a_large_group(spark, node):
    """A chain of edits in a group larger than a node: links between neighbours only."""
    base, rows = prose(7, 200), []
    for k in range(12):
        text = list(base)
        text[: 8 * k] = prose(100, 200)[: 8 * k]
        rows.append((k, " ".join(text)))
    rows.append((50, " ".join(prose(9, 200))))
    got = nearby.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, node=node, depth=3).collect()
    assert {r.component_id for r in got if r.doc_id < 12} == {0} and [r.component_id for r in got if r.doc_id == 50] == [50]


def test_near_duplicates_of_pairs_in_large_nodes(spark):
    """Pairs just above the threshold are found in nodes larger than a block, too."""
    rows = []
    for k in range(150):
        text = prose(1000 + k, 200)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text[:187] + prose(5000 + k, 13)))]  # 185 of 211 shingles
    got = by_id(nearby.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, node=1))
    assert [int(c) for c in got.component_id] == [i - i % 2 for i in range(300)]


def test_signature_bar_keeps_unlucky_pairs(spark):
    """A pair at the threshold whose signatures agree in 38 of 64 places (below three quarters of 0.8) goes on to the full sets."""
    one = np.arange(64, dtype=np.uint32)
    other = np.where(one < 38, one, one + np.uint32(1000)).astype(np.uint32)
    far = one + np.uint32(5000)
    for known, left in (((0, 1, 2), {0, 1}), ((0, 0, 2), set())):  # members already connected need not meet
        rows = [(1, 0, 0, k, known[k], bytearray(x.tobytes())) for k, x in enumerate((one, other, far))]
        members = spark.createDataFrame(rows, "path long, i int, j int, doc_id long, c long, signature binary")
        assert {r.doc_id for r in nearby.plausible(members, 80).collect()} == left


def test_sketches_keep_what_signatures_keep(spark):
    """Members travel with a byte of each value of their signature: no pair that agrees in enough places is lost by it."""
    draw = np.random.default_rng(4)
    whole = draw.integers(0, 1 << 32, (60, 64), dtype=np.uint64).astype(np.uint32)
    whole[1::2, :40] = whole[::2, :40]  # pairs alike in 40 of 64 places
    short = [nearby.sketch(x) for x in whole]
    assert all(x.nbytes == 64 for x in short)
    assert all(((short[a] == short[b]) >= (whole[a] == whole[b])).all() for a in range(60) for b in range(60))
    kept = []
    for signatures in (whole, short):
        rows = [(k // 6, 0, 0, k, k, bytearray(x.tobytes())) for k, x in enumerate(signatures)]
        kept.append({r.doc_id for r in nearby.plausible(spark.createDataFrame(rows, "path long, i int, j int, doc_id long, c long, signature binary"), 85).collect()})
    assert kept[0] == kept[1] == set(range(60))


def test_large_nodes_meet_across_components(spark):
    """All pairs of different components whose sizes allow a link meet; a large component costs rows in proportion to it."""
    node = 10
    rows = [(1, k, 100, 0) for k in range(400)] + [(1, 1000 + k, 60 + 7 * k, 1000 + k) for k in range(25)] + [(2, k, 100, 5) for k in range(40)]
    large = spark.createDataFrame([(*r, bytearray(b"")) for r in rows], "path long, doc_id long, n_shingles long, c long, signature binary")
    got = nearby.across(large, 80, node).toPandas()
    met = {(x, y) for _, g in got.groupby("path") for x in g.doc_id for y in g.doc_id if x < y}
    for _, x, m, c in rows[:425]:
        for _, y, n, d in rows[:425]:
            if x < y and c != d and 100 * min(m, n) >= 80 * max(m, n):
                assert (x, y) in met
    # at most three strata for a member of the large component, its blocks and a few more for the others, and nothing of the node that is one component
    assert got.groupby("path").size().max() <= 2 * node and len(got) <= 3 * 400 + 25 * (40 + 5)


@pytest.mark.parametrize("node", [5, 800])
def test_components_through_blocks(spark, node):
    """Near copies of one text beside texts near only one of them: as brute force says, in blocks of any size."""
    base, rows = prose(31, 120), []
    for k in range(40):
        text = list(base)
        text[3 * k : 3 * k + (2 if k < 30 else 14)] = prose(400 + k, 2 if k < 30 else 14)
        rows.append((k, " ".join(text)))
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for k, t in rows}
    want = {k: k for k in sets}
    for _ in sets:
        for x in sets:
            for y in sets:
                if 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                    want[x] = min(want[x], want[y])
    got = by_id(nearby.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, node=node))
    assert [int(c) for c in got.component_id] == [want[k] for k in sorted(want)]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)] + [(200, 100), (100, 150)], "a long, b long")
    got = dict(nearby.connected(edges).collect())
    assert all(got[i] == 0 for i in range(1, 65)) and got[200] == got[150] == 100


def test_ring_is_full_and_moves_little(spark, odd, nothing):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    a = ring.bounded_ring(df, ["doc_id"], shards=7).toPandas().set_index("doc_id")
    b = ring.bounded_ring(df, ["doc_id"], shards=8).toPandas().set_index("doc_id").shard
    counts = a.shard.value_counts()
    assert counts.max() - counts.min() <= 1
    assert (a.shard != b.loc[a.index]).mean() < 0.45  # a plain modulus moves seven of eight
    assert ring.bounded_ring(odd, ["doc_id"], shards=5).count() == 12 and ring.bounded_ring(nothing, ["doc_id"]).count() == 0


def test_ring_pieces_match_one_by_one():
    """Rows placed in order of their arcs: own shard first, then clockwise."""
    counts, owner = [5, 0, 9, 1, 4, 2], [0, 1, 2, 0, 1, 2]
    pieces_ = ring.place(counts, owner, 3)
    where = {(arc, r): s for arc, a, b, s, _ in pieces_ for r in range(a, b)}
    room, left, want = [7, 7, 7], [], {}
    for arc, n in enumerate(counts):
        for r in range(n):
            if room[owner[arc]]:
                room[owner[arc]] -= 1
                want[arc, r] = owner[arc]
            else:
                left.append((arc, r))
    for arc, r in left:
        at = (arc + 1) % 6
        while not room[owner[at]]:
            at = (at + 1) % 6
        room[owner[at]] -= 1
        want[arc, r] = owner[at]
    assert where == want


def test_cascade_odd_rows(odd, nothing):
    got = by_id(cascade.cascade(odd.where("doc_id is not null"), ["doc_id"], base=True))
    assert len(got) == 11 and (got.loc[[3, 4, 5]].n_words == 0).all() and got.loc[3].passed
    assert cascade.cascade(nothing, ["doc_id"]).count() == 0


def test_cascade_verdict_does_not_depend_on_order(odd):
    a = cascade.cascade(odd, ["doc_id"]).select("doc_id", "passed").collect()
    b = cascade.cascade(odd, ["doc_id"], list(reversed(cascade.RULES))).select("doc_id", "passed").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert [r.name for r in cascade.ordered(cascade.RULES[:2], [{"index": 0, "rejected": 0.1, "seconds": 1.0}, {"index": 1, "rejected": 0.1, "seconds": 0.1}])] == ["capitals", "symbols"]


def test_mixing_targets_and_positions(spark, odd, nothing):
    rows = [(i, "w " * 10, f"s{'a' * (i % 3)}") for i in range(300)] + [(1000 + i, "w", "tiny") for i in range(5)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.curriculum(df, ["doc_id", "source"]).toPandas()
    assert got.taken.max() <= 3 * got["size"].max() and got[got.source == "tiny"].target.iloc[0] <= 15
    by = got.groupby("source")
    assert (by.taken.sum() - by.target.first()).abs().max() <= 10
    assert got.taken.sum() == pytest.approx(3005, abs=40)
    again = mixing.curriculum(df.orderBy(F.rand(3)), ["doc_id"], rows_per_bucket=50).toPandas()
    assert again.dropna(subset="doc_id").set_index("doc_id").taken.to_dict() == got.dropna(subset="doc_id").set_index("doc_id").taken.to_dict()
    order = [p[0] for p in got.positions if len(p)]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1
    assert mixing.curriculum(odd, ["doc_id"]).count() == 12 and mixing.curriculum(nothing, ["doc_id"]).count() == 0
    assert mixing.trained(clash(df)).columns == clash(df).columns


def test_mixing_follows_each_source_s_schedule(spark):
    """Early and late words of each source are in the proportions of its own schedule, in the positions and in the order of rows."""
    df = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    drifts = {"a": 0.5, "b": 0.0, "c": -0.5}
    got = mixing.curriculum(df, ["doc_id", "source"], weights=(1, 1, 1)).toPandas()
    for s, d in drifts.items():
        t = np.concatenate(got[got.source == s].positions.tolist())
        assert len(t) == 1000 and [(t < x).mean() for x in (0.25, 0.5, 0.75)] == pytest.approx([x + d * (x * x - x) for x in (0.25, 0.5, 0.75)], abs=0.003)
        assert (got.source[:1500] == s).sum() == pytest.approx(1000 * (0.5 - d / 4), abs=5)
    order = mixing.trained(df, weights=(1, 1, 1)).toPandas().source
    assert (order[:1500] == "a").sum() < 400 and (order[:1500] == "c").sum() > 600
    with pytest.raises(ValueError):
        mixing.curriculum(df, ["doc_id"], drifts=(1.0,))


def test_mix_moves_texts_twice(spark, capsys):
    """Once to the running sums of their source and once to their place in training; the join between them meets the rows where they are."""
    df = spark.createDataFrame([(i, f"a b c {i}", "x" if i % 3 else None) for i in range(40)], "doc_id long, text string, source string")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        mixing.trained(df).explain("formatted")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    details = [x.split("Input", 1)[1].split("\n", 1)[0] for x in capsys.readouterr().out.split("\n\n") if ") Exchange" in x]
    assert sum("_row#" in x or "_doc#" in x for x in details) == 2


def test_pieces_against_the_library():
    c = pieces.codec(pieces.default_model())
    for text in ["", " ", "  a  b\tc\n\n é ﬁ \x00 x▁y", "\n", "a\nb ", "日本語 テスト 🙂", "▁▁", "a" * 300, "x" * 3000 + " y", "the then there, The THE"]:
        ids = c.library.encode(text)
        assert c.encode(text) == ids and c.decode(ids) == c.library.decode(ids)


def test_pieces_of_unspaced_text():
    """Long chunks are exact and never kept; what is kept is bounded in characters, too."""
    c = pieces.PieceCodec(pieces.default_model(), memory=2000)
    draw = np.random.default_rng(2)
    for k in range(60):
        text = "".join(draw.choice(list("abcdefgh日本語é"), 4000 if k < 59 else 300_000)) + f" word{k} " + " ".join(f"{'x' * 150}{k}{j}" for j in range(10))
        assert c.encode(text) == c.library.encode(text)
        assert sum(len(x) for x in c.numbers if len(x) <= pieces.LONG) <= pieces.MEAN * 2000 and len(c.passing) <= 1
    c.encode("short text")
    assert all(len(x) <= pieces.LONG for x in c.numbers) and not c.passing


def test_pieces_odd_rows(odd, nothing):
    got = pieces.encode_texts(odd, ["doc_id"], pieces.default_model(), ids=True)
    assert got.count() == 12 and got.where("doc_id in (3, 4)").agg(F.sum("n_tokens")).first()[0] == 0
    assert got.where("size(ids) <> n_tokens").count() == 0
    assert pieces.encode_texts(nothing, ["doc_id"], pieces.default_model()).count() == 0


def test_pipeline_by_brute_force(spark, sf):
    """Each stage against a plain version of its decision on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        before, after = docs.toPandas(), out.toPandas()
        assert k == 4 or out.columns == names
        ids = set(after.doc_id)
        if k == 0:
            model = preference.op6_model(spark, sf)
            good = model.score(np.array([preference.features(t) for t in before.text])) >= 0.3
            assert ids == set(before.doc_id[good]) and 0.5 < len(ids) / len(before) < 1
        elif k == 1:
            sets = {}
            for i, t in zip(before.doc_id, before.text):
                w = t.encode().lower().split()
                sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or {tuple(w)}
            for i in set(before.doc_id) - ids:  # every dropped one is like one that stays or was dropped, of smaller id
                assert any(j < i and 100 * len(s & sets[i]) >= 80 * len(s | sets[i]) for j, s in sets.items())
            left = sorted(ids)
            assert not any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for n, a in enumerate(left) for b in left[:n])
        elif k == 2:
            seen, want = {}, {}
            for i, t in sorted(zip(before.doc_id, before.text)):
                w = t.split()
                runs = [tuple(w[j:j + 50]) for j in range(len(w) - 49)]
                gone = {x for j, u in enumerate(runs) if u in seen for x in range(j, j + 50)}
                want[i] = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else t
                seen.update(dict.fromkeys(runs))
            assert dict(zip(after.doc_id, after.text)) == want
        elif k == 3:
            taken = mixing.curriculum(docs, ["doc_id"]).toPandas().set_index("doc_id").copies
            assert after.groupby("doc_id").size().to_dict() == {i: c for i, c in taken.to_dict().items() if c}
        else:
            lib = pieces.codec(pieces.default_model()).library
            text = before.set_index("doc_id").text.to_dict()
            assert all(list(x) == lib.encode(text[i]) for i, x in zip(after.doc_id, after.ids)) and len(after) == len(before)
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_pipeline_keeps_odd_rows(spark, sf, odd, nothing):
    for table in (clash(odd), nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns[0] == "doc_id"
