"""The registered text queries: oracle SQL where there is one, brute force or round trips elsewhere, whole tables at the smallest scale."""

import collections
import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from check import compare, oracle_connection
from cohortsmith.llm import pieces, queries


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="module")
def docs(sf):
    return pd.read_parquet(f"{sf}/documents.parquet").sort_values("doc_id")


def words(text):
    return (text or "").encode().split()


def rows(spark, sf, name):
    return queries.QUERIES[name](spark, sf).toPandas().set_index("doc_id").sort_index()


def test_all_are_registered():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, sf, name):
    assert not compare(queries.QUERIES[name](spark, sf), oracle_connection(sf), queries.ORACLE[name])[1]


def test_op3_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = rows(spark, sf, "op3_string_kernel_toxicity")
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index])
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    seen = got.join(labels, how="inner")
    seen = seen[seen.held_out]
    hit = seen[(seen.predicted == 1)]
    assert hit.toxic.mean() >= 0.8 and hit.toxic.sum() >= 0.3 * seen.toxic.sum()


def test_op4_brute_force(spark, sf, docs):
    got = rows(spark, sf, "op4_chosen_path")
    sets = {}
    for i, text in zip(docs.doc_id, docs.text):
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    where = collections.defaultdict(list)
    for i, s in sets.items():
        common = collections.Counter(j for t in s for j in where[t])
        for t in s:
            where[t].append(i)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert [(i, r.n_shingles, r.component_id, r.kept) for i, r in got.iterrows()] == [(i, len(sets[i]), find(i), find(i) == i) for i in sets]


def test_op5_brute_force(spark, sf, docs):
    got = rows(spark, sf, "op5_prefix_doubling")
    seen, want = set(), []
    for i, text in zip(docs.doc_id, docs.text):
        b = (text or "").encode()
        step = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                step[k] += 1
                step[k + 100] -= 1
            seen.add(b[k:k + 100])
        gone = np.cumsum(step)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert list(got.itertuples(name=None)) == want


def test_op6_held_out(spark, sf):
    got = rows(spark, sf, "op6_preference_quality")
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index])
    seen = got.join(labels, how="inner")
    assert (seen.predicted == seen.quality)[seen.held_out].mean() >= 0.9
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_op7_law(spark, sf, docs):
    got = rows(spark, sf, "op7_bounded_ring")
    text = docs.set_index("doc_id").text.fillna("")
    assert list(got["size"]) == [len(t.encode()) + 1 for t in text] and list(got.text_crc32) == [zlib.crc32(t.encode()) for t in text]
    counts = got.groupby("shard").size()
    assert set(got.shard) == set(range(8)) and counts.max() - counts.min() <= 1 and (got.law == "rows").all()
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_op8_brute_force(spark, sf, docs):
    got = rows(spark, sf, "op8_rule_cascade")
    for i, text in zip(docs.doc_id, docs.text):
        text, r = text or "", got.loc[i]
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        again = set()
        for k in range(len(w) - 7):
            if seen[tuple(w[k:k + 8])] > 1:
                again.update(range(k, k + 8))
        want = (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_op10_round_trip(spark, sf, docs):
    lib = pieces.codec(pieces.default_model()).library
    got = rows(spark, sf, "op10_piece_encoding")
    for i, text in zip(docs.doc_id, docs.text):
        ids = lib.encode(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
        assert tuple(got.loc[i]) == want
