"""Alignment of two tokenizers, periodic runs and byte-level BPE: against plain versions, the libraries and awkward rows."""

import collections
import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortsmith.llm import alignment, bytepairs, periods, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, "a b " * 40), (2, None), (3, ""), (4, " \n\t\x0b"), (None, "x y z " * 5), (5, "é \x00 🙂 ▁x"), (6, "<|endoftext|> </s>"), (6, "<|endoftext|> </s>"), (7, "a" * 100_000),
       (8, "日本語テスト" * 3000), (9, " ".join(f"w{i * i % 977}" for i in range(20_000))), (10, "don't  stop\r\n end "), (11, "ͿԱ꟎ 𐵀x")]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows with columns whose names the operators use themselves."""
    df = spark.createDataFrame([(i, t, "en", None, None) for i, t in ODD], SCHEMA)
    for name in ("n_tokens", "ids", "starts", "kept_text", "n_a", "_block", "_links", "_pairs", "_row_id_", "pair", "_k0"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    path, pattern = bytepairs.default_ranks()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bytepairs.read_ranks(path), special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def ids_of(text):
    return np.frombuffer(bytepairs.codec(*bytepairs.default_ranks()).encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abe  '\n1-_", max_size=80), st.text(alphabet="日本éß̀ ²Ⅳ", max_size=30)))
def test_byte_pairs_against_the_library(library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of(text) == library.encode_ordinary(text)


def test_byte_pairs_of_every_character(library):
    """The classes of all characters are the library's."""
    every = [chr(i) for i in [*range(0xD800), *range(0xE000, 0x110000)]]
    c = bytepairs.codec(*bytepairs.default_ranks())
    for a in range(0, len(every), 4000):
        text = "".join(f"a{x}1{x}" for x in every[a : a + 4000])
        assert np.frombuffer(c.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_byte_pairs_of_joined_tokens(library):
    """Random sequences of tokens, where longest matches often go wrong."""
    draw, parts = random.Random(3), [p for p in bytepairs.codec(*bytepairs.default_ranks()).parts if p.isalpha()]
    for _ in range(4000):
        text = b"".join(draw.choice(parts) for _ in range(draw.randint(2, 6))).decode()
        assert ids_of(text) == library.encode_ordinary(text)


def test_tokens_fit_as_merging_says():
    c = bytepairs.codec(*bytepairs.default_ranks())
    draw = random.Random(5)
    short = [i for i, p in enumerate(c.parts) if len(p) < 6]
    for _ in range(20_000):
        a, b = draw.choice(short), draw.choice(short)
        assert c.fits(a, b) == (c.merged(c.parts[a] + c.parts[b]) == [c.parts[a], c.parts[b]])


def test_one_long_word_is_linear_and_not_remembered():
    c = bytepairs.BytePairs(bytepairs.read_ranks(bytepairs.default_ranks()[0]), public_tokenizers.PATTERN, memory=1000)
    word = "".join(random.Random(1).choice("abcdefgh") for _ in range(1_000_000))
    assert c.decode(c.encode(word)) == word.encode() and not c.words
    for k in range(400):
        c.encode(f"word{k} and more")
    assert sum(map(len, c.words)) <= 1100


def test_byte_pairs_odd_rows(odd, nothing, library):
    path, pattern = bytepairs.default_ranks()
    got = bytepairs.encode_texts(odd, ["doc_id", "text", "n_a"], path, pattern, ids=True).collect()
    assert len(got) == len(ODD)
    for r in got:
        want = library.encode_ordinary(r.text or "")
        assert (r.ids, r.n_tokens, r.decoded_sha256, r.n_a) == (want, len(want), sha((r.text or "").encode()), "mine")
    assert bytepairs.encode_texts(nothing, ["doc_id"], path, pattern).count() == 0


def test_op13_against_the_library(spark, sf, library):
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id").text.fillna("")
    got = queries.QUERIES["op13_byte_pairs"](spark, sf).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    for i, text in docs.items():
        ids = library.encode_ordinary(text)
        assert tuple(got.loc[i]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode_bytes(ids)))


def plain_runs(w):
    """Every lag in turn."""
    runs = {}
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            start = i - q
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - start >= max(6, 4 * q):
                runs.setdefault((start, i), q)
    return sorted((a, b - a, q) for (a, b), q in runs.items())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 4)), max_size=6))
def test_runs_against_every_lag(blocks):
    w = [x for body, times, cut in blocks for x in (body * times)[: max(1, len(body) * times - cut)]]
    assert periods.find_runs(w) == plain_runs(w)


def test_runs_of_long_repetitive_texts():
    draw = random.Random(1)
    body = [b"%d" % draw.randrange(50) for _ in range(30_000)]
    assert periods.find_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    assert periods.find_runs(body * 5) == [(0, 150_000, 30_000)]
    assert periods.find_runs(body[:5]) == [] and periods.find_runs([]) == []
    short, long = [b"a"], [b"a", b"b"]
    while len(long) < 300_000:
        short, long = long, long + short
    assert periods.find_runs(long) == []  # repeats everywhere, none of them four times
    lines = [x for _ in range(5000) for x in [*[b"l%d" % k for k in range(10)], *[b"%d" % draw.randrange(10**6)] * draw.randint(1, 3)]]
    assert periods.find_runs(lines) == []


def test_words_collapsed_by_a_plain_rule():
    draw = random.Random(4)
    for _ in range(300):
        w = [draw.choice([b"a", b"b"]) for _ in range(draw.randint(0, 40))]
        runs = plain_runs(w)
        assert periods.collapsed(w, runs) == [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
    assert periods.greatest([(0, 8, 2), (9, 4, 1), (20, 12, 3)]) == (0, 8, 2) and periods.greatest([]) is None


def test_runs_odd_rows(odd, nothing):
    got = {r.doc_id: r for r in periods.collapse(odd, ["doc_id", "starts"], text_col="text").select("doc_id", "n_words", "start", "length", "period", "kept_text").collect()}
    assert (got[1].n_words, got[1].start, got[1].length, got[1].period, got[1].kept_text) == (80, 0, 80, 2, "a b")
    assert all(got[i].n_words == 0 and got[i].start is None and got[i].kept_text == "" for i in (2, 3, 4))
    assert got[None].period == 3 and got[7].n_words == 1 and periods.collapse(odd, ["doc_id"]).count() == len(ODD)
    assert periods.collapse(nothing, ["doc_id"]).count() == 0


def plain_groups(a, b, parts_a, parts_b):
    """Groups by walking along both sequences."""
    out, i, j = [], 0, 0
    while i < len(a):
        x, y, i0, j0 = len(parts_a[a[i]]), len(parts_b[b[j]]), i, j
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                x, i = x + len(parts_a[a[i]]), i + 1
            else:
                y, j = y + len(parts_b[b[j]]), j + 1
        out.append((a[i0:i], b[j0:j]))
    return out


def test_shared_cuts_of_random_ends():
    draw = random.Random(2)
    for _ in range(400):
        sizes, ends, lasts = ([], []), [], ([], [])
        for _ in range(draw.randint(1, 4)):
            n = draw.randint(1, 60)
            for side in (0, 1):
                inner = sorted(draw.sample(range(1, n), draw.randint(0, n - 1)) if draw.random() < 0.8 else [])
                sizes[side].extend(np.diff([0, *inner, n]).tolist())
                lasts[side].append(len(sizes[side]) - 1)
        ends = [np.cumsum(s) for s in sizes]
        got = alignment.shared_cuts(*ends, *map(np.array, lasts))
        both = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        assert [ends[0][got[0]].tolist(), ends[1][got[1]].tolist()] == [both, both]


def test_a_long_stretch_without_shared_ends():
    """Ends shared only near one border: the search grows, and every cut is found."""
    a, b = np.arange(2, 400_002, 2), np.append(np.arange(1, 399_999, 2), [399_998, 400_000])
    got = alignment.shared_cuts(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert a[got[0]].tolist() == b[got[1]].tolist() == [399_998, 400_000]


def plain_alignment(texts):
    """Rows of the query by the libraries alone."""
    byte_path, pattern, piece_path = alignment.default_vocabularies()
    worker = alignment.aligner(byte_path, pattern, piece_path)
    library = Tokenizer.from_file(byte_path)
    library.encode_special_tokens = True
    found = []
    for text in texts:
        a, b = library.encode(" " + (text or ""), add_special_tokens=False).ids, worker.b.encode(text or "")
        want = (" " + (text or "")).encode()
        good = text and b"".join(worker.a.parts[i] for i in a) == want and b"".join(worker.parts_b[i] for i in b) == want
        found.append((a, b, plain_groups(a, b, worker.a.parts, worker.parts_b)) if good else ([], [], []))
    count = collections.Counter((x[-1], y[-1]) for _, _, groups in found for x, y in groups)
    top = collections.defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    for a, b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (len(a), len(b), len(groups), len(links), sum(count[k] == top[k[1]] for k in links), sum(count[k] for k in links), sha(written.encode()) if a else "")


@pytest.mark.parametrize("block", [1, 40_000, 1 << 23])
def test_alignment_odd_rows(odd, nothing, block):
    rows = odd.repartition(3, F.length("text"))
    got = alignment.align_texts(rows, ["doc_id", "text", "_block", "pair", "n_a"], *alignment.default_vocabularies(), block=block)
    assert got.columns[:5] == ["doc_id", "text", "_block", "pair", "n_a"] and len(got.columns) == 11
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    seen = sorted((tuple(r) for r in got.collect()), key=key)
    want = sorted(((i, t, "mine", "mine", *x) for (i, t), x in zip(ODD, plain_alignment([t for _, t in ODD]))), key=key)
    assert seen == want
    assert alignment.align_texts(nothing, ["doc_id"], *alignment.default_vocabularies()).count() == 0


def test_op11_brute_force(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet").sort_values("doc_id")
    got = queries.QUERIES["op11_shared_cuts"](spark, sf).toPandas().set_index("doc_id").sort_index()
    assert list(got.itertuples(name=None)) == [(i, *x) for i, x in zip(docs.doc_id, plain_alignment(docs.text))]


def test_byte_level_file_of_another_kind():
    with pytest.raises(ValueError):
        alignment.read_byte_level(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)
