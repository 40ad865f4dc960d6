"""Operator 11: alignment of the tokens of two tokenizers by divide and conquer at shared cuts.

Both token sequences of a text spell the same bytes. An interval of them whose ends both share is halved: bisection finds the byte in its middle among the ends of one side,
the nearest end to it that the other side has too cuts the interval, and both halves are cut in turn; an interval without a shared end inside is a leaf group. The
intervals of many texts are cut side by side, level by level. The last tokens of a group end together and are linked.

How often a pair of ids is linked in the whole corpus comes from blocks of documents: a block's different pairs are counted where it is aligned, summed over all blocks, and each block
gets back the counts of its own pairs. So a frequent pair travels once per block, and no table of all pairs is sent anywhere.

Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens: zeros, and '' for the groups. Repeated rows count as often as they occur.
Rows are told apart by their place in a block, so ids may be null or equal.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpointed
from .bytepairs import BytePairs
from .common import besides, documents, sha256, to_table, with_text

#: Characters aligned side by side, and characters of a block.
STEP, BLOCK = 1 << 20, 8 << 20


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of either side that end together, in order.

    ``ends``: bytes up to the end of each token, over all texts one after the other; ``last``: the last token of each text that has any.
    """
    edge_a = np.append(0, ends_a)
    token_b = np.full(int(ends_b[-1]) + 1, -1, np.int64)  # the token that ends at a byte
    token_b[ends_b] = np.arange(len(ends_b))
    cuts_a, cuts_b = [last_a], [last_b]
    first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
    while True:
        inner = (first_a < last_a) & (first_b < last_b)  # a single token of either side is a leaf
        first_a, last_a, first_b, last_b = first_a[inner], last_a[inner], first_b[inner], last_b[inner]
        if not len(first_a):
            break
        middle = np.searchsorted(ends_a, (edge_a[first_a] + edge_a[last_a + 1]) // 2)
        middle = np.clip(middle, first_a, last_a - 1)
        cut_a, cut_b = np.full(len(middle), -1), np.full(len(middle), -1)
        left = np.arange(len(middle))
        for step in (0, 1, -1, 2, -2):
            place = middle[left] + step
            inside = (place >= first_a[left]) & (place < last_a[left])
            other = token_b[ends_a[np.where(inside, place, 0)]]
            hit = inside & (other >= 0)
            cut_a[left[hit]], cut_b[left[hit]] = place[hit], other[hit]
            left = left[~hit]
        for i in left[(middle[left] - first_a[left] > 2) | (last_a[left] - 1 - middle[left] > 2)].tolist():
            cut_a[i], cut_b[i] = nearest_shared(ends_a, token_b, int(first_a[i]), int(last_a[i]), int(middle[i]))
        cut = cut_a >= 0
        a, b = cut_a[cut], cut_b[cut]
        cuts_a.append(a)
        cuts_b.append(b)
        halves = np.stack((first_a[cut], a + 1), 1).ravel(), np.stack((a, last_a[cut]), 1).ravel()
        first_b, last_b = np.stack((first_b[cut], b + 1), 1).ravel(), np.stack((b, last_b[cut]), 1).ravel()
        first_a, last_a = halves
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def nearest_shared(ends_a: np.ndarray, token_b: np.ndarray, first: int, last: int, middle: int) -> tuple[int, int]:
    """The token in [first, last) nearest to ``middle`` whose end the other side shares, and the other's; -1 if none. Looks in a growing stretch."""
    size = 8
    while True:
        lo, hi = max(first, middle - size), min(last, middle + size + 1)
        other = token_b[ends_a[lo:hi]]
        hits = np.flatnonzero(other >= 0)
        if len(hits):
            best = hits[np.argmin(np.abs(hits + lo - middle))]
            return int(best) + lo, int(other[best])
        if lo == first and hi == last:
            return -1, -1
        size *= 4


def byte_level_bytes() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def read_byte_level(path: str, pattern: str) -> BytePairs:
    """A codec for a tokenizers file of byte-level BPE, without its special tokens; raises ValueError if the file asks for anything else."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and spec["normalizer"] is None
    if not plain or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        raise ValueError("not a plain byte-level BPE")
    special = {t["content"] for t in spec["added_tokens"]}
    code = byte_level_bytes()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    ranks = {bytes(code[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    if any(i >= j for i, j in zip(ids, ids[1:])) or len(ids) + 256 != len(ranks):
        raise ValueError("the order of ids is not that of merges")
    return BytePairs(ranks, pattern)


class Aligner:
    """Both tokenizers and the alignment of a few texts at a time."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str) -> None:
        self.a = read_byte_level(byte_path, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        lib = self.b
        ids = range(lib.get_piece_size())
        self.parts_b = [bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        self.sizes_a = np.array(list(map(len, self.a.parts)), np.int64)
        self.sizes_b = np.array(list(map(len, self.parts_b)), np.int64)
        self.base = max(len(self.a.parts), len(self.parts_b))
        # an id with what follows it: inside a group, and at its end
        self.names = [f"{i}{mark}" for mark in ",|,;" for i in range(self.base)]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where a side does not spell the text."""
        none = np.zeros(0, np.int64)
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        full = [k for k, t in enumerate(texts) if t]
        for k, found in zip(full, self.b.encode([texts[k] for k in full], num_threads=1)):
            text = " " + texts[k]
            want, ids = text.encode(), self.a.encode(text)
            if b"".join([self.parts_b[i] for i in found]) == want and self.a.decode(ids) == want:
                out_a[k], out_b[k] = np.frombuffer(ids, "<u4").astype(np.int64), np.array(found, np.int64)
        return out_a, out_b

    def align(self, texts: list[str | None]) -> list[tuple[int, int, str, np.ndarray]]:
        """Of each text: tokens of either side, its groups written out, and its links as id * base + id."""
        per_a, per_b = self.tokens(texts)
        count_a, count_b = np.array(list(map(len, per_a))), np.array(list(map(len, per_b)))
        a, b = np.concatenate([np.zeros(0, np.int64), *per_a]), np.concatenate([np.zeros(0, np.int64), *per_b])
        if not len(a):
            return [(0, 0, "", a)] * len(texts)
        full = count_a > 0
        last_a, last_b = np.cumsum(count_a)[full] - 1, np.cumsum(count_b)[full] - 1
        cut_a, cut_b = shared_cuts(np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b]), last_a, last_b)
        links = a[cut_a] * self.base + b[cut_b]
        # all tokens in the order of the groups, those of the first side first
        order = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.full(len(b), 2, np.int64)
        mark_a[cut_a], mark_b[cut_b] = 1, 3
        group_a, group_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b - 2) - (mark_b - 2)
        order[np.arange(len(a)) + np.append(0, cut_b + 1)[group_a]] = a + mark_a * self.base
        order[np.arange(len(b)) + cut_a[group_b] + 1] = b + mark_b * self.base
        out, at, group, names = [], 0, 0, self.names
        ends = np.searchsorted(cut_a, np.cumsum(count_a) - 1, side="right").tolist()
        for n, m, end in zip(count_a.tolist(), count_b.tolist(), ends):
            end = end if n else group
            written = "".join([names[i] for i in order[at : at + n + m].tolist()])[:-1]
            out.append((n, m, written, links[group:end]))
            at, group = at + n + m, end
        return out


_aligners: dict[tuple[str, str, str], Aligner] = {}


def aligner(byte_path: str, pattern: str, piece_path: str) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    key = (byte_path, pattern, piece_path)
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def _steps(texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
    """Ranges of rows of about STEP characters, with their size."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= STEP:
            yield start, i + 1, size
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts), size


def align_texts(docs: DataFrame, keep: list[str], byte_path: str, pattern: str, piece_path: str, *, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their second id), count_sum and groups_sha256.

    The files are there for every executor. ``block``: characters whose different pairs are counted in one task. A kept column with the
    name of a result's gives way to it.
    """
    own = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    keep = besides(keep, own)
    rows, place = with_text(docs, keep, text_col)
    kept = rows.select(*keep).schema
    inner = [f"_k{i}" for i in range(len(keep))]
    mid = "_block long, _row long, n_a long, n_b long, n_links long, groups_sha256 string, _links binary, _pairs array<long>, _counts array<long>"
    names = [part.split()[0] for part in mid.split(", ")]
    fields = StructType([*[type(f)(n, f.dataType, True) for n, f in zip(inner, kept.fields)], *StructType.fromDDL(mid).fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner(byte_path, pattern, piece_path)
        number, size, serial = TaskContext.get().partitionId() << 32, 0, 0
        gathered: list[np.ndarray] = []
        types: list[pa.DataType] = []

        def table_row() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(gathered), return_counts=True)
            row = dict.fromkeys(names, [None]) | {"_block": [number], "_pairs": [pairs], "_counts": [counts]}
            new = to_table(row, mid)
            return pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in types], *[new.column(n).combine_chunks() for n in names]], names=[*inner, *names])

        for batch in batches:
            types = [batch.column(i).type for i in range(len(keep))]
            texts = batch.column(place).to_pylist()
            for x, y, n in _steps(texts):
                found = worker.align(texts[x:y])
                out = {"_block": [number] * (y - x), "_row": list(range(serial, serial + y - x)), "n_a": [f[0] for f in found], "n_b": [f[1] for f in found],
                       "n_links": [len(f[3]) for f in found], "groups_sha256": [sha256(f[2].encode()) if f[0] else "" for f in found],
                       "_links": [pack(f[3], worker.base) for f in found], "_pairs": [None] * (y - x), "_counts": [None] * (y - x)}
                new = to_table(out, mid)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(x, y - x) for i in range(len(keep))], *[new.column(c).combine_chunks() for c in names]],
                                                 names=[*inner, *names])
                gathered.append(np.concatenate([f[3] for f in found]))
                size, serial = size + n, serial + y - x
                if size >= block:
                    yield table_row()
                    number, size, gathered = number + 1, 0, []
        if gathered:
            yield table_row()

    done = checkpointed(rows.mapInArrow(run, fields))
    base = F.lit(pair_base(byte_path, piece_path))
    pairs = done.where("_pairs is not null").select("_block", F.explode(F.arrays_zip("_pairs", "_counts")).alias("_p")).select("_block", F.col("_p._pairs").alias("pair"), F.col("_p._counts").alias("n"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("other", F.pmod("pair", base))
    highest = totals.groupBy("other").agg(F.max("count").alias("top"))
    ranked = totals.join(highest, "other").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    back = pairs.select(F.col("_block").alias("_at"), "pair").join(ranked, "pair")
    found = done.where("_pairs is null").drop("_pairs", "_counts")
    result = StructType([*fields.fields[: len(keep)], *StructType.fromDDL(own).fields])
    size_of = pair_base(byte_path, piece_path)

    def settle(rows: pa.Table, table: pa.Table) -> pa.Table:
        pair = table.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count, best = pair[order], table.column("count").to_numpy()[order], table.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = [], []
        for links in rows.column("_links"):
            at = np.searchsorted(pair, unpack(links.as_buffer(), size_of))
            n_best.append(int(best[at].sum()))
            total.append(int(count[at].sum()))
        new = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "n_groups": rows.column("n_links")}
        return pa.table({n: new[n] if n in new else rows.column(n) for n in result.names})

    out = found.groupBy("_block").cogroup(back.groupBy("_at")).applyInArrow(settle, result)
    return out.select(*[F.col(n).alias(k) for n, k in zip(inner, keep)], *result.names[len(keep) :])


def pair_base(byte_path: str, piece_path: str) -> int:
    """One more than the largest id of both vocabularies, from the files."""
    with open(byte_path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"] for t in spec["added_tokens"]}
    first = max(i for token, i in spec["model"]["vocab"].items() if token not in special) + 1
    return max(first, sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size())


def pack(links: np.ndarray, base: int) -> bytes:
    """Both ids of each link, in two bytes each where ids allow it."""
    return np.stack((links // base, links % base), 1).astype("<u2" if base <= 1 << 16 else "<u4").tobytes()


def unpack(data: object, base: int) -> np.ndarray:
    ids = np.frombuffer(data, "<u2" if base <= 1 << 16 else "<u4").reshape(-1, 2).astype(np.int64)
    return ids[:, 0] * base + ids[:, 1]


def op11_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document, with how common its links are in all documents."""
    return align_texts(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"], *default_vocabularies())


def default_vocabularies() -> tuple[str, str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.PATTERN, p.path("piece_bpe_32k.model")
