"""Operator 5: remove repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a document of smaller id, or further left in the same one). As in a suffix
array by prefix doubling, positions get ranks of growing prefixes, Spark brings equal ranks together by sorting, and positions whose rank is alone leave. Ranks are
fingerprints of the prefixes, so the rank of a doubled prefix is the pair of ranks at a position and at the offset, without renumbering. The
rounds up to the threshold:

1. ``GRAM`` bytes, at sampled positions only: of each string of ``length`` bytes the position of its least rank, which equal strings share wherever they
   stand. Positions alone with their rank leave with all strings they were sampled for.
2. Every position left carries its surroundings, all strings it was sampled for; equal surroundings of a block are one row. Spark brings equal ranks together.
3. There the strings within get the pair of ranks of their halves, at offset half of ``length``, and a sort of these pairs tells which are equal and which place
   is first; if all surroundings of a rank are equal, no pairs are needed. Each block hears which stretches of its surroundings belong to an earlier place.

Documents live in blocks of bounded size by a hash of their id; equal ranks are combined within a block before they travel, so a string that many documents share costs one row
per block and round.

Nulls: a null text is empty; a row with a null id neither removes nor loses anything. Rows of one id are one document, in order of their texts. Texts of any
length are whole. No documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _BYTE, documents, minimizers, Rolling, schema_of, to_table
from .passages import ROW_SHIFT, in_blocks, kept_columns, ranges, runs

GRAM = 24
_ROLLING = Rolling()

SAMPLED = "_block int, _rank long, _n int"
AROUND = "_block int, _rank long, _around long, _doc long, _at long, _n int, _place int, _bytes binary"
SETTLED = "_block int, _rank long, _around long, _from int, _to int, _doc long, _at long"


def _rows(table: pa.Table) -> list[tuple[int, int, int, bytes]]:
    """(row, id, base of its places, bytes) of the rows with an id and a text."""
    found = sorted((i, t, k) for k, (i, t) in enumerate(zip(table.column("_id").to_pylist(), table.column("_text").to_pylist())) if i is not None and t)
    out, last, nth = [], None, 0
    for i, t, k in found:
        nth = nth + 1 if i == last else 0
        last = i
        out.append((k, i, nth << ROW_SHIFT, t.encode()))
    return out


class Text:
    """Ranks of one text's bytes."""

    def __init__(self, data: bytes, length: int) -> None:
        self.length = length
        self.sums = _ROLLING.prefix(_BYTE[np.frombuffer(data, np.uint8)])
        self.rank = self.place = self.first = self.last = np.zeros(0, np.int64)
        if len(data) >= length:
            grams = _ROLLING.windows(self.sums, GRAM)
            self.place, self.first, self.last = minimizers(grams, length - GRAM + 1)
            self.rank = grams[self.place].view(np.int64)

    def around(self) -> np.ndarray:
        """Rank of all strings a sampled position stands for, and of its place in them."""
        whole = _ROLLING.spans(self.sums, self.first, self.last + self.length)
        return (whole + (self.place - self.first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _all(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted columns."""
    n = len(keys[0])
    return np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))) if n else np.zeros(0, np.int64)


def _block(table: pa.Table) -> int:
    return table.column("_block")[0].as_py() if table.num_rows else 0


def sampled_of_block(table: pa.Table, length: int) -> pa.Table:
    """The sampled ranks of a block and how often each occurs."""
    ranks, n = np.unique(_all([Text(data, length).rank for _, _, _, data in _rows(table)]), return_counts=True)
    return to_table({"_block": np.full(len(ranks), _block(table)), "_rank": ranks, "_n": n}, SAMPLED)


def around_of_block(table: pa.Table, left: pa.Table, length: int) -> pa.Table:
    """The distinct surroundings of the ranks that are left: first place (of the first string within), number of places, place of the sample, bytes."""
    wanted = np.unique(left.column("_rank").to_numpy())
    parts: list[list[np.ndarray]] = [[] for _ in range(7)]
    texts = _rows(table) if len(wanted) else []
    for k, (_, i, base, data) in enumerate(texts):
        t = Text(data, length)
        hit = _find(wanted, t.rank) >= 0
        if hit.any():
            n = int(hit.sum())
            for part, x in zip(parts, (t.rank[hit], t.around()[hit], np.full(n, i), t.first[hit] + base, (t.place - t.first)[hit], (t.last - t.first)[hit], np.full(n, k))):
                part.append(x)
    rank, around, doc, at, place, more, row = map(_all, parts)
    order = np.lexsort((at, doc, around, rank))
    first = _starts(rank[order], around[order])
    n = np.diff(np.append(first, len(rank)))
    pick = order[first]
    low = (1 << ROW_SHIFT) - 1
    data = [texts[r][3][(a & low) : (a & low) + m + length] for r, a, m in zip(row[pick].tolist(), at[pick].tolist(), more[pick].tolist())]
    return to_table({"_block": np.full(len(pick), _block(table)), "_rank": rank[pick], "_around": around[pick], "_doc": doc[pick], "_at": at[pick], "_n": n, "_place": place[pick],
                     "_bytes": data}, AROUND)


def settle(table: pa.Table, length: int) -> pa.Table:
    """For the surroundings of whole ranks: stretches of their strings (from, to) whose first place is another, with that place."""
    rank, around, doc, at, n, block = (table.column(c).to_numpy() for c in ("_rank", "_around", "_doc", "_at", "_n", "_block"))
    order = np.lexsort((at, doc, around, rank))
    rank, around, doc, at, n, block = (x[order] for x in (rank, around, doc, at, n, block))
    size = np.diff(np.append(_starts(rank), len(rank)))
    first = _starts(rank)
    one = np.repeat(np.minimum.reduceat(around, first) == np.maximum.reduceat(around, first), size) if len(rank) else np.zeros(0, bool)
    data = table.column("_bytes").take(pa.array(order)).to_pylist() if len(order) else []
    strings = np.array([len(d) - length + 1 for d in data], np.int64)
    out: list[list[np.ndarray]] = [[] for _ in range(7)]

    def put(k: np.ndarray, start: np.ndarray, end: np.ndarray, own_doc: np.ndarray, own_at: np.ndarray) -> None:
        for part, x in zip(out, (block[k], rank[k], around[k], start, end, own_doc, own_at)):
            part.append(x)

    whole = np.flatnonzero(one)
    if len(whole):  # all alike: sorted by place within the rank, so the first row of a rank owns all
        own = np.repeat(first, size)[whole]
        others = (own != whole) | (n[whole] > 1)
        put(whole[others], np.zeros(others.sum(), np.int64), strings[whole[others]] - 1, doc[own[others]], at[own[others]])
    rest = np.flatnonzero(~one)
    if len(rest):
        pairs = []
        for k in rest.tolist():
            sums = _ROLLING.prefix(_BYTE[np.frombuffer(data[k], np.uint8)])
            pairs.append(halves(sums, np.arange(strings[k]), length))
        a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        row = np.repeat(rest, strings[rest])
        within = ranges(np.zeros(len(rest), np.int64), strings[rest] - 1)
        place = at[row] + within
        by = np.lexsort((place, doc[row], b, a))
        new = _starts(a[by], b[by])
        count = np.diff(np.append(new, len(by)))
        own = np.empty(len(by), np.int64)
        own[by] = np.repeat(by[new], count)  # for each string the index of the first equal one
        total = np.empty(len(by), np.int64)
        total[by] = np.repeat(np.add.reduceat(n[row[by]], new), count)
        other = (own != np.arange(len(by))) | (n[row] > 1)
        live = np.flatnonzero(other & (total > 1))
        if len(live):
            shift = place[own[live]] - within[live]
            cut = np.concatenate(([True], (np.diff(live) != 1) | (row[live[1:]] != row[live[:-1]]) | (doc[row[own[live[1:]]]] != doc[row[own[live[:-1]]]]) | (np.diff(shift) != 0)))
            head = np.flatnonzero(cut)
            tail = np.append(head[1:], len(live)) - 1
            put(row[live[head]], within[live[head]], within[live[tail]], doc[row[own[live[head]]]], place[own[live[head]]])
    names = [c.split()[0] for c in SETTLED.split(", ")]
    return to_table(dict(zip(names, map(_all, out))), SETTLED)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def halves(sums: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the first and the last half of the strings at these places."""
    half = length - length // 2
    left = _ROLLING.spans(sums, at, at + half)
    return left.view(np.int64), _ROLLING.spans(sums, at + length - half, at + length).view(np.int64)


CUT = "n_bytes long, n_removed long, n_spans long, kept binary, spans array<long>"


def cut_block(table: pa.Table, settled: pa.Table, length: int, keep: list[str], text_col: str) -> pa.Table:
    """Remove from the documents of a block the strings that belong to an earlier place."""
    rank, around, start, end, doc, at = (settled.column(c).to_numpy() for c in ("_rank", "_around", "_from", "_to", "_doc", "_at"))
    order = np.lexsort((start, around, rank))
    rank, around, start, end, doc, at = (x[order].astype(np.int64) for x in (rank, around, start, end, doc, at))
    head = _starts(rank, around)
    tail = np.append(head[1:], len(rank)) - 1
    # a key (rank, around) is found by one number
    ranks, arounds = np.unique(rank), np.unique(around)
    key = np.searchsorted(ranks, rank[head]) * max(len(arounds), 1) + np.searchsorted(arounds, around[head])
    texts = [t.encode() if t else b"" for t in table.column("_text").to_pylist()]
    gone = [None] * len(texts)
    for k, i, base, data in _rows(table) if len(rank) else []:
        t = Text(data, length)
        x, y = _find(ranks, t.rank), _find(arounds, t.around())
        found = np.where((x >= 0) & (y >= 0), _find(key, x * len(arounds) + y), -1)
        mine = np.flatnonzero(found >= 0)
        if not len(mine):
            continue
        part = ranges(head[found[mine]], tail[found[mine]])  # all stretches of each of the text's surroundings
        first = np.repeat(t.first[mine], tail[found[mine]] - head[found[mine]] + 1)
        later = (doc[part] != i) | (at[part] != first + start[part] + base)
        starts = np.zeros(len(data) + 1, np.int32)
        np.add.at(starts, (first + start[part])[later], 1)  # strings from .. to cover from .. to + length - 1
        np.add.at(starts, (first + end[part])[later] + length, -1)
        covered = np.cumsum(starts[:-1]) > 0
        if covered.any():
            gone[k] = covered
    out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "spans": []}
    for data, covered in zip(texts, gone):
        cuts = runs(np.flatnonzero(covered)) if covered is not None else []
        out["n_bytes"].append(len(data))
        out["n_removed"].append(sum(e + 1 - s for s, e in cuts))
        out["n_spans"].append(len(cuts))
        edges = [0, *[v for s, e in cuts for v in (s, e + 1)], len(data)]
        out["kept"].append(b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])]) if cuts else data)
        out["spans"].append(edges[1:-1])
    new = to_table(out, CUT)
    return kept_columns(table, keep, text_col, new)


def remove_repeated_bytes(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, block_bytes: int = 4 << 20) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept (the bytes left) and spans (starts and ends of removed runs, in turn)."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows, blocks = in_blocks(docs, keep, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    by_block = rows.groupBy("_block")
    sampled = by_block.applyInArrow(lambda t: sampled_of_block(t, length), SAMPLED)
    left = sampled.withColumn("_total", F.sum("_n").over(Window.partitionBy("_rank"))).where("_total > 1").select("_block", "_rank")
    around = by_block.cogroup(left.groupBy("_block")).applyInArrow(lambda t, r: around_of_block(t, r, length), AROUND)
    # whole ranks meet, many in each bucket; the number of buckets follows the data
    settled = around.withColumn("_bucket", F.pmod("_rank", F.lit(blocks)).cast("int")).groupBy("_bucket").applyInArrow(lambda t: settle(t, length), SETTLED)
    columns = schema_of(docs.select(*keep), CUT)
    return by_block.cogroup(settled.groupBy("_block")).applyInArrow(lambda t, s: cut_block(t, s, length, keep, text_col), columns)


def op5_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that are left when repeated strings of 100 bytes go."""
    cut = remove_repeated_bytes(documents(spark, sf_dir), ["doc_id"])
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
strings AS (SELECT doc_id, i, CASE WHEN i <= length(h) // 2 - 100 THEN md5(substr(h, 2 * i + 1, 200)) END AS k, substr(h, 2 * i + 1, 2) AS b FROM bytes),
later AS (SELECT doc_id, i, b, CASE WHEN k IS NULL THEN 0 ELSE (row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1)::INT END AS z FROM strings),
covered AS (SELECT doc_id, i, b, max(z) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS z FROM later),
edges AS (SELECT *, z = 1 AND coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 AS starts FROM covered),
cut AS (SELECT doc_id, count(*) AS n, sum(z) AS r, count(*) FILTER (starts) AS s, coalesce(string_agg(b, '' ORDER BY i) FILTER (z = 0), '') AS kept FROM edges GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, CAST(coalesce(s, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
