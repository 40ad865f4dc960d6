"""Operator 1: remove repeated passages with automata of recurring phrases.

A word goes if a window of ``window`` words that covers it also starts in a document of smaller id. Documents live in blocks of bounded size, by a hash of
their id.

1. Every window holds the least of its short phrases' hashes, its anchor. Anchors are combined within each block, and those that two documents
   share are found by the anchor's hash over all blocks.
2. Windows with such an anchor are hashed whole, combined within each block, and compared over all blocks: a window of two documents is
   confirmed, and its first place (smallest id) owns it. Every block with a later copy asks the owner's block for the passage, and runs of owned
   windows come back as words, in pieces of bounded length.
3. Each block is a shard: its passages are cut into phrases such that every window holds one, the phrases are compiled into an Aho-Corasick automaton,
   and all documents of the block stream through it. Each hit is compared word by word in both directions, and stretches of at least ``window`` words are
   removed.

A passage that many documents share costs one row per block in each step, never one per document or pair. Hashes only route; words are compared as such.

Nulls: a null text has no words; a row with a null id neither removes nor loses anything. Rows of one id count as one document. Texts of
any length are whole; fewer than ``window`` words never match. No documents give no rows.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, minimizers, Rolling, schema_of, small_batches, to_table, word_hashes, words

GRAM = 10  # words of an anchor
PHRASE = 16  # words of an automaton's phrase
PIECE = 400  # windows of a passage in one row
ROW_SHIFT = 40  # places of the k-th row of an id start at k * 2^40
_ROLLING = Rolling()


def in_blocks(docs: DataFrame, keep: list[str], *, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """``keep`` columns but the text, _id, _text and _block, with blocks of about ``block_bytes`` of text by the id's hash; and the number of blocks."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    place = F.coalesce(F.xxhash64(F.col(id_col).cast("long")), F.lit(0))
    place = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(place)  # rows without id need not meet
    small_batches(docs.sparkSession)
    rest = [c for c in keep if c != text_col]  # the text travels once
    return docs.select(*rest, F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.pmod(place, F.lit(blocks)).cast("int").alias("_block")), blocks


def block_rows(table: pa.Table) -> list[tuple[int, int, str]]:
    """(id, place of the row's start, text) of the rows with id and text; rows of one id in order of their texts."""
    rows = sorted((i, t) for i, t in zip(table.column("_id").to_pylist(), table.column("_text").to_pylist()) if i is not None and t)
    out, last, k = [], None, 0
    for i, t in rows:
        k = k + 1 if i == last else 0
        last = i
        out.append((i, k << ROW_SHIFT, t))
    return out


def least_and_most(keys: np.ndarray, ids: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each distinct key: the key, its smallest (id, more...) and its largest id."""
    if not len(keys):
        return (keys, ids, *more, ids)
    order = np.lexsort((*more[::-1], ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    last = np.append(first[1:], len(keys)) - 1
    return (keys[first], ids[first], *[m[order][first] for m in more], ids[last])


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)


def _anchors(text: str, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hash sums, and the anchors with the first and last window each one rules."""
    hashes = word_hashes(text.encode(), _ROLLING)
    sums = _ROLLING.prefix(hashes)
    grams = _ROLLING.windows(sums, GRAM)
    place, first, last = minimizers(grams, window - GRAM + 1) if len(hashes) >= window else (np.zeros(0, np.int64),) * 3
    return hashes, sums, grams[place].view(np.int64), first, last


ANCHORS = "_block int, _anchor long, _first long, _last long"
WINDOWS = "_block int, _window long, _first long, _at long, _last long"
PASSAGES = "_block int, _owner long, _words binary"


def anchors_of_block(table: pa.Table, window: int) -> pa.Table:
    keys, ids = [], []
    for i, _, text in block_rows(table):
        anchor = _anchors(text, window)[2]
        keys.append(anchor)
        ids.append(np.full(len(anchor), i))
    key, first, last = least_and_most(_joined(keys, np.int64), _joined(ids, np.int64))
    block = table.column("_block")[0].as_py() if table.num_rows else 0
    return to_table({"_block": np.full(len(key), block), "_anchor": key, "_first": first, "_last": last}, ANCHORS)


def windows_of_block(table: pa.Table, shared: pa.Table, window: int) -> pa.Table:
    """Hashes of the windows whose anchor is shared, each with its first place in the block and the block's last id."""
    wanted = np.sort(shared.column("_anchor").to_numpy())
    keys, ids, places = [], [], []
    if len(wanted):
        for i, base, text in block_rows(table):
            _, sums, anchor, first, last = _anchors(text, window)
            if not len(anchor):
                continue
            hit = np.minimum(np.searchsorted(wanted, anchor), len(wanted) - 1)
            hit = wanted[hit] == anchor
            if hit.any():
                at = ranges(first[hit], last[hit])
                keys.append(_ROLLING.windows(sums, window)[at].view(np.int64) if len(sums) > window else np.zeros(0, np.int64))
                ids.append(np.full(len(at), i))
                places.append(at + base)
    key, first, at, last = least_and_most(_joined(keys, np.int64), _joined(ids, np.int64), _joined(places, np.int64))
    block = table.column("_block")[0].as_py() if table.num_rows else 0
    return to_table({"_block": np.full(len(key), block), "_window": key, "_first": first, "_at": at, "_last": last}, WINDOWS)


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first .. last."""
    size = last - first + 1
    return np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Sorted distinct numbers as ranges of consecutive ones, last included."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    return list(zip(places[np.concatenate(([0], cut + 1))].tolist(), places[np.append(cut, len(places) - 1)].tolist()))


def passages_of_block(table: pa.Table, asked: pa.Table, window: int) -> pa.Table:
    """The words of the asked windows of the block's documents, for each asking block."""
    out: dict[str, list] = {"_block": [], "_owner": [], "_words": []}
    if asked.num_rows:
        to, owner, at = (asked.column(c).to_numpy() for c in ("_to", "_owner", "_at"))
        order = np.lexsort((at, to, owner))
        to, owner, at = to[order], owner[order], at[order]
        texts = {(i, base): t for i, base, t in block_rows(table)}
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (to[1:] != to[:-1])))
        start = np.flatnonzero(new)
        split: tuple[tuple[int, int] | None, list[bytes]] = (None, [])
        for a, b in zip(start.tolist(), np.append(start[1:], len(at)).tolist()):
            for s, e in runs(np.unique(at[a:b])):
                key = (int(owner[a]), s >> ROW_SHIFT << ROW_SHIFT)
                if split[0] != key:
                    split = (key, words(texts[key]))
                s, e = s - key[1], e - key[1]
                for p in range(s, e + 1, PIECE):
                    out["_block"].append(int(to[a]))
                    out["_owner"].append(key[0])
                    out["_words"].append(b" ".join(split[1][p : min(p + PIECE, e + 1) + window - 1]))
    return to_table(out, PASSAGES)


class Shard:
    """The automaton of a block's passages."""

    def __init__(self, owners: list[int], texts: list[bytes], window: int) -> None:
        self.owners, self.window = owners, window
        self.words = [t.split() for t in texts]
        self.hashes = [word_hashes(t, _ROLLING) for t in texts]
        found: dict[str, list[tuple[int, int]]] = {}
        step = window - PHRASE + 1  # every window holds a whole phrase that starts at a multiple of this
        for p, w in enumerate(self.words):
            for o in range(0, len(w) - PHRASE + 1, step):
                found.setdefault(" " + b" ".join(w[o : o + PHRASE]).decode() + " ", []).append((p, o))
        self.automaton = ahocorasick.Automaton()
        for phrase, places in found.items():
            self.automaton.add_word(phrase, places)
        self.automaton.make_automaton()

    def covered(self, doc_id: int, text: str, doc_words: list[bytes]) -> np.ndarray:
        """Which words of a document stand in a stretch of ``window`` or more words shared with a passage of a smaller id."""
        n = len(doc_words)
        gone = np.zeros(n, bool)
        if n < self.window:
            return gone
        line = " " + b" ".join(doc_words).decode() + " "
        hits = list(self.automaton.iter(line))
        if not hits:
            return gone
        starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in (line[1:-1].split(" "))]))) + 1  # where each word begins in the line
        first_word = np.searchsorted(starts, [e for e, _ in hits]).tolist()  # the word after the phrase's closing space
        hashes = word_hashes(text.encode(), _ROLLING)
        done: dict[tuple[int, int], int] = {}
        for after, (_, places) in zip(first_word, hits):
            i = after - PHRASE
            for p, o in places:
                if self.owners[p] >= doc_id:
                    continue
                diagonal = i - o
                if done.get((p, diagonal), -1) > i:
                    continue
                low, high = max(0, diagonal), min(n, diagonal + len(self.words[p]))
                unequal = np.flatnonzero(hashes[low:high] != self.hashes[p][low - diagonal : high - diagonal]) + low
                k = int(np.searchsorted(unequal, i))
                a = int(unequal[k - 1]) + 1 if k else low
                b = int(unequal[k]) if k < len(unequal) else high
                done[p, diagonal] = b
                if b - a >= self.window and doc_words[a:b] == self.words[p][a - diagonal : b - diagonal]:
                    gone[a:b] = True
        return gone


def kept_columns(table: pa.Table, keep: list[str], text_col: str, new: pa.Table) -> pa.Table:
    """The columns asked for, the text among them, followed by new ones."""
    return pa.Table.from_arrays([*[table.column("_text" if c == text_col else c) for c in keep], *new.columns], names=[*keep, *new.schema.names])


def cut_block(table: pa.Table, passages: pa.Table, window: int, keep: list[str], text_col: str) -> pa.Table:
    """Stream the documents of a block through its automaton and drop what is covered."""
    shard = Shard(passages.column("_owner").to_pylist(), passages.column("_words").to_pylist(), window) if passages.num_rows else None
    n_words, n_removed, kept, spans = [], [], [], []
    for i, text in zip(table.column("_id").to_pylist(), table.column("_text").to_pylist()):
        w = words(text)
        gone = shard.covered(i, text, w) if shard and i is not None and text else np.zeros(len(w), bool)
        n_words.append(len(w))
        n_removed.append(int(gone.sum()))
        kept.append((b" ".join([x for x, g in zip(w, gone.tolist()) if not g]) if n_removed[-1] else b" ".join(w)).decode())
        spans.append([v for s, e in runs(np.flatnonzero(gone)) for v in (s, e + 1)])
    new = to_table({"n_words": n_words, "n_removed": n_removed, "kept_text": kept, "spans": spans}, CUT)
    return kept_columns(table, keep, text_col, new)


CUT = "n_words long, n_removed long, kept_text string, spans array<long>"


def remove_repeats(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text", window: int = 50, block_bytes: int = 4 << 20) -> DataFrame:
    """``keep`` columns, n_words, n_removed, kept_text (kept words joined by a space) and spans (starts and ends of removed words, in turn)."""
    if window < PHRASE or window < GRAM:
        raise ValueError(f"window must be at least {PHRASE}")
    rows, blocks = in_blocks(docs, keep, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    by_block = rows.groupBy("_block")
    anchors = by_block.applyInArrow(lambda t: anchors_of_block(t, window), ANCHORS)
    same = Window.partitionBy("_anchor")
    shared = anchors.withColumn("_a", F.min("_first").over(same)).withColumn("_z", F.max("_last").over(same)).where("_a < _z").select("_block", "_anchor")
    windows = by_block.cogroup(shared.groupBy("_block")).applyInArrow(lambda t, s: windows_of_block(t, s, window), WINDOWS)
    same = Window.partitionBy("_window")
    owned = windows.withColumn("_own", F.min(F.struct("_first", "_at")).over(same)).where(F.col("_last") > F.col("_own._first"))
    asked = owned.select(F.col("_block").alias("_to"), F.col("_own._first").alias("_owner"), F.col("_own._at").alias("_at"))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("_owner"), F.lit(blocks)).cast("int"))
    passages = by_block.cogroup(asked.groupBy("_block")).applyInArrow(lambda t, a: passages_of_block(t, a, window), PASSAGES)
    columns = schema_of(docs.select(*keep), CUT)
    return by_block.cogroup(passages.groupBy("_block")).applyInArrow(lambda t, p: cut_block(t, p, window, keep, text_col), columns)


def op1_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left when repeated passages of 50 words go."""
    cut = remove_repeats(documents(spark, sf_dir), ["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM starts),
owner AS (SELECT k, min(doc_id) AS first_id FROM hashed GROUP BY k),
gone AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 50)) AS j FROM hashed h JOIN owner USING (k) WHERE first_id < h.doc_id),
kept AS (SELECT a.doc_id, sha256(string_agg(a.x, ' ' ORDER BY a.j)) AS kept_sha256 FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) a
         ANTI JOIN gone ON gone.doc_id = a.doc_id AND gone.j = a.j GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.c, 0) AS BIGINT) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
