"""Operator 12: periodic runs of words.

A run of period q is a longest stretch in which words q apart are equal, with q the least such period and max(6, 4 q) words or more. Read from left to right, a text has
a diagonal for each lag d: how many words up to here equal the word d before. A word's earlier occurrences lengthen the diagonals of their lags, all others end,
and one that ends long enough is a run at once.

Few diagonals need to be kept. One of a lag in [B, 2B), B a power of two, must hold through 3B words (5 of lag 1, 6 of lag 2), so it covers 2B + 1 words (5 for lags
up to 3) up to a place that B divides: only there is it opened, for the last earlier occurrence of these words. If that is nearer than B, the stretch has a period
that divides d, and if another one in [B, 2B) lies behind it, so has every stretch of either lag; neither is a run of its own. So one
diagonal for each power of two is open at a time, whatever the words, and a text of n words takes n log n steps.

Words count as equal by their bytes, and occurrences are found by exact numbers for word sequences, not by hashes. Null, empty and blank texts have no words and
no runs. Rows are independent, so repeated rows need no rule; of runs with equal length / period the first is the greatest.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import besides, documents, schema_of, sha256, to_table, with_text, words


def numbered(items: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in items], np.int64)


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal pairs of numbers get equal numbers below the number of pairs."""
    return np.unique(left * (np.int64(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def last_before(names: np.ndarray) -> np.ndarray:
    """Place of the last earlier occurrence of each name, or -1."""
    order = np.argsort(names, kind="stable")
    out = np.full(len(names), -1, np.int64)
    same = names[order[1:]] == names[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


class Diagonals:
    """The open diagonals of one text and the runs found so far."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = ids
        self.runs: dict[tuple[int, int], int] = {}  # (start, end): least period

    def openings(self) -> Iterator[tuple[int, int, int]]:
        """Places at which a diagonal may open, with its lag and the number of words known to be equal there; by rising power of two."""
        ids, n = self.ids, len(self.ids)
        names, width, base, low = ids, 1, 1, 1
        while width < 4:  # names of two, then of four words
            if n <= width:
                return
            names, width = paired(names[:-width], names[width:]), 2 * width
        while True:
            if base == 1:
                low, high, reach, step = 1, 4, 5, 1  # lags 1 to 3 are looked for at every place
            else:
                low, high, reach, step = base, 2 * base, 2 * base + 1, base
            if n < max(reach + low, 4 * low):
                return
            at = paired(names[:-1], names[1:]) if len(names) > 1 else np.zeros(0, np.int64)  # of ``reach`` words, by their first
            before = last_before(at)
            if not (before >= 0).any():
                return  # nothing so long occurs twice
            place = np.arange(len(at))
            lag = place - before
            hit = np.flatnonzero((before >= 0) & (lag >= low) & (lag < high) & ((place + reach - 1) % step == 0))
            yield from zip((hit + reach - 1).tolist(), lag[hit].tolist(), [reach] * len(hit))
            if base == 1:
                base = 4
                if n < 16:
                    return
                names = paired(names[:-4], names[4:])  # of eight words
            else:
                if len(names) <= 2 * base:
                    return
                names = paired(names[: -2 * base], names[2 * base :])
                base *= 2

    def first_difference(self, place: int, lag: int) -> int:
        """The first word from ``place`` on that differs from the one ``lag`` before, or the number of words; in growing steps."""
        ids, n, step = self.ids, len(self.ids), 16
        while place < n:
            end = min(n, place + step)
            differs = ids[place:end] != ids[place - lag : end - lag]
            at = int(differs.argmax())
            if differs[at]:
                return place + at
            place, step = end, 2 * step
        return n

    def first_equal(self, place: int, lag: int) -> int:
        """The first word of the equal words that end at ``place``."""
        ids = self.ids
        while place > lag and ids[place - 1] == ids[place - 1 - lag]:
            place -= 1
        return place

    def find(self) -> list[tuple[int, int, int]]:
        """Runs as (start, length, period), by start, then period."""
        level, end, open_lag = 0, -1, 0
        for place, lag, reach in self.openings():
            if reach != level:
                level, end = reach, -1
            if place < end and (lag == open_lag or reach > 5):
                continue  # its diagonal is open already, or has a divisor of this lag as a period
            first = self.first_equal(place - reach + 1, lag)
            end, open_lag = self.first_difference(place + 1, lag), lag
            start = first - lag
            if end - start >= max(6, 4 * lag):
                self.runs[start, end] = min(lag, self.runs.get((start, end), lag))
        return sorted((start, end - start, q) for (start, end), q in self.runs.items())


def find_runs(items: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs of a sequence of words as (start, length, period)."""
    return Diagonals(numbered(items)).find() if len(items) >= 6 else []


def collapsed(items: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return items
    change = np.zeros(len(items) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [items[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


Source = Callable[[object, str | None], list[bytes]]


def collapse(docs: DataFrame, keep: list[str], *, text_col: str = "text", id_col: str | None = None, source: Source | None = None) -> DataFrame:
    """``keep`` columns, n_words, starts, lengths and periods of all runs, those of the greatest one (start, length, period) and kept_text.

    ``source`` makes a row's words from its id (``id_col``) and text; by default they are the text's own. A kept column
    with the name of a result's gives way to it.
    """
    schema = "n_words long, starts array<long>, lengths array<long>, periods array<long>, start long, length long, period long, kept_text string"
    keep = besides(keep, schema)
    rows, place = with_text(docs, keep, text_col)
    if id_col:
        rows = rows.withColumn("_row_id_", docs[id_col])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            ids = batch.column(batch.num_columns - 1) if id_col else None
            for k, value in enumerate(batch.column(place)):
                text = value.as_py()
                items = source(ids[k].as_py() if id_col else None, text) if source else words(text)
                runs = find_runs(items)
                out["n_words"].append(len(items))
                for i, name in enumerate(("starts", "lengths", "periods")):
                    out[name].append([r[i] for r in runs])
                for name, x in zip(("start", "length", "period"), greatest(runs) or (None, None, None)):
                    out[name].append(x)
                out["kept_text"].append(b" ".join(collapsed(items, runs)).decode())
            new = to_table(out, schema)
            cols = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, *[new.column(n).combine_chunks() for n in names]], names=[*keep, *names])

    return rows.mapInArrow(run, schema_of(docs.select(*keep), schema))


def with_repeats(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text; of one id in ten, from some word on, the first few of the rest over and over (a fixed rule by the id's checksum)."""
    items = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(items), h // 10
    if h % 10 or not n:
        return items
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return items[:a] + [items[a + (i - a) % p] for i in range(a, n)]


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the greatest one, and digests of all runs and of the words left without repeats."""
    found = collapse(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"], id_col="doc_id", source=with_repeats)
    lines = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.select("doc_id", F.size("starts").cast("long").alias("n_runs"), "start", "length", "period",
                        F.floor(F.lit(1000) * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"))


OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
bits AS (SELECT r, doc_id, w, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1))) AS b FROM d),
sums AS (SELECT r, doc_id, w, len(w) AS n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) AS h FROM bits),
parts AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS e FROM sums),
v AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + e)) END]) END AS w FROM parts),
places AS (SELECT r, n, w, unnest(range(0, n - 4)) AS i FROM v WHERE n >= 6),
grams AS (SELECT r, n, i, md5(array_to_string(w[i + 1:i + 5], ' ')) AS g FROM places),
again AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
equal AS (SELECT x.r, x.i, x.i - y.i AS q FROM again x JOIN again y ON x.r = y.r AND x.g = y.g AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM equal),
stretches AS (SELECT r, q, min(i) - q AS s, count(*) + 4 + q AS l FROM islands GROUP BY r, q, k),
runs AS (SELECT r, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l),
digests AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
best AS (SELECT r, s, l, q FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS k FROM runs) WHERE k = 1),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
each AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS x FROM v),
kept AS (SELECT e.r, string_agg(e.x, ' ' ORDER BY e.i) AS t FROM each e ANTI JOIN gone g ON e.r = g.r AND e.i = g.i GROUP BY e.r)
SELECT v.doc_id, coalesce(digests.n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
  sha256(coalesce(digests.lines, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM v LEFT JOIN digests ON v.r = digests.r LEFT JOIN best ON v.r = best.r LEFT JOIN kept ON v.r = kept.r
"""
