"""Operator 8: quality rules as a short-circuit cascade.

Every rule is a test on one text with its own cost. On a sample each rule is run on every text, which gives its time per text and the share it
rejects; the cascade then runs the rules by rejections per second, best first, and leaves a text at the first rule that rejects it. The verdict is that
no rule rejects, so it does not depend on the order or on measured times; only the work does.

Null and empty texts have no words and all counts 0; no rule rejects them (the base test does). Repeated rows are judged one by one; no rows give no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, rows_of, schema_of, to_table, with_text
from .page import Page


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Page], bool]


#: A text goes if a share passes its limit; each compares counts of the whole text.
RULES = [
    Rule("symbols", lambda p: 100 * p.n_symbols > 6 * p.word_chars),
    Rule("capitals", lambda p: p.n_words >= 5 and 2 * p.n_upper > p.n_upper + p.n_lower),
    Rule("exclamations", lambda p: p.n_words >= 5 and 2 * p.n_marks > p.n_words),
    Rule("stutter", lambda p: p.n_words >= 5 and 5 * p.n_adjacent > p.n_words),
    Rule("repeated lines", lambda p: len(p.lines) >= 5 and 2 * p.n_dup_lines > len(p.lines)),
    Rule("few distinct words", lambda p: p.n_words >= 50 and 10 * p.n_distinct_words < p.n_words),
]


def measure(docs: DataFrame, rules: list[Rule] = RULES, *, text_col: str = "text", sample: int = 2000) -> list[dict]:
    """Seconds per text and share rejected of every rule, over about ``sample`` texts drawn with a fixed seed."""
    chosen = docs.select(F.col(text_col).alias("text")).sample(min(1.0, sample / max(rows_of(docs), 1)), seed=7)

    def run(rows: dict) -> dict:
        out = {"rule": [], "seconds": [], "rejected": [], "n": []}
        for i, rule in enumerate(rules):
            pages = [Page(t) for t in rows["text"]]  # anew, so that no rule profits from another's counts
            began = time.perf_counter()
            rejected = sum(rule.rejects(p) for p in pages)
            out["seconds"].append(time.perf_counter() - began)
            out["rule"].append(i)
            out["rejected"].append(rejected)
            out["n"].append(len(pages))
        return out

    got = map_rows(chosen, run, "rule int, seconds double, rejected long, n long").groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "n")]).collect()
    return [{"rule": rules[r["rule"]].name, "index": r["rule"], "seconds": r["seconds"] / max(r["n"], 1), "rejected": r["rejected"] / max(r["n"], 1)} for r in got]


def ordered(rules: list[Rule], stats: list[dict]) -> list[Rule]:
    """Rules by rejections per second; unmeasured ones last."""
    gain = {s["index"]: s["rejected"] / max(s["seconds"], 1e-9) for s in stats}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain.get(i, -1.0), i))]


def cascade(docs: DataFrame, keep: list[str], rules: list[Rule] = RULES, *, text_col: str = "text", sample: int = 2000, base: bool = False) -> DataFrame:
    """``keep`` columns, n_words, passed, rejected_by (null if passed) and n_tested (rules run); with ``base`` also the counts of the base test."""
    order = ordered(rules, measure(docs, rules, text_col=text_col, sample=sample))
    schema = "n_words long, passed boolean, rejected_by string, n_tested int"
    counts = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if base else []
    schema += "".join(f", {c} long" for c in counts)
    columns = schema_of(docs.select(*keep), schema)
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("n_words", "passed", "rejected_by", "n_tested", *counts)}
            for text in batch.column(place).to_pylist():
                page = Page(text)
                tested, by = 0, None
                for rule in order:
                    tested += 1
                    if rule.rejects(page):
                        by = rule.name
                        break
                out["n_words"].append(page.n_words)
                out["passed"].append(by is None)
                out["rejected_by"].append(by)
                out["n_tested"].append(tested)
                for c in counts:
                    out[c].append(getattr(page, c))
            new = to_table(out, schema)
            cols = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, *[new.column(n).combine_chunks() for n in new.schema.names]], names=[*keep, *new.schema.names])

    return rows.mapInArrow(run, columns)


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base test and the cascade's verdict of every document."""
    judged = cascade(documents(spark, sf_dir), ["doc_id"], base=True)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("passed")).alias("kept"))


OP8_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS k FROM windows),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM hashed) WHERE n > 1),
again AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id),
counts AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_distinct(w)) AS n_distinct,
             len(regexp_extract_all(text, '[A-Z]')) AS upper, len(regexp_extract_all(text, '[a-z]')) AS lower, len(regexp_extract_all(text, '[!?]')) AS marks,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS adjacent FROM d LEFT JOIN again a ON a.doc_id = d.doc_id),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             100 * n_symbols > 6 * word_chars OR (n_words >= 5 AND 2 * upper > upper + lower) OR (n_words >= 5 AND 2 * marks > n_words) OR (n_words >= 5 AND 5 * adjacent > n_words)
             OR (n_lines >= 5 AND 2 * n_dup_lines > n_lines) OR (n_words >= 50 AND 10 * n_distinct < n_words) AS rejected FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM judged
"""
