"""Operator 6: a quality classifier from pairwise preferences (Bradley-Terry).

A document's merit is linear in features of its text. The chance that one document is preferred to another is the logistic function of the
difference of their merits, so the weights come from the logistic loss on feature differences of all pairs of one good and one bad labelled document. The cut
is the merit's quantile at the labelled share of bad documents; the score is the logistic function of merit minus cut, shifted so that
the cut scores ``threshold``.

All labelled documents are used. A Newton step takes one pass over their features: documents of one label whose merits lie within a sixteenth of a unit share a
cell, and sums over cells, whose number is bounded, give the loss of all pairs, each document standing at the mean merit of its cell. Only those sums reach the
driver. The ends to which features are cut and the cut itself are exact quantiles over all labelled documents. Null and
empty texts have features of an empty text and are scored. A label without a document, or a null label, is left out; of several labels of one id the
smallest counts. Without labels of both kinds every document scores 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.groups import exact_quantiles
from ..session import checkpointed
from .common import documents, schema_of, with_text
from .page import Page

FEATURES = ["length", "symbols", "capitals", "marks", "stops", "repeated lines", "repeated words", "stutter", "word length", "distinct", "digits", "line length"]


def features(text: str | None) -> list[float]:
    """Shares of the whole text, most of them bent so that small values tell apart more than large ones."""
    p = Page(text)
    n, chars, lines, letters = max(p.n_words, 1), max(p.word_chars, 1), max(len(p.lines), 1), max(p.n_upper + p.n_lower, 1)
    bend = lambda x, c: x / (x + c)
    return [math.log1p(p.n_words), bend(p.n_symbols / chars, 0.05), bend(p.n_upper / letters, 0.2), bend(p.n_marks / n, 0.2), bend(p.n_stops / n, 0.2),
            bend(p.n_dup_lines / lines, 0.3), bend(p.n_repeat_words / n, 0.3), bend(p.n_adjacent / n, 0.1), p.word_chars / n, p.n_distinct_words / n,
            bend(p.n_digits / chars, 0.1), math.log1p(n / lines)]


@dataclass(frozen=True)
class Model:
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    threshold: float
    fitted: bool = True

    def merit(self, x: np.ndarray) -> np.ndarray:
        return (np.clip(x, self.low, self.high) - self.centre) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        shift = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.merit(x) - self.cut + shift, -30, 30)))


#: Cells of merit to a unit, and the merit beyond which all share one cell.
CELLS, FAR = 16, 40
_UPPER = np.triu_indices(len(FEATURES))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _standard(column: pa.Array, model: Model) -> np.ndarray:
    return (np.clip(_matrix(column), model.low, model.high) - model.centre) / model.scale


def cell_sums(rows: DataFrame, model: Model) -> DataFrame:
    """Per label and cell of merit: documents, and sums of their standard features and of the products of those; ``rows``: x, good.

    A task adds up its rows first, so it gives no more rows than there are cells, and so does the whole.
    """
    names = ["n", *[f"z{i}" for i in range(len(FEATURES))], *[f"q{i}" for i in range(len(_UPPER[0]))]]
    edge = CELLS * FAR
    schema = "good boolean, cell int, " + ", ".join(f"{c} double" for c in names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2 * (2 * edge + 1), len(names)))
        for b in batches:
            z = _standard(b.column(0), model)
            cell = np.clip(np.floor(z @ model.weights * CELLS), -edge, edge).astype(int) + edge
            key = 2 * cell + np.array(b.column(1).to_pylist(), int)
            values = np.concatenate((np.ones((len(z), 1)), z, z[:, _UPPER[0]] * z[:, _UPPER[1]]), axis=1)
            order = np.argsort(key, kind="stable")
            if len(order):
                found, start = np.unique(key[order], return_index=True)
                sums[found] += np.add.reduceat(values[order], start, axis=0)
        at = np.flatnonzero(sums[:, 0])
        if len(at):
            columns = [pa.array(at % 2 == 1), pa.array(at // 2 - edge, pa.int32()), *[pa.array(sums[at, i]) for i in range(len(names))]]
            yield pa.RecordBatch.from_arrays(columns, names=["good", "cell", *names])

    return rows.mapInArrow(run, schema).groupBy("good", "cell").agg(*[F.sum(c).alias(c) for c in names])


def newton_step(good: np.ndarray, bad: np.ndarray, weights: np.ndarray, ridge: float) -> np.ndarray:
    """The step on the logistic loss over all pairs of a good and a bad document, from the sums of their cells (see ``cell_sums``)."""
    k = len(FEATURES)

    def parts(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        square = np.zeros((len(sums), k, k))
        square[:, _UPPER[0], _UPPER[1]] = square[:, _UPPER[1], _UPPER[0]] = sums[:, 1 + k :]
        n, z = sums[:, 0], sums[:, 1 : 1 + k]
        return n, z, square, z @ weights / n

    (n, z, square, merit), (m, y, other, below) = parts(good), parts(bad)
    pairs = n.sum() * m.sum()
    wrong = 1 / (1 + np.exp(np.clip(merit[:, None] - below[None, :], -30, 30)))  # chance of the wrong order
    gradient = (z.T @ (wrong @ m) - y.T @ (wrong.T @ n)) / pairs - ridge * weights
    curve = wrong * (1 - wrong)
    mixed = z.T @ curve @ y
    hessian = np.tensordot(curve @ m, square, 1) + np.tensordot(curve.T @ n, other, 1) - mixed - mixed.T
    return np.linalg.solve(hessian / pairs + ridge * np.eye(k), gradient)


def fit(rows: DataFrame, *, threshold: float, ridge: float = 1e-3, steps: int = 30) -> Model:
    """Newton steps on the logistic loss over all pairs; ``rows``: x, good of every labelled document."""
    k = len(FEATURES)
    count = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return Model(np.zeros(k), np.ones(k), np.zeros(k), np.ones(k), np.zeros(k), 0.0, threshold, False)
    ends = exact_quantiles(rows.select(F.posexplode("x").alias("f", "v")), ["f"], "v", {"low": 0.005, "high": 0.995}).collect()
    low, high = (np.array([r[c] for r in sorted(ends, key=lambda r: r["f"])]) for c in ("low", "high"))
    clipped = [F.least(F.greatest(F.col("x")[i], F.lit(float(low[i]))), F.lit(float(high[i]))) for i in range(k)]
    facts = rows.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(clipped)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(clipped)]).first()
    centre, scale = (np.array([facts[f"{c}{i}"] for i in range(k)]).round(12) for c in "as")
    model = Model(low, high, centre, np.where(scale > 1e-9, scale, 1.0), np.zeros(k), 0.0, threshold)
    for _ in range(steps):
        sums = cell_sums(rows, model).orderBy("good", "cell").collect()
        good, bad = (np.array([r[2:] for r in sums if r["good"] == side]) for side in (True, False))
        step = newton_step(good, bad, model.weights, ridge)
        model = replace(model, weights=model.weights + step)
        if np.abs(step).max() < 1e-4:
            break
    model = replace(model, weights=model.weights.round(9))  # the order of arrival must not matter

    def merits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(b.num_rows, np.int32)), pa.array(_standard(b.column(0), model) @ model.weights)], names=["all", "merit"])

    middle = (count[False] - 0.5) / (count[True] + count[False] - 1)  # between the last of as many as are bad and the next
    cut = exact_quantiles(rows.select("x").mapInArrow(merits, "all int, merit double"), ["all"], "merit", {"cut": middle}).first()["cut"]
    return replace(model, cut=float(cut))


def text_features(docs: DataFrame, keep: list[str], *, text_col: str = "text") -> DataFrame:
    """``keep`` columns and x, the features of every text."""
    columns = schema_of(docs.select(*keep), "x array<double>")
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(t) for t in b.column(place).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], x], names=[*keep, "x"])

    return rows.mapInArrow(run, columns)


def labelled(found: DataFrame, labels: DataFrame, use: Column) -> DataFrame:
    """x and good of every labelled document; ``found``: doc_id and x, ``use`` picks rows of ``labels`` (doc_id, label)."""
    chosen = labels.where(use & F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    return checkpointed(found.join(chosen, "doc_id").select("x", (F.col("label").cast("int") > 0).alias("good")))


def labelled_features(docs: DataFrame, labels: DataFrame, use: Column) -> DataFrame:
    """The same from ``docs`` (doc_id, text). Features meet the labels, a hundred bytes a document, so no text is moved."""
    return labelled(text_features(docs, ["doc_id"]), labels, use)


def train(docs: DataFrame, labels: DataFrame, use: Column, *, threshold: float = 0.3) -> Model:
    """``docs``: doc_id and text; ``labels``: doc_id and label (1 good)."""
    return fit(labelled_features(docs, labels, use), threshold=threshold)


def score(docs: DataFrame, keep: list[str], model: Model, *, text_col: str = "text") -> DataFrame:
    """``keep`` columns and the score of every text."""
    columns = schema_of(docs.select(*keep), "score double")
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(place).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(model.score(x))], names=[*keep, "score"])

    return rows.mapInArrow(run, columns)


def score_features(found: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """``keep`` columns and the score of every row of ``found`` (with x, see ``text_features``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(model.score(_matrix(b.column(len(keep)))))], names=[*keep, "score"])

    return found.select(*keep, "x").mapInArrow(run, schema_of(found.select(*keep), "score double"))


def op6_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Labels of the query, and which of them are learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def op6_model(spark: SparkSession, sf_dir: str) -> Model:
    return train(documents(spark, sf_dir).select("doc_id", "text"), *op6_labels(spark, sf_dir))


def op6_preference_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows of one residue of the id's checksum are held out of fitting. Features are computed once, for fitting and for scoring."""
    found = checkpointed(text_features(documents(spark, sf_dir), ["doc_id"]))
    scored = score_features(found, ["doc_id"], fit(labelled(found, *op6_labels(spark, sf_dir)), threshold=0.3))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
