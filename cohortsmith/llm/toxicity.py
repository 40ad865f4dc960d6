"""Operator 3: toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

Terms carry marks for their start and end, so that a landmark may be a whole term or the start of terms. The kernel of two strings sums, over all subsequences of ``ORDER`` characters they share, a decay to the power of the lengths they
span in both, and is normalised to 1 for equal strings and squared (a product of kernels is one); an insult with inserted or dropped characters stays close to the insult itself. Landmarks are the terms that
divide toxic from other labelled documents best, counted over all of these. A sentence is the largest kernel value of its terms with each landmark, mapped by
the inverse root of the landmarks' kernel matrix; a squared-hinge SVM is fitted on labelled sentences (those of each labelled document
that are closest to the landmarks, or an empty one, with the document's label). A document's score is a logistic function, fitted on the same documents, of the margins of its worst three
sentences and of its nearness to each landmark, at most and in all, so that one sure term counts more than several doubtful ones.

A term of more than ``LONG`` characters is taken as overlapping windows of that size, so a word of any length takes bounded memory, and all of it is read.

Two shortcuts belong to the feature, not to the data: a kernel value below ``FLOOR`` counts as 0, and a term is compared with a landmark only if it
holds at least half of the landmark's letter pairs, in order, with at most two characters between.

At most ``sample`` labelled documents are used for fitting the SVM (their landmark values reach the driver, not their texts). Null and empty texts have
no term and score as a sentence without any. Null labels, and labels without a document, are left out; of several labels of an id the largest counts. Without labels of both
kinds, or without landmarks, every document scores 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, schema_of, to_table, with_text

ORDER, DECAY, FLOOR, REACH, POWER = 3, 0.8, 0.6, 3, 2
_SENTENCE = re.compile(r"[.!?]+[\x20\x09-\x0D]+|\n+")
START, END, WORST = "\x02", "\x03", 3
_EDGE = "\x00\x01.,;:!?\"'()[]{}<>|*#$%&-_/\\~`^=+"
MEMORY = 500_000


def terms(sentence: str) -> list[str]:
    """Lower-cased words without marks of punctuation at their ends; a word with other characters within is joined by its letters alone as one more term, as are runs of single characters; a long term is all of its windows."""
    out, run = [], []
    for w in sentence.lower().encode().split():
        t = w.decode().strip(_EDGE)
        if len(t) == 1:
            run.append(t)
            continue
        if len(run) > 2:
            out.append(START + "".join(run) + END)
        run = []
        if t:
            out.append(START + t + END)
            if not t.isalpha():
                letters = "".join(filter(str.isalpha, t))
                if len(letters) > 2:
                    out.append(START + letters + END)
    if len(run) > 2:
        out.append(START + "".join(run) + END)
    if any(len(t) > LONG for t in out):
        out = [w for t in out for w in _windows(t)]
    return out


#: A longer term is seen through windows of this many characters, each half over the one before: encoded data and the like.
LONG = 64


def _windows(term: str) -> list[str]:
    if len(term) <= LONG:
        return [term]
    return [term[a : a + LONG] for a in range(0, len(term) - LONG // 2, LONG // 2)]


def _codes(strings: list[str]) -> np.ndarray:
    """Code points, one row per string, padded with 0."""
    width = max([1, *map(len, strings)])
    flat = np.frombuffer("".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(strings), width)


def kernel(s: list[str], t: list[str]) -> np.ndarray:
    """Unnormalised subsequence kernel of the pairs (s[i], t[i]), by the usual recursion over prefixes, for all pairs at once."""
    if not s:
        return np.zeros(0)
    a, b = _codes(s), _codes(t)
    n, la, lb = len(s), a.shape[1], b.shape[1]
    total = np.zeros(n)
    # held[p][:, j]: subsequences of p characters in the prefixes so far, weighted by their stretch to the prefixes' ends
    held = [np.ones((n, lb + 1))] + [np.zeros((n, lb + 1)) for _ in range(ORDER - 1)]
    for i in range(la):
        here = a[:, i : i + 1]
        same = ((here == b) & (here != 0)).astype(float)
        total += (same * held[ORDER - 1][:, :-1]).sum(1) * DECAY**2
        new = [held[0]]
        for p in range(1, ORDER):
            add = same * held[p - 1][:, :-1] * DECAY**2
            row = np.zeros((n, lb + 1))
            for j in range(lb):
                row[:, j + 1] = DECAY * row[:, j] + add[:, j]
            new.append(DECAY * held[p] + row)
        held = new
    return total


class Landmarks:
    """Kernel values of terms with a fixed list of terms, kept in a bounded memory."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.own = np.sqrt(np.maximum(kernel(names, names), 1e-300)) if names else np.zeros(0)
        self.known: dict[str, np.ndarray | None] = {}
        # one bit for each letter pair of each landmark, in as many 64-bit words as that takes
        pairs = [(k, x, y) for k, name in enumerate(names) for x, y in zip(name, name[1:])]
        self.width = -(-max(len(pairs), 1) // 64)
        self.table = np.zeros((self.width, 1 << 14), np.uint64)
        self.need: list[tuple[np.ndarray, int]] = [(np.zeros(self.width, np.uint64), (len(n) - 1 + 1) // 2) for n in names]
        for bit, (k, x, y) in enumerate(pairs):
            word, one = divmod(bit, 64)
            self.table[word, self._slot(np.array([ord(x)]), np.array([ord(y)]))[0]] |= np.uint64(1 << one)
            self.need[k][0][word] |= np.uint64(1 << one)

    @staticmethod
    def _slot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """A pair's place in the table; pairs of letters a-z have places of their own, others may share."""
        return (x % 128).astype(np.int64) * 128 + (y % 128)

    def candidates(self, strings: list[str]) -> np.ndarray:
        """Whether string i holds at least half of landmark k's letter pairs."""
        out = np.zeros((len(strings), len(self.names)), bool)
        order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
        for a in range(0, len(order), 4096):  # strings of like length together
            part = order[a : a + 4096]
            c = _codes([strings[i] for i in part])
            bits = np.zeros((self.width, len(part)), np.uint64)
            for gap in range(1, REACH + 1):
                if c.shape[1] > gap:
                    slot = self._slot(c[:, :-gap], c[:, gap:])
                    for w in range(self.width):
                        bits[w] |= np.bitwise_or.reduce(self.table[w][slot], axis=1)
            for k, (mask, least) in enumerate(self.need):
                got = sum(np.bitwise_count(bits[w] & mask[w]).astype(int) for w in range(self.width))
                out[part, k] = got >= least
        return out

    def learn(self, strings: list[str]) -> None:
        if len(self.known) + len(strings) > MEMORY:
            self.known.clear()
        i, k = np.nonzero(self.candidates(strings))
        self.known.update(dict.fromkeys(strings))
        if not len(i):
            return
        order = np.argsort([len(strings[x]) for x in i], kind="stable")
        i, k = i[order], k[order]
        for a in range(0, len(i), 20_000):
            x, y = i[a : a + 20_000], k[a : a + 20_000]
            ss, ts = [strings[v] for v in x], [self.names[v] for v in y]
            value = kernel(ss, ts) / np.sqrt(np.maximum(kernel(ss, ss), 1e-300)) / self.own[y]
            for v, w, z in zip(x.tolist(), y.tolist(), value.tolist()):
                if z >= FLOOR:
                    row = self.known[strings[v]]
                    if row is None:
                        row = self.known[strings[v]] = np.zeros(len(self.names))
                    row[w] = min(z, 1.0) ** POWER

    def sentences(self, texts: list[str | None]) -> list[list[np.ndarray]]:
        """For each text, the values of those of its sentences that have a term near a landmark."""
        split = [[terms(s) for s in _SENTENCE.split(t)] if t else [] for t in texts]
        new = {t for text in split for s in text for t in s}.difference(self.known)
        # asked for by size, so that a batch with more terms than the memory holds is done in parts
        if len(new) > MEMORY // 2 and len(texts) > 1:
            half = len(texts) // 2
            return self.sentences(texts[:half]) + self.sentences(texts[half:])
        self.learn(sorted({t for text in split for s in text for t in s}) if len(self.known) + len(new) > MEMORY else sorted(new))
        get = self.known.get
        out = []
        for text in split:
            rows = []
            for s in text:
                near = [v for v in map(get, s) if v is not None]
                if near:
                    rows.append(np.max(near, axis=0) if len(near) > 1 else near[0])
            out.append(rows)
        return out


_landmarks: dict[tuple[str, ...], Landmarks] = {}


def landmarks_of(names: tuple[str, ...]) -> Landmarks:
    """One table per worker process and list."""
    if names not in _landmarks:
        _landmarks[names] = Landmarks(list(names))
    return _landmarks[names]


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    weights: np.ndarray  # on landmark values, the Nystroem map included
    bias: float
    curve: np.ndarray  # on the worst margins, the nearness to each landmark, and 1

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        """Margins of the worst sentences, largest first; sentences without a near term have the bias."""
        best = sorted((float(r @ self.weights) for r in rows), reverse=True)[:WORST]
        return np.maximum(np.array(best + [0.0] * (WORST - len(best))), 0.0) + self.bias

    def score(self, rows: list[np.ndarray]) -> float:
        if not self.names:
            return 0.0
        x = np.concatenate([self.margins(rows), nearness(rows, len(self.names)), [1.0]])
        return float(1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30))))


def nearness(rows: list[np.ndarray], size: int, most: float = 4.0) -> np.ndarray:
    """Of a document's sentences, the largest value with each landmark and their sum up to ``most``, as a share of it."""
    if not rows:
        return np.zeros(2 * size)
    values = np.array(rows)
    return np.concatenate([values.max(0), np.minimum(values.sum(0), most) / most])


def _svm(z: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps, the two classes weighing the same; ``share`` weighs rows within a class."""
    x = np.hstack([z, np.ones((len(z), 1))])
    c = share * np.where(y > 0, 0.5 / share[y > 0].sum(), 0.5 / share[y < 0].sum()) * cost
    w = np.zeros(x.shape[1])
    keep = np.append(np.ones(z.shape[1]), 1e-6)
    for _ in range(100):
        gap = np.maximum(0, 1 - y * (x @ w))
        active = gap > 0
        gradient = keep * w - 2 * x.T @ (c * y * gap)
        hessian = np.diag(keep) + 2 * (x[active] * c[active][:, None]).T @ x[active]
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, toxic: np.ndarray, ridge: float = 0.03, gain: float = 3.0) -> np.ndarray:
    """A toxic document weighs ``gain`` times as much as another: it is the rarer class and its labels miss some."""
    c = np.where(toxic > 0, gain, 1.0)
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (c * (p - toxic)) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(names: tuple[str, ...], found: list[list[np.ndarray]], near: np.ndarray, toxic: np.ndarray, *, cost: float = 1e4) -> Model:
    """From the landmark values of each labelled document's sentences and its nearness to the landmarks."""
    if not names or not toxic.any() or toxic.all():
        return Model((), np.zeros(0), 0.0, np.zeros(0))
    left = [a for a in names for _ in names]
    matrix = kernel(left, list(names) * len(names)).reshape(len(names), -1)
    own = np.sqrt(np.diag(matrix))
    matrix = (matrix / own[:, None] / own[None, :]) ** POWER
    value, vector = np.linalg.eigh(matrix)
    root = vector / np.sqrt(np.maximum(value, 1e-2)) @ vector.T
    # every document weighs the same, whatever the number of its sentences
    rows = [(r, y, 1 / max(len(own), 1)) for own, y in zip(found, toxic) for r in (own or [np.zeros(len(names))])]
    w, bias = _svm(np.array([r for r, _, _ in rows]) @ root, np.array([1.0 if y else -1.0 for _, y, _ in rows]), np.array([s for _, _, s in rows]), cost)
    model = Model(names, root @ w, bias, np.zeros(0))
    x = np.hstack([np.array([model.margins(rows) for rows in found]), near])
    return Model(names, model.weights, bias, _logistic(x, toxic.astype(float)))


def _starts(text: str | None) -> set[str]:
    """The distinct terms of a text and their starts of 4 to 8 characters."""
    out = set()
    for t in set(terms(text or "")):
        if 6 <= len(t) <= 18:
            out.add(t)
        out.update(t[:n] for n in range(5, min(10, len(t) - 1)))
    return out


def spread_out(ranked: list[str], count: int, alike: float = 0.65) -> tuple[str, ...]:
    """The first ``count`` names, leaving out those very like one already taken."""
    taken: list[str] = []
    for name in ranked:
        if len(taken) >= count:
            break
        if taken:
            n = len(taken)
            value = kernel([name] * n, taken) / np.sqrt(kernel([name], [name])[0] * kernel(taken, taken))
            if value.max() > alike:
                continue
        taken.append(name)
    return tuple(taken)


def choose_landmarks(texts: DataFrame, *, count: int = 48) -> tuple[str, ...]:
    """The ``count`` terms or starts of terms whose share of toxic documents exceeds that of the others by most standard errors; ``texts``: text, toxic."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if y else clean).update(_starts(text))
            names = list(toxic | clean)
            yield from to_table({"term": names, "a": [toxic[t] for t in names], "b": [clean[t] for t in names]}, "term string, a long, b long").to_batches()

    size = texts.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    if not size["a"] or not size["b"]:
        return ()
    n1, n0 = float(size["a"]), float(size["b"])
    counts = texts.select("text", "toxic").mapInArrow(run, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    share = (F.col("a") + F.col("b")) / (n1 + n0)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    best = counts.where(F.col("a") >= 4).withColumn("z", z).where("z > 5").orderBy(F.desc("z"), F.desc(F.length("term")), "term").limit(40 * count)
    return spread_out([r["term"] for r in best.select("term").collect()], count)


def train(docs: DataFrame, labels: DataFrame, use: Column, *, sample: int = 8_000, count: int = 48) -> Model:
    """``docs``: doc_id and text; ``labels``: doc_id and label (1 toxic); ``use`` picks rows of ``labels``."""
    chosen = labels.where(use & F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.join(F.broadcast(chosen), "doc_id").select("text", (F.col("label") > 0).cast("int").alias("toxic"))  # at most `sample` ids
    names = choose_landmarks(texts, count=count)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = landmarks_of(names)
        for b in batches:
            every = near.sentences(b.column(0).to_pylist())
            # the sentences nearest to the landmarks, as many as a fit may look at, and what all of them say together
            found = [sorted(rows, key=lambda r: -float(np.square(r).sum()))[: 2 * WORST] for rows in every]
            yield from to_table({"x": [[v for r in rows for v in r.tolist()] for rows in found], "near": [nearness(rows, len(names)).tolist() for rows in every],
                                 "y": b.column(1).to_pylist()}, TRAIN).to_batches()

    got = sorted((tuple(r["x"]), tuple(r["near"]), r["y"]) for r in texts.mapInArrow(run, TRAIN).collect()) if names else []
    found = [list(np.array(x).reshape(-1, len(names))) for x, _, _ in got]
    return fit(names, found, np.array([n for _, n, _ in got]).reshape(len(got), 2 * len(names)), np.array([y for _, _, y in got], int) > 0)


TRAIN = "x array<double>, near array<double>, y int"


def score(docs: DataFrame, keep: list[str], model: Model, *, text_col: str = "text") -> DataFrame:
    """``keep`` columns and the score of every text."""
    columns = schema_of(docs.select(*keep), "score double")
    rows, place = with_text(docs, keep, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = landmarks_of(model.names)
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                texts = b.column(place).to_pylist()
                found = near.sentences(texts) if model.names else [[]] * len(texts)
                values = pa.array([model.score(rows) for rows in found], pa.float64())
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], values], names=[*keep, "score"])

    return rows.mapInArrow(run, columns)


def op3_model(spark: SparkSession, sf_dir: str) -> Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    use = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    return train(documents(spark, sf_dir).select("doc_id", "text"), labels, use)


def op3_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows of one residue of the id's checksum are held out of fitting."""
    scored = score(documents(spark, sf_dir), ["doc_id"], op3_model(spark, sf_dir))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
