"""Operator 2: exact top-k inner products by no-random-access aggregation.

Candidates live in blocks of bounded size. A block has one list per component, sorted by value; a query reads a list from its top where the query's component is positive and
from its bottom where it is negative, all lists to the same depth. What has been read gives each candidate a lower bound (components not read count as the worst of
their list) and an upper bound (as the value read last); rows with the query's own id have neither. Depth grows until few candidates besides the best k have an upper bound that reaches
the k-th best lower bound; outsiders cannot qualify then, and the scores of those that remain are resolved. All queries of a chunk read a
block together, so bounds are products of matrices. The best k of every block are merged by rank.

Queries meet every block once, in chunks: chunks times blocks tasks, each of bounded size, whose number follows the work asked for.

Components become ``floor(scale * x)``. A vector that is null, empty, or holds a null, NaN or infinite component (also after scaling) takes no part, and neither does a null id;
scores beyond 53 bits are exact too, and one beyond 64 bits shows as the end of the range, in blocks ranked by its true value;
vectors meet only those of their own length. Equal rows are counted first and at most ``k`` of them go on, as no query can return more. Rows that carry the query's id are not its candidates; of several query rows of one id the least vector asks. Ties go to
the smaller id. No vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, rows_of, to_batch, to_table

DEPTHS = (0.5, 0.75, 0.9, 0.97)
PACKED = "vec_id long, dim int, packed binary"
BEST = "query_id long, vec_id long, score long"


def packed(vectors: DataFrame, *, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Ids, lengths and integer components (as doubles) of the usable vectors."""
    fields = _arrow_schema(PACKED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, data = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or not v or None in v:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * np.array(v, np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    dims.append(len(x))
                    data.append((x + 0.0).tobytes())  # no negative zero
            yield to_batch({"vec_id": ids, "dim": dims, "packed": data}, fields)

    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(run, PACKED)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    data = table.column("packed").to_pylist()
    return table.column("vec_id").to_numpy(), np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def bounds(up: np.ndarray, down: np.ndarray, x: np.ndarray, ordered: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores after reading ``depth`` values of each list; ``up`` and ``down``: positive and negative parts of the queries."""
    top, bottom = ordered[-depth], ordered[depth - 1]
    upper = up @ np.maximum(x, top).T + down @ np.minimum(x, bottom).T
    lower = up @ np.where(x >= top, x, ordered[0]).T + down @ np.where(x <= bottom, x, ordered[-1]).T
    return lower, upper


def best_of_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> dict[str, list]:
    """The ``k`` best candidates of a block for each query (all, if fewer; the query's own id left out)."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1]
    if most >= 2**53:
        return best_of_large(query_ids, q, ids, x, k)
    kind = np.float32 if most < 2**24 else np.float64  # both exact in their range
    q, x = q.astype(kind), x.astype(kind)
    n, want = len(x), min(k, len(x))
    own = np.nonzero(query_ids[:, None] == ids[None, :])  # any number of rows may carry a query's id
    ordered = np.sort(x, axis=0)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    alive = None
    for share in DEPTHS:
        lower, upper = bounds(up, down, x, ordered, max(1, int(share * n)))
        lower[own] = upper[own] = -np.inf
        least = np.partition(lower, n - want, axis=1)[:, n - want]
        alive = upper >= least[:, None]
        if alive.sum(1).max() <= max(8 * k, n // 50):  # outsiders cannot qualify any more
            break
    else:
        alive = None  # every list is read to its end: all scores are known
        scores = q @ x.T
        scores[own] = -np.inf
    for row in range(len(q)):
        if alive is None:
            near = np.flatnonzero(scores[row] >= np.partition(scores[row], n - want)[n - want])
            value = scores[row, near]
        else:
            near = np.flatnonzero(alive[row])
            value = x[near] @ q[row]
        near, value = near[ids[near] != query_ids[row]], value[ids[near] != query_ids[row]]
        first = np.lexsort((ids[near], -value))[:k]
        out["query_id"].extend([int(query_ids[row])] * len(first))
        out["vec_id"].extend(ids[near[first]].tolist())
        out["score"].extend(value[first].astype(np.int64).tolist())
    return out


def best_of_large(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> dict[str, list]:
    """The same where scores do not fit a double: rounded scores with their error give the bounds, and those who can qualify are resolved in whole numbers of any size."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    shrunk = [np.ldexp(m, -np.frexp(np.abs(m).max())[1]) for m in (q, x)]  # largest below 1: products cannot overflow
    score = shrunk[0] @ shrunk[1].T
    error = (np.abs(shrunk[0]) @ np.abs(shrunk[1]).T) * (4 * x.shape[1] * 2.0**-52) + 1e-300
    whole_q, whole_x = {}, {}
    for row in range(len(q)):
        other = np.flatnonzero(ids != query_ids[row])
        if not len(other):
            continue
        want = min(k, len(other))
        low = (score[row] - error[row])[other]
        near = other[(score[row] + error[row])[other] >= np.partition(low, len(low) - want)[len(low) - want]]
        asked = whole_q.setdefault(row, [int(v) for v in q[row].tolist()])
        exact = []
        for i in near.tolist():
            if i not in whole_x:
                whole_x[i] = [int(v) for v in x[i].tolist()]
            exact.append((-sum(a * b for a, b in zip(asked, whole_x[i])), int(ids[i])))
        for value, i in sorted(exact)[:k]:
            out["query_id"].append(int(query_ids[row]))
            out["vec_id"].append(i)
            out["score"].append(max(-(2**63), min(2**63 - 1, -value)))
    return out


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 8192, chunk: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best candidates of each query; ``is_query`` is a condition on the column vec_id."""
    n = rows_of(vectors)
    blocks, chunks = max(1, -(-n // block)), max(1, -(-n // (20 * chunk)))
    all_rows = packed(vectors, id_col=id_col, vector_col=vector_col, scale=scale).groupBy("vec_id", "dim", "packed").agg(F.count("*").alias("_n"))
    copies = all_rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(k)).cast("int")))).drop("_n")
    place = F.pmod(F.xxhash64("vec_id", "packed", "_copy"), F.lit(blocks)).cast("int")
    candidates = copies.select(*all_rows.drop("_n").columns, place.alias("_block")).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    queries = all_rows.where(is_query).groupBy("vec_id", "dim").agg(F.min("packed").alias("packed"))
    queries = queries.withColumn("_chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(asked: pa.Table, block_rows: pa.Table) -> pa.Table:
        if not asked.num_rows or not block_rows.num_rows:
            return to_table({"query_id": [], "vec_id": [], "score": []}, BEST)
        query_ids, q = _matrix(asked)
        ids, x = _matrix(block_rows)
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        for a in range(0, len(q), 256):  # a bounded square of scores at a time
            for name, values in best_of_block(query_ids[a : a + 256], q[a : a + 256], ids, x, k).items():
                found[name].extend(values)
        return to_table(found, BEST)

    keys = ["dim", "_chunk", "_block"]
    best = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, BEST)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op2_sorted_list_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
