"""Operator 4: near-duplicates by a chosen-path set similarity join.

A document is its set of word shingles. From the root of each of several independent trees, every set follows a few of its minwise tokens: a node picks each of
the positions of the minhash signature with a fixed small chance, drawn from the node's own path, and a set goes on to the child named by each picked
position and its value there. Similar sets share values and so stay together down some path. Nodes two steps below the roots are compared
exhaustively, first on signatures, which leaves out members far from all others, then on the full sets. No node branches
on, as every further step would lose pairs, so that the chance of missing a pair does not depend on the size of its nodes.
A large node is cut into blocks, and first only members of one block meet. Components need no link between members that are already
connected, so what is left of a large node is its largest component against all others, and those among themselves, each only with sets of a size that can
be similar enough (``across``): a group of near copies costs a few rows per member, and only a large node of many unlike members of like size meets in pairs of blocks.
Inside a node the links become a spanning star for each connected part, so a node emits fewer rows than it has members, and connected parts over all
nodes are found by large-star and small-star steps.

Equal sets are one member of the trees (grouped by a 128-bit digest), so any number of exact copies costs one row per node. Nodes with the
same members, as independent trees produce, are compared once.

A first branch keeps a pair at the threshold together for two steps with a chance of 0.54 (0.51 at 0.8); the trees have 17 of them (7 of the 16 roots pick no
position), so all miss it with a chance of 2e-6 (6e-6 at 0.8), and a component is lost only if all of its joining pairs are. A pair at the threshold falls below the signatures' bar (two fifths less, the same in all trees) with a chance of 6e-11 at 0.85 and 5e-9 at 0.8.

Nulls: a null or empty text, or one without words, has an empty set and is linked with nothing. A null id takes no part: its component is null and it is kept.
Rows of one id are one document. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.groups import keyed_join
from ..session import checkpointed
from .common import _arrow_schema, documents, mix64, Rolling, rows_of, small_batches, to_batch, to_table, word_hashes

SIGNATURE = 64
TREES = 16
_ROLLING = Rolling()
_draw = np.random.default_rng(20240917)
_MULTIPLIERS = _draw.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = mix64(np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words; of a shorter text, one of all its words."""
    hashes = word_hashes((text or "").encode().lower(), _ROLLING)  # bytes.lower() changes A-Z only
    if not len(hashes):
        return hashes
    sums = _ROLLING.prefix(hashes)
    if len(hashes) >= size:
        return np.unique(_ROLLING.windows(sums, size))
    return mix64(_ROLLING.windows(sums, len(hashes)) + np.uint64(len(hashes)))


def digest(tokens: np.ndarray) -> bytes:
    """128 bits of a set: two sums of spread hashes, and its size within."""
    return int(mix64(tokens).sum()).to_bytes(8, "little") + int(mix64(tokens + np.uint64(len(tokens))).sum()).to_bytes(8, "little")


def signature(tokens: np.ndarray) -> np.ndarray:
    """The upper halves of the least values, by position."""
    out = np.empty(SIGNATURE, np.uint64)
    for a in range(0, len(tokens), 1 << 14):  # bounded for very long texts
        part = (tokens[a : a + (1 << 14), None] * _MULTIPLIERS).min(0)
        out = part if a == 0 else np.minimum(out, part)
    return (out >> np.uint64(32)).astype(np.uint32)


def sketch(found: np.ndarray) -> np.ndarray:
    """The lowest byte of each value of a signature. Equal values have equal bytes, so no pair agrees in fewer places; unlike ones agree in one place of 256."""
    return (found & np.uint32(255)).astype(np.uint8)


def picked(paths: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The positions that nodes choose, each with a chance of 1 / (similarity * SIGNATURE): index of the path, and position."""
    limit = np.uint64(int((1 << 64) / (similarity * SIGNATURE)))
    return np.nonzero(mix64(paths[:, None] ^ _PLACES) < limit)


def step(paths: np.ndarray, rows: np.ndarray, signatures: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of (path, row of signatures): their paths and rows."""
    at, place = picked(paths, similarity)
    return mix64(paths[at] * np.uint64(0x9E3779B97F4A7C15) + mix64(signatures[rows[at], place].astype(np.uint64) + _PLACES[place])), rows[at]


SETS = "doc_id long, n_shingles long, set_id binary, signature binary, sketch binary"


def sets(docs: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, n_shingles, set_id (null for an empty set), signature and its sketch."""
    fields = _arrow_schema(SETS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(t, shingle) for t in b.column(1).to_pylist()]
            least = [signature(s) if len(s) else None for s in found]
            yield to_batch({"doc_id": b.column(0), "n_shingles": [len(s) for s in found], "set_id": [digest(s) if len(s) else None for s in found],
                            "signature": [x if x is None else x.tobytes() for x in least], "sketch": [x if x is None else sketch(x).tobytes() for x in least]}, fields)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SETS)


def first_paths(found: DataFrame, similarity: float, trees: int) -> DataFrame:
    """(path, set_id) two steps below the roots of all trees."""
    roots = mix64(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            signatures = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, SIGNATURE)
            n = len(ids)
            for a in range(0, n, 1000):
                m = min(1000, n - a)
                paths, rows = np.repeat(roots, m), np.tile(np.arange(a, a + m), trees)
                for _ in range(2):
                    paths, rows = step(paths, rows, signatures, similarity)
                yield from to_table({"path": paths.view(np.int64), "set_id": [ids[r] for r in rows.tolist()]}, "path long, set_id binary").to_batches()

    return found.select("set_id", "signature").mapInArrow(run, "path long, set_id binary")


def next_paths(members: DataFrame, similarity: float) -> DataFrame:
    """Children of (path, set_id, signature)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1).to_pylist()
            signatures = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, SIGNATURE)
            paths, rows = step(b.column(0).to_numpy().view(np.uint64), np.arange(len(ids)), signatures, similarity)
            yield from to_table({"path": paths.view(np.int64), "set_id": [ids[r] for r in rows.tolist()]}, "path long, set_id binary").to_batches()

    return members.select("path", "set_id", "signature").mapInArrow(run, "path long, set_id binary")


def links(tokens: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs have 100 * intersection >= percent * union, as a square of booleans."""
    n = len(tokens)
    size = np.array([len(t) for t in tokens])
    flat, row = np.concatenate(tokens), np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1  # a token of one member joins nothing
    column, row = np.unique(column[often], return_inverse=True)[1], row[often]
    common = np.zeros((n, n), np.float32)
    width = 4096
    total = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, total, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        part = np.zeros((n, width), np.float32)
        part[row[lo:hi], column[lo:hi] - a] = 1
        common += part @ part.T
    both = common.astype(np.int64)
    return 100 * both >= percent * (size[:, None] + size[None, :] - both)


def stars(names: list, linked: np.ndarray) -> list[tuple]:
    """For each connected part, its smallest name with each other one."""
    order = sorted(range(len(names)), key=names.__getitem__)
    seen = np.zeros(len(names), bool)
    out = []
    for root in order:
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            reach = linked[front].any(0) & ~seen
            front = np.flatnonzero(reach)
            seen |= reach
            out.extend((names[root], names[i]) for i in front.tolist())
    return out


def _each_node(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Row ranges of the nodes (or pairs of blocks) of a table sorted by path, i and j."""
    keys = [table.column(c).to_numpy() for c in ("path", "i", "j")]
    n = table.num_rows
    if n:
        new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
        start = np.flatnonzero(new)
        yield from zip(start.tolist(), np.append(start[1:], n).tolist())


def _by_bucket(members: DataFrame, per_bucket: int) -> DataFrame:
    """A column _bucket such that whole nodes meet, many small ones in each bucket."""
    buckets = max(1, rows_of(members) // per_bucket)
    return members.withColumn("_bucket", F.pmod(F.xxhash64("path", "i", "j"), F.lit(buckets)).cast("int"))


_SORT = [("path", "ascending"), ("i", "ascending"), ("j", "ascending")]


def plausible(members: DataFrame, percent: int, per_bucket: int = 8192) -> DataFrame:
    """Members of each node that have another, not yet connected, with a signature at most two fifths less alike than asked; ``members``: path, i, j, doc_id, c, signature.

    ``c`` names what is known to be connected; a member of which nothing is known has its own. A signature may be a whole one or its sketch, as all members are.
    """
    bar = 0.6 * percent / 100 * SIGNATURE

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(_SORT)
        flat = b"".join(table.column("signature").to_pylist())
        signatures = np.frombuffer(flat, np.uint8 if len(flat) == SIGNATURE * table.num_rows else np.uint32).reshape(-1, SIGNATURE)
        known = table.column("c").to_numpy()
        keep = np.zeros(table.num_rows, bool)
        for a, b in _each_node(table):
            part = signatures[a:b]
            if b - a == 2:
                keep[a:b] = (part[0] == part[1]).sum() >= bar and known[a] != known[a + 1]
                continue
            same = np.zeros((b - a, b - a), np.int16)
            for place in range(SIGNATURE):
                same += part[:, None, place] == part[None, :, place]
            same[known[a:b, None] == known[None, a:b]] = 0
            keep[a:b] = same.max(1) >= bar
        return table.select(["path", "i", "j", "doc_id"]).filter(pa.array(keep))

    return _by_bucket(members, per_bucket).groupBy("_bucket").applyInArrow(run, "path long, i int, j int, doc_id long")


def across(large: DataFrame, percent: int, node: int) -> DataFrame:
    """Who meets whom in large nodes once the links inside blocks are known; ``large``: path, doc_id, n_shingles, c, signature.

    The members of a node are its largest component and the others, in strata of set sizes: sets whose strata are not the same or next to each other differ
    too much in size to be linked (the strata are a ten-thousandth wider than the similarity asks, so that rounding loses none). Strata are cut into blocks of ``node``
    members. Pairs of blocks meet unless both are of the largest component; nodes of one component are done.
    """
    at = ["path", "_main", "_stratum"]
    parts = large.groupBy("path", "c").agg(F.count("*").alias("n"))
    main = parts.groupBy("path").agg(F.max(F.struct("n", "c")).alias("m"), F.count("*").alias("k")).where("k > 1").select("path", F.col("m.c").alias("_c"))
    width = float(np.log(100 / percent)) * 1.0001 if percent < 100 else 1e-4
    rows = keyed_join(large, main, ["path"], "inner").withColumn("_main", F.col("c") == F.col("_c"))
    rows = checkpointed(rows.withColumn("_stratum", F.floor(F.log(F.col("n_shingles").cast("double")) / width)).drop("_c"))
    cells = rows.groupBy(*at).agg(F.ceil(F.count("*") / node).cast("int").alias("_blocks"))
    rows = keyed_join(rows, cells, at, "inner").withColumn("_block", F.pmod(F.xxhash64("doc_id"), "_blocks").cast("int"))
    block = F.struct("_main", "_stratum", "_block")
    blocks = checkpointed(cells.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select("path", block.alias("x")))
    meet = (F.col("x") <= F.col("y")) & (F.abs(F.col("x._stratum") - F.col("y._stratum")) <= 1) & ~(F.col("x._main") & F.col("y._main"))
    pairs = blocks.join(blocks.select("path", F.col("x").alias("y")), "path").where(meet).withColumn("_new", F.xxhash64("path", "x", "y"))
    ends = pairs.select("path", "_new", F.explode(F.array_distinct(F.array("x", "y"))).alias("z")).select("path", "z.*", "_new")
    met = rows.join(ends, [*at, "_block"])
    return met.select(F.col("_new").alias("path"), F.lit(0).alias("i"), F.lit(0).alias("j"), "doc_id", "c", "signature")


#: Bits of a row of marks, and the most rows there are: 16 MB, whatever the number of documents.
MARKS, MOST = 1 << 15, 1 << 12


def wanted(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of ``texts`` with an id of ``members``, and some others, left out where the texts are read, so that a join moves few texts of no use.

    An id marks one bit of eight for each member, found by its hash. The marks are sent to every task; beyond ``MOST`` rows of them ids share bits, and more of the others stay.
    """
    rows = min(MOST, 1 + 8 * rows_of(members) // MARKS)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(rows * MARKS))
    at = members.select("doc_id", (place % MARKS).alias("_bit"), F.floor(place / MARKS).alias("_row"))
    marks = at.groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1
    found = texts.withColumns({"_bit": place % MARKS, "_at": F.floor(place / MARKS)}).join(F.broadcast(marks), F.col("_at") == F.col("_row"))
    return found.withColumn("_byte", byte).where(marked).select(*texts.columns)


def compare_nodes(members: DataFrame, texts: DataFrame, percent: int, shingle: int, per_bucket: int = 2048) -> DataFrame:
    """Stars (a, b) of the links inside each node or pair of blocks; ``members``: path, i, j, doc_id; ``texts``: doc_id, _text.

    Sets travel as six bytes per shingle: a false agreement within a pair of sets of a thousand has a chance of 2e-9.
    """
    fields = _arrow_schema("path long, i int, j int, doc_id long, _bucket int, tokens binary")

    def to_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(t, shingle).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for t in b.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(found, pa.binary())], schema=fields)

    def tokens_of(data: bytes) -> np.ndarray:
        wide = np.zeros((len(data) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
        return wide.view(np.uint64).ravel()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(_SORT)
        ids, data = table.column("doc_id").to_pylist(), table.column("tokens")
        out: list[tuple] = []
        for a, b in _each_node(table):
            if b - a > 1:
                out.extend(stars(ids[a:b], links([tokens_of(t) for t in data[a:b].to_pylist()], percent)))
        return to_table({"a": [a for a, _ in out], "b": [b for _, b in out]}, "a long, b long")

    rows = _by_bucket(members, per_bucket).join(wanted(texts, members), "doc_id").select("path", "i", "j", "doc_id", "_bucket", "_text")
    rows = rows.mapInArrow(to_tokens, "path long, i int, j int, doc_id long, _bucket int, tokens binary")
    return rows.groupBy("_bucket").applyInArrow(run, "a long, b long")


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(doc_id, component_id) of every end of ``edges`` (a, b): the smallest id that can be reached.

    Large-star and small-star steps, each pair written to the checkpoint folder, until only stars are left: every end has one
    parent, and no parent has one itself.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u")
        if large:
            near = near.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            near = near.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return near.where("a <> b").distinct()

    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        now = checkpointed(star(star(now, True), False))
        parents = now.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        if parents.where("n > 1").isEmpty() and now.join(parents.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return parents.select(F.col("a").alias("doc_id"), F.col("b").alias("component_id"))
    raise RuntimeError(f"components still change after {rounds} rounds")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, trees: int = TREES, node: int = 800, depth: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept (the smallest id of each component).

    ``percent``: a link needs 100 * intersection >= percent * union. ``node``: members up to which a node is compared in one task; ``depth``: steps below
    the root after which larger nodes are compared in blocks of that size and then across components. A depth above 2 saves comparisons in large nodes and loses pairs in them.
    """
    similarity = percent / 100
    found = checkpointed(sets(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    named = found.where("doc_id is not null and set_id is not null")
    distinct = named.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
                                           F.first("n_shingles").alias("n_shingles"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")).where("_text is not null and doc_id is not null")

    def with_size(paths: DataFrame) -> DataFrame:
        """Members of nodes of two or more, with their number."""
        return checkpointed(keyed_join(paths, paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), ["path"], "inner"))

    def compared(spread: DataFrame) -> DataFrame:
        """Stars of the links in nodes and pairs of blocks."""
        near = checkpointed(plausible(checkpointed(spread), percent))
        # nodes of the same members once, as trees of like sets agree
        prints = near.groupBy("path", "i", "j").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(20)")).alias("print"))
        once = prints.groupBy("n", "print").agg(F.min(F.struct("path", "i", "j")).alias("k")).select("k.*")
        return compare_nodes(checkpointed(near.join(once, ["path", "i", "j"], "left_semi")), texts, percent, shingle)

    members = with_size(first_paths(distinct, similarity, trees))
    done = members.where(F.col("n") <= node)
    for level in range(3, depth + 2):
        large = members.where(F.col("n") > node)
        if large.isEmpty():
            break
        if level > depth:  # compared in blocks
            done = done.union(large)
            break
        members = with_size(next_paths(large.join(distinct.select("set_id", "signature"), "set_id"), similarity))
        done = done.union(members.where(F.col("n") <= node))
    in_block = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / node)).cast("int")
    first = done.join(distinct, "set_id").select("path", in_block.alias("i"), in_block.alias("j"), "doc_id", F.col("doc_id").alias("c"), F.col("sketch").alias("signature"))
    parts = connected(compared(first))
    large = done.where(F.col("n") > node)
    if not large.isEmpty():
        rows = large.select("path", "set_id").join(distinct, "set_id").join(parts, "doc_id", "left")
        rows = checkpointed(rows.select("path", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("c"), F.col("sketch").alias("signature")))
        parts = connected(compared(across(rows, percent, node)).union(parts))
    classes = distinct.select("doc_id", "set_id").join(parts, "doc_id", "left").select("set_id", F.coalesce("component_id", "doc_id").alias("_component"))
    out = found.select("doc_id", "n_shingles", "set_id").join(classes, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are at least 85 % alike."""
    return near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


OP4_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t FROM d),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x AS a, y AS b FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d LEFT JOIN size USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
