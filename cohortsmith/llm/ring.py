"""Operator 7: shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard holds ``nodes`` places on the ring. A key belongs to the next place clockwise. Each shard may take its share of the rows and no more
(shares differ by one row at most and add up to all rows, so shards end exactly full); keys that find their shard full go on clockwise to the next
place whose shard has room. Rows of an arc are told apart by their rank in it, so the placing is solved on counts per place, whose number is fixed by
the parameters, and no row passes through the driver.

Nulls: a null id is placed by its text; null and empty texts have size 1 and checksum 0. Rows with one id share their place on the ring and may be split by
the limit. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

RING_BITS = 60


def ring_nodes(shards: int, nodes: int) -> list[tuple[int, int]]:
    """Places on the ring, clockwise, each with its shard."""
    return sorted((int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[: RING_BITS // 4], 16), s) for s in range(shards) for v in range(nodes))


def place(counts: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (arc, first rank, end rank, shard, first slot) that put every row of every arc on a shard within its share."""
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    pieces, over = [], []

    def take(arc: int, rank: int, count: int, shard: int) -> int:
        n = min(count, room[shard])
        if n:
            pieces.append((arc, rank, rank + n, shard, used[shard]))
            used[shard] += n
            room[shard] -= n
        return n

    for arc, count in enumerate(counts):  # first every arc's own shard
        n = take(arc, 0, count, owner[arc])
        if n < count:
            over.append((arc, n, count))
    for arc, rank, count in over:  # then clockwise
        at = arc
        while rank < count:
            at = (at + 1) % len(owner)
            rank += take(arc, rank, count - rank, owner[at])
    return pieces


def bounded_ring(docs: DataFrame, keep: list[str], *, shards: int = 8, nodes: int = 64, id_col: str = "doc_id", text_col: str = "text", cells: int = 1 << 16) -> DataFrame:
    """``keep`` columns, size, text_crc32, shard and slot of every row.

    ``cells`` is the number of equal cells of the ring over which ranks are counted; a node stands at the end of the cell it falls into.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(text))))
    row = docs.select(F.struct(*keep).alias("_row"), (F.octet_length(text) + 1).cast("long").alias("size"), crc.alias("text_crc32"),
                      F.conv(F.substring(key, 1, RING_BITS // 4), 16, 10).cast("long").alias("_at"))
    row = row.withColumn("_cell", F.shiftright("_at", RING_BITS - (cells - 1).bit_length()).cast("int"))
    ring = ring_nodes(shards, nodes)
    ends = [at >> (RING_BITS - (cells - 1).bit_length()) for at, _ in ring]
    arcs = [(cell, bisect_left(ends, cell) % len(ends)) for cell in range(cells)]
    arc_of = spark.createDataFrame(arcs, "_cell int, _arc int")  # fixed by the parameters
    in_cell = row.groupBy("_cell").agg(F.count("*").alias("_n")).join(arc_of, "_cell")
    # the last arc wraps past zero: cells at its start of the ring come after those at the end
    turn = F.when((F.col("_arc") == 0) & (F.col("_cell") > ends[0]), 0).otherwise(1)
    ranks = Window.partitionBy("_arc").orderBy(turn, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = {r["_arc"]: r["n"] for r in in_cell.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}  # at most shards * nodes rows
    pieces = place([counts.get(a, 0) for a in range(len(ring))], [s for _, s in ring], shards)
    piece = spark.createDataFrame(pieces, "_arc int, _from long, _to long, shard int, _slot long")
    in_cell = in_cell.select("_cell", "_arc", F.coalesce(F.sum("_n").over(ranks), F.lit(0)).alias("_base"))
    order = Window.partitionBy("_cell").orderBy("_at", "text_crc32", "size")
    row = row.withColumn("_in", F.row_number().over(order) - 1).join(in_cell, "_cell").withColumn("_rank", F.col("_base") + F.col("_in"))
    put = row.join(F.broadcast(piece), "_arc").where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))  # a few rows per node
    return put.select("_row.*", "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))


def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal numbers of rows."""
    put = bounded_ring(documents(spark, sf_dir), ["doc_id"])
    return put.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
