"""Small helpers shared by the text operators."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word is a run of characters other than the six ASCII blanks; Java's and RE2's regular expressions agree on it.
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six ASCII blanks."""
    return text.encode().split() if text else []


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``mapInArrow`` over columns as Python lists; ``fn`` gets and returns a dict of lists."""
    fields = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
            yield to_batch(out, fields)

    return df.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
          "array<binary>": pa.list_(pa.binary()), "array<string>": pa.list_(pa.string())}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in schema.split(","))])


def schema_of(kept: DataFrame, ddl: str) -> StructType:
    """The columns of ``kept`` followed by those of ``ddl``."""
    return StructType([*kept.schema.fields, *StructType.fromDDL(ddl).fields])


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def to_table(columns: dict, schema: str) -> pa.Table:
    fields = _arrow_schema(schema)
    return pa.Table.from_batches([to_batch(columns, fields)], fields)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a multiply and shift finaliser)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of all windows of a sequence from prefix sums of powers of an odd number modulo 2^64."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power), 1 << 15)
            step = np.full(n, _ODD, np.uint64)
            back = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(step), np.cumprod(back)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.power[: len(values)], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every window of ``size`` elements, by its start."""
        n = len(prefix) - size
        return mix64((prefix[size:] - prefix[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes, rolling: Rolling) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, by array operations only."""
    raw = np.frombuffer(data, np.uint8)
    solid = np.concatenate(([False], ~_BLANK[raw], [False]))
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    if not len(edge):
        return np.zeros(0, np.uint64)
    return rolling.spans(rolling.prefix(_BYTE[raw]), edge[0::2], edge[1::2])


_PLACE_BITS = 24


def minimizers(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of the least of each run of ``width`` hashes (leftmost among equals): places, and the first and last run each one rules.

    Equal stretches choose equal places whatever surrounds them. Ordered by the upper 40 bits of the hashes.
    """
    runs = len(hashes) - width + 1
    if runs <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    low = np.uint64((1 << _PLACE_BITS) - 1)
    chosen = np.empty(runs, np.int64)
    step = 1 << (_PLACE_BITS - 1)
    for base in range(0, runs, step):  # so that a place within a slice fits its bits
        part = hashes[base : base + step + width - 1]
        n = len(part) - width + 1
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        # minimum over each run from block-wise running minima: three passes whatever the width
        block = np.concatenate((key, np.full(-len(key) % width, MASK, np.uint64))).reshape(-1, width)
        ahead = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(block, axis=1).ravel()
        least = np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])
        chosen[base : base + n] = (least & low).astype(np.int64) + base
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    return chosen[first], first, np.append(first[1:], runs) - 1


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows than Spark's default of 10,000: whole texts travel in them, on both sides of the pipe."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def with_text(docs: DataFrame, keep: list[str], text_col: str) -> tuple[DataFrame, int]:
    """``keep`` columns with the text among them or after them, and its place."""
    small_batches(docs.sparkSession)
    if text_col in keep:
        return docs.select(*keep), keep.index(text_col)
    return docs.select(*keep, F.col(text_col).alias("_text_")), len(keep)


def besides(keep: list[str], schema: str) -> list[str]:
    """``keep`` without names of the result's own columns: those win."""
    own = {part.split()[0] for part in schema.split(", ")}
    return [c for c in keep if c not in own]


def rows_of(df: DataFrame) -> int:
    """Row count; for files it comes from their footers."""
    return df.select(F.lit(1)).count()
