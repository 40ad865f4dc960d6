"""Writers for analysis tables and statistics."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..session import checkpointed

# Spark types and the data type written for each in the row-array JSON format.
_JSON_TYPES = {"string": "string", "int": "integer", "bigint": "integer", "double": "double", "float": "float",
               "boolean": "boolean", "date": "date", "timestamp": "datetime"}


def write_adam(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write an analysis table as Parquet, CSV, JSON lines or newline Dataset-JSON, all by many tasks, or as one Dataset-JSON document.

    Spark commits a job's files together: of a job that fails, no part file is left.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).option("emptyValue", "").csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "ndjson":
        _dataset_ndjson(df).write.mode(mode).text(path)
    elif fmt == "dataset-json":
        _dataset_document(df).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def _columns(df: DataFrame) -> str:
    columns = [{"name": f.name, "dataType": _JSON_TYPES.get(f.dataType.simpleString(), "string"),
                "label": (f.metadata or {}).get("label", "")} for f in df.schema.fields]
    return json.dumps({"columns": columns})


def _row_arrays(df: DataFrame) -> DataFrame:
    quoted = [F.coalesce(
        F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, (T.NumericType, T.BooleanType))
        else F.expr(f"substr(to_json(array(cast(`{f.name}` as string))), 2, length(to_json(array(cast(`{f.name}` as string)))) - 2)"),
        F.lit("null")) for f in df.schema.fields]
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *quoted), F.lit("]")).alias("value"))


def _dataset_ndjson(df: DataFrame) -> DataFrame:
    """Metadata line and row arrays as text; the metadata line stands in its own part file."""
    head = df.sparkSession.createDataFrame([(_columns(df),)], "value string")
    return head.unionByName(_row_arrays(df))


def _dataset_document(df: DataFrame) -> DataFrame:
    """One document, so one file: the rows are made by many tasks and written by one, line by line."""
    spark = df.sparkSession
    line = lambda text: spark.createDataFrame([(text,)], "value string")
    # a row of the first partition with the first number has no row before it
    rows = _row_arrays(df).coalesce(1).select(F.concat(F.when(F.monotonically_increasing_id() == 0, "").otherwise(","), "value").alias("value"))
    return line(_columns(df)[:-1] + ', "rows": [').coalesce(1).unionByName(rows).unionByName(line("]}").coalesce(1)).coalesce(1)


def write_ard(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a statistics table as CSV and JSON under one folder; the table is computed once."""
    df = checkpointed(df)
    df.write.mode(mode).option("header", True).csv(f"{path}/csv")
    df.write.mode(mode).json(f"{path}/json")
