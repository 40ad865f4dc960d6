"""The list of registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .views import r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; its doubles are rounded for comparison."""

    def wrap(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            tune(spark)
            return r6(fn(spark, sf))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap
