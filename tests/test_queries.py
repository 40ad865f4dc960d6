"""Every registered query against its oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from check import compare, oracle_connection


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """These inputs are tiny; fewer partitions make the module quicker."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["PARAMCD", "kind", "term", "estimate", "se"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, sf, con, name):
    _, problems = compare(entry_module.queries()[name](spark, sf), con, entry_module.oracle_sql().get(name))
    assert not problems
