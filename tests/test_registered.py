"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from hazardry.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_twin(spark, duck, tables, name):
    line = compare(spark, duck, tables, name)
    assert line.startswith("OK"), line


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["dimension"] for r in rows} == {"type", "severity", "total"}
