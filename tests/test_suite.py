"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as suite
from check import TABLES, compare
from conftest import SMALL

from quotemill.suite.oracle import statements
from quotemill.suite.queries import QUERIES

ORACLE = statements()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_all():
    assert set(QUERIES) <= set(suite.queries()) and set(ORACLE) <= set(suite.oracle_sql())


def test_entry(spark):
    got = suite.entry(spark)
    assert got.columns == ["Industry", "Year", "Month", "avg_3m_marketcap"] and got.count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    found = db.sql(ORACLE[name])
    at = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    assert columns == [found.columns[i] for i in at]
    assert compare(columns, got, [tuple(r[i] for i in at) for r in found.fetchall()]) == ""
