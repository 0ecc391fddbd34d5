"""Every named query gives the rows of its SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from changelake import queries as named_queries
from changelake.sources.fixtures import TABLES, VIEWS, duckdb_sql, view

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry_module.queries().items() if name in named_queries.QUERIES}
ORACLES = named_queries.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _rows(duck, sql: str, columns: list[str]) -> list[str]:
    cursor = duck.execute(sql)
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    return sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row[column] for column in columns)) for row in df.collect())
    assert rows == _rows(duck, ORACLES[name], columns)


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view_is_the_same_in_both_engines(spark, duck, name):
    df = view(spark, SF_DIR, name)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row[column] for column in columns)) for row in df.collect())
    assert rows == _rows(duck, duckdb_sql(name), columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
