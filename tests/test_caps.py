"""Queries whose SQL caps rows, at a size where the caps bite."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from changelake.queries import ORACLES
from changelake.sources.fixtures import TABLES
from tests.test_oracle import QUERIES, _rows

SF_DIR = "/root/testdata/sf0.01"
CAPPED = sorted(name for name, sql in ORACLES.items() if "LIMIT" in sql or "WHERE n <=" in sql)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", [*CAPPED, "g04_artifact_gate_all"])
def test_query_equals_sql_where_caps_bite(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row[column] for column in columns)) for row in df.collect())
    assert rows == _rows(duck, ORACLES[name], columns)


def test_the_cap_of_the_artifact_gate_bites(spark):
    capped, whole = (QUERIES[name](spark, SF_DIR).count() for name in ("g04_artifact_gate", "g04_artifact_gate_all"))
    assert capped < 100 < whole
