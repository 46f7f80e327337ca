"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, db, name):
    df = entry_module.queries()[name](spark, FOLDER)
    mine = [tuple(r) for r in df.collect()]
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert mine
        return
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, mine) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
