"""Every query with an SQL twin gives the twin's rows."""

from __future__ import annotations

import importlib
import os

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_flagship(spark):
    assert not entry.entry(spark).isEmpty()
    assert set(entry.oracle_sql()) <= set(entry.queries())
