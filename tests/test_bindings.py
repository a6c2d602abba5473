"""Registered queries against their SQL on the smallest driver tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as spark_entry

duckdb = pytest.importorskip("duckdb")
PATH = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="driver tables not here")
QUERIES, SQL = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in os.listdir(PATH):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{name}'")
    return connection


def counted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, PATH)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert counted(df.collect(), df.columns) == counted(cursor.fetchall(), columns)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
