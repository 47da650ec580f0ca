"""Every registered query against its SQL on the smallest sample tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.registry import QUERIES, SQL
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["region", "nation", "n_orders", "revenue"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    got = df.collect()
    cursor = sql.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, cursor.fetchall())
