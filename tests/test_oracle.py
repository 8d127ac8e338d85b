"""Every query against its SQL in DuckDB, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from catalog import io_queries, raster_queries, text_queries

SF_DIR = os.environ.get("PAGEMILL_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "float": "FLOAT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}
QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_each_query_has_sql():
    own = {name for module in (io_queries, raster_queries, text_queries) for name in module.QUERIES}
    assert own <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = Counter(tuple(row[c] for c in columns) for row in df.collect())

    result = duck.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in result.description}
    order = [list(types).index(c) for c in columns]
    assert sorted(types) == columns
    assert types == {c: TYPES[t] for c, t in df.dtypes}
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["filename", "classification", "date", "content"]
    assert df.count() > 0
