"""Every registered query against DuckDB on the smallest given tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docpipe.plans.catalog import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _by_column(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_own_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    got = _by_column([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(columns) == sorted(df.columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == sql_types
    assert got == _by_column(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0
