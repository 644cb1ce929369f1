"""Every query with SQL against an independent engine, on the same tables."""

import os

import duckdb
import pytest

from lotwise.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, engine, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    wanted = engine.sql(queries.oracle_sql()[name])
    assert sorted(wanted.columns) == columns
    ours = sorted((plain(r[c] for c in columns) for r in df.collect()), key=repr)
    order = [wanted.columns.index(c) for c in columns]
    theirs = sorted((plain(r[i] for i in order) for r in wanted.fetchall()), key=repr)
    assert ours == theirs
    assert ours
