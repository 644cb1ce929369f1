"""Every registered query against the same query in SQL on another engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.trade_queries()
ORACLE = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "customer", "nation"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def _canonical(names, rows):
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], _sorted([tuple(r[i] for i in order) for r in rows])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got_names, got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    want_names, want = _canonical([c[0] for c in result.description], result.fetchall())
    assert got_names == want_names
    assert len(got) == len(want)
    for mine, theirs in zip(got, want):
        for name_, a, b in zip(got_names, mine, theirs):
            assert type(a) is type(b), (name_, a, b)
            assert a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b)), (name_, mine, theirs)
