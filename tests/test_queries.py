"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}
SQL = {k: q for k, q in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"ivf_search", "search_comparison"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    result = tables.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(str([plain(row[i]) for i in at]) for row in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_approximate_queries(spark):
    for name in ("ivf_search", "graph_search"):
        rows = QUERIES[name](spark, FOLDER).collect()
        assert len({r["qid"] for r in rows}) == 200 and max(r["rank"] for r in rows) == 10
