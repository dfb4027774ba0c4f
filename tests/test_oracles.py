"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("events", "documents", "orders")
# The queries of the subpackage for training data, which may be absent, have tests of their own.
QUERIES = {name: q for name, q in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name not in contract.LLM_ORACLES}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        "user_relevance_rf",
        "rf_accuracy",
        "kmeans_clusters",
        "kmeans_sizes",
        "kmeans_silhouette",
    }


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert contract.entry(spark).columns == ["source", "target", "user_type", "weight"]
