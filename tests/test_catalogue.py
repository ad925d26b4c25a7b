"""Queries of the core against their SQL on the smallest tables, where they are there."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from refloom.plans import catalogue, corpus_queries, hierarchy_queries

DIR = "/root/testdata/sf0.001"
SQL = {**catalogue.oracle_sql(), **corpus_queries.oracle_sql(), **hierarchy_queries.oracle_sql()}
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DIR}/{f}'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return ""
    if hasattr(v, "year"):
        return str(v)[:19]
    if isinstance(v, (bool,)) or str(v) in ("True", "False"):
        return str(v)
    try:
        return round(float(v), 5)
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, DIR).toPandas()
    want = db.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns


def test_work_ranking_weighs_pagerank(spark, tmp_path):
    from refloom.plans import catalogue as C

    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("e", "b"), ("f", "d")]
    spark.createDataFrame(edges, "source string, target string").write.parquet(str(tmp_path / "citation_edges.parquet"))
    spark.createDataFrame([(n, ["A1"]) for n in "abcdef"], "work_id string, aliases array<string>").write.parquet(str(tmp_path / "corpus.parquet"))
    score = {r["node"]: r["score"] for r in C.work_ranking(spark, str(tmp_path)).collect()}
    assert score["d"] > score["b"]  # as often cited, but from works that are cited
