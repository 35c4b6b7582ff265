"""Driver contract: entry(), queries() / oracle_sql(), and every SQL twin
equal to its Spark query on the sf0.001 tables."""

import os
import sys

import pytest

import __spark_entry__ as E
from tidewater.plans import load_all

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import SPARK_TO_SQL, TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE_SQL = load_all()
SLOW = {"doc_quality_scores"}
   # trains 150 rounds; covered with few rounds below


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["store_id", "total_revenue", "tx_count"]
    assert df.count() > 0


def test_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(qs) and set(ORACLE_SQL) <= set(sql)
    assert len(QUERIES) >= 50


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twin_matches(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


def test_doc_quality_scores_few_rounds(spark):
    from tidewater.plans.ml_queries import doc_quality_scores
    out = doc_quality_scores(spark, SF, max_iter=5).collect()
    assert all(0 <= r.fraud_score <= 1 for r in out)
