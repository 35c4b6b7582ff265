"""Queries opN_ and the pipeline over the sf0.001 tables, their SQL twins, and
brute-force versions of those without."""

import collections
import os
import re
import sys

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tidewater.llm import queries, secrets

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from helpers import classes, spaced  # noqa: E402
from oracle_check import SPARK_TO_SQL, TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def test_every_operator_is_registered():
    names = E.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n.startswith("op")} >= {str(k) for k in range(1, 11)} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twin_matches(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_op4_base_findings(spark, documents):
    got = {r.doc_id: r for r in E.queries()["op4_secret_scan"](spark, SF).collect()}
    for d, text, _, _ in documents:
        base, spans, _ = secrets.scan(text or "")
        assert [got[d][f"n_{k}"] for k in secrets.KINDS] == [sum(b[1] == k for b in base) for k in secrets.KINDS]
        assert got[d].spans == ",".join(f"{k}:{s}:{e}" for s, k, e, _ in spans)


def test_op6_classes(spark, documents):
    got = {r.doc_id: r.class_id for r in E.queries()["op6_minhash_near_dup"](spark, SF).collect()}
    ids = [d for d, *_ in documents]
    assert got == dict(zip(ids, classes(ids, [t for _, t, *_ in documents])))


def test_op7_rows(spark, documents):
    got = {r.doc_id: r for r in E.queries()["op7_spot_signatures"](spark, SF).collect()}
    assert len(got) == len(documents)
    by_text = collections.defaultdict(set)
    for d, text, *_ in documents:
        assert got[d].n_chars == len(text) and 0 <= got[d].near_next <= 1
        by_text[text].add(got[d].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


def test_op10_languages(spark, documents):
    got = {r.doc_id: r for r in E.queries()["op10_language_id"](spark, SF).collect()}
    assert sum(got[d].language == lang for d, _, lang, _ in documents) > 0.99 * len(documents)
    assert not any(r.rejected for r in got.values())


def test_page_languages(spark):
    rows = E.queries()["page_language_id"](spark, SF).collect()
    assert rows and sum(r.language == r.declared for r in rows) > 0.95 * len(rows)


def test_pipeline(spark, documents):
    rows = E.queries()["pipeline"](spark, SF).collect()
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lower = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = set()
    for t in bench:
        w = lower(t)
        grams |= {tuple(w[i:i + min(10, len(w))]) for i in range(max(0, len(w) - 9) or (len(w) > 0))}
    sizes = {len(g) for g in grams}
    hit = lambda t: any(tuple(w[i:i + n]) in grams for w in [lower(t)] for n in sizes for i in range(len(w) - n + 1))
    ids = [d for d, *_ in documents]
    first = {d for d, c in zip(ids, classes(ids, [t for _, t, *_ in documents])) if d == c}
    stay = {d: (t, s) for d, t, _, s in documents if d in first and not hit(t)}
    taken, size = collections.Counter(), collections.Counter()
    for d, (t, s) in stay.items():
        size[s] += len(spaced(secrets.redact(t, "[SECRET]")))
    copies = collections.Counter()
    for r in rows:
        assert r.doc_id in stay and r.text == secrets.redact(stay[r.doc_id][0], "[SECRET]") and r.n_chars == len(r.text)
        taken[r.source] += len(spaced(r.text))
        copies[r.doc_id, r["copy"]] += 1
    assert max(copies.values()) == 1
    assert 1.2 * sum(size.values()) < sum(taken.values()) < 1.8 * sum(size.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "secret_scan", "mix_sources"]
