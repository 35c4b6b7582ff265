import math
import os
import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, prose  # noqa: E402

from tidewater.llm import ranking  # noqa: E402

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    """Every document's score for every item, (item, rank, doc, score)."""
    bags = [(d, _terms(t)) for d, t in docs]
    bags = [(d, w) for d, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w in bags)
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(_terms(t))
    out = []
    for i, q in queries.items():
        scored = []
        for d, w in bags:
            m = 50 + 50 * len(w) * n_docs // n_terms
            s = 0
            for t in q:
                if tf := w.count(t):
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    rare = [f"rare{k}" for k in range(40)]
    docs = [(k, prose(k, 1 + (k * 13) % 120) + " " + " ".join(r.choices(rare, k=k % 4))) for k in range(600)]
    docs += [(1000 + k, docs[7][1]) for k in range(120)]                      # ties beyond k
    docs += [(2000 + k, t) for k, t in enumerate(ODD)] + [(3, docs[3][1]), (None, docs[9][1]), (None, None)]
    items = [(k, prose(900 + k, 20) + " " + r.choice(rare)) for k in range(25)]
    items += [(90, docs[7][1]), (91, ""), (92, None), (93, "none such"), (1, "w1 W2, w1"), (None, "w5"), (94, "漢字 É é")]
    return docs, items


def test_equal_to_brute_force(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, DOCS).repartition(3)
    assert got(ranking.rank_documents(d, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_small_shards_and_blocks_change_nothing(spark, corpus, monkeypatch):
    docs, items = corpus
    q = ranking.rank_documents(spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(items, ITEMS), k=7, block_bytes=400)
    assert got(q) == brute(docs, items, 7)


def test_accumulators_are_limited_and_results_are_not():
    """Shard by shard, with the bound of earlier shards, against full scores."""
    r = np.random.default_rng(3)
    terms = [np.sort(r.choice(50, size=12, replace=False)) for _ in range(3000)]
    terms = [np.append(t, 50) if k < 60 else t for k, t in enumerate(terms)]       # term 50 is rare and heavy
    n = np.array([len(t) for t in terms])
    cut, flat = np.append(0, np.cumsum(n)), np.concatenate(terms)
    shard = ranking.Shard(n, cut, flat, np.ones(len(flat), int), 3000, int(n.sum()))
    weights = np.append(np.full(50, 3), 9000)
    order = np.append(50, np.arange(50))
    docs, score = shard.best(order, weights[order], 50, 0, np.arange(3000))
    full = np.zeros(3000, np.int64)
    for t in range(51):
        p = slice(*shard.cut[[t, t + 1]])
        full[shard.doc[p]] += weights[t] * shard.gain[p]
    want = np.lexsort((np.arange(3000), -full))[:50]
    assert sorted(docs) == sorted(want) and sorted(score) == sorted(full[want]) and max(docs) < 60
    assert len(shard.best(order, weights[order], 50, int(full.max()) + 1, np.arange(3000))[0]) == 0


def test_norm_without_overflow():
    n = np.array([1, 10**7])
    assert list(ranking.length_norm(n, 3 * 10**10, 10**13)) == [50 + 50 * 3 * 10**10 // 10**13, 50 + 50 * 10**7 * 3 * 10**10 // 10**13]


def test_empty_tables_other_ids_and_clashing_columns(spark, corpus):
    docs, items = corpus
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert got(ranking.rank_documents(d.limit(0), i)) == [] and got(ranking.rank_documents(d, i.limit(0))) == []
    assert ranking.rank_documents(d, i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    odd = d.selectExpr("concat('d', doc_id) AS name", "text AS body", "1 AS score", "2 AS n", "3 AS salt").where("name IS NOT NULL")
    out = got(ranking.rank_documents(odd, i.where("item_id = 1"), doc="name", text="body", k=3))
    assert len(out) == 3 and all(x[2].startswith("d") for x in out)


def test_very_long_text(spark):
    docs = [(1, "a " * 400_000 + "needle"), (2, "needle"), (3, "b")]
    out = got(ranking.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(0, "needle a")], ITEMS)))
    assert out == brute(docs, [(0, "needle a")])
