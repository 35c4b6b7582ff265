import os
import re
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, prose  # noqa: E402

from tidewater.llm import decontaminate as d  # noqa: E402


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _brute(text, items, n=10):
    w, hit, found = _words(text), set(), set()
    for item, t in items:
        b = _words(t)
        size = min(n, len(b))
        grams = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(item)
    return len(w), len(hit), sorted(found, key=str)


def _case():
    items = [(k, prose(k, 25, 60)) for k in range(6)] + [(10, "Short ITEM"), (11, None), (12, ""), (13, "?!"), (14, prose(2, 25, 60)), (15, "é")]
    texts = [prose(50 + k, 200, 60) for k in range(6)]
    texts += [prose(60, 20) + " " + items[k][1].upper().replace(" ", " - ") + ", " + prose(61, 9) for k in range(6)]
    texts += [items[0][1][:70], "a short item, Short--Item shortitem", " ".join([items[1][1]] * 4), "É é é", *ODD, prose(70, 30_000, 60)]
    return items, texts


def test_against_brute_force_in_one_and_many_blocks(spark):
    items, texts = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(k, "clash", t) for k, t in enumerate(texts)] + [(0, "clash", texts[0])], "doc_id long, spans string, text string")
    want = {k: _brute(t, items) for k, t in enumerate(texts)}
    for block in (d.BLOCK_BYTES, 300):
        out = d.find_contamination(df, bench, block_bytes=block, shard_bytes=3000)
        assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]
        rows = out.collect()
        assert len(rows) == len(texts) + 1
        for r in rows:
            assert (r.n_words, r.n_hit, r["items"]) == want[r.doc_id]
            assert sum(s.end - s.start for s in r.spans) == r.n_hit
            data = (r.text or "").encode()
            for s in r.spans:
                assert len(_words(data[s.first_byte:s.last_byte].decode())) == s.end - s.start


def test_index_finds_every_place():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 4, 3000)
    text[-1] = 0
    index = d.FMIndex(text, 4)
    for n in (1, 2, 5):
        patterns = rng.integers(1, 4, (40, n)).astype(np.int32)
        lo, hi = index.search(patterns)
        for p, a, b in zip(patterns, lo, hi):
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in d.find_contamination(docs, none, keep_text=False).collect()] == [(1, 3, 0, [], [])]
    assert d.find_contamination(docs.limit(0), none).count() == 0
