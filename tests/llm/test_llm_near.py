import collections
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, classes, prose  # noqa: E402

from tidewater.llm import _linking, fingerprint, near_dup  # noqa: E402
from tidewater.llm._words import mix  # noqa: E402


def _edited(text, every, shift=0):
    return " ".join(f"new{k}" if k % every == shift else w for k, w in enumerate(text.split(" ")))


def _case():
    base = [prose(k, 80 + 40 * k) for k in range(8)]
    texts = list(base)
    for k, t in enumerate(base):
        texts += [t, t + " tail", _edited(t, 97, 5), _edited(t, 60, 7), _edited(t, 25, 3), _edited(t, 23, k)]
    texts += ["a b c", "a b c", "a b", "x", *ODD, " ".join(["la"] * 300), " ".join(["la"] * 290), " ".join(["la"] * 100)]
    return [(k * 53) % 211 for k in range(len(texts))], texts


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
    left, right = np.concatenate([a, a[:90], a[:90], a[:20]]), np.concatenate([a[30:], a[:60], a[100:140]])
    l, r = collections.Counter(left.tolist()), collections.Counter(right.tolist())
    want = sum((l & r).values()) / sum((l | r).values())
    got = []
    for k in range(60):
        both = np.concatenate([mix(left + np.uint64(k)), mix(right + np.uint64(k))])
        s = near_dup.bag_signatures(both, np.array([0, len(left), len(both)]))
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - want) < 4 * np.std(got) / len(got) ** 0.5
    assert (near_dup.bag_signatures(both[:1], np.array([0, 0, 1])) != 0).all(axis=1).tolist() == [False, True]


def test_classes_against_brute_force(spark):
    ids, texts = _case()
    df = spark.createDataFrame([(d, t, b"x", "y") for d, t in zip(ids, texts)], "doc_id long, text string, node binary, class_id string")
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert got == dict(zip(ids, classes(ids, texts)))


def test_hot_group_without_a_common_centre(spark):
    """A chain: each text is near its neighbours only, yet all are one class."""
    words = prose(9, 500, 10 ** 6).split(" ")
    texts = [" ".join(words[k * 10:k * 10 + 200]) for k in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(classes(range(25), texts)))
    assert set(want.values()) == {0}
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()} == want


def test_sketches_tell_texts_apart():
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(1, 2 ** 63, 400))
    agree = near_dup.agreeing(0.8)
    assert 870 <= agree <= 880
    passed = {0.8: 0, 0.6: 0}
    for s in passed:
        for k in range(40):
            shared = int(round(400 * 2 * s / (1 + s)))
            other = np.concatenate([base[:shared], rng.integers(1, 2 ** 63, 400 - shared)])
            two = near_dup.pa.RecordBatch.from_arrays([near_dup.pa.array([b"a", b"b"]), near_dup.pa.array([mix(base.astype(np.uint64) + np.uint64(k)).view(np.int64).tolist(),
                                                                                                          mix(other.astype(np.uint64) + np.uint64(k)).view(np.int64).tolist()])], names=["node", "elements"])
            a, b = next(near_dup._sketch(iter([two]))).column(1).to_pylist()
            passed[s] += 1024 - sum(bin((x ^ y) & (2 ** 64 - 1)).count("1") for x, y in zip(a, b)) >= agree
    assert passed[0.8] == 40 and passed[0.6] <= 3


def test_crowd_around_a_centre(spark):
    """Copies of one text, changed more and more, and pairs that are near each
    other only: what a large group's later rounds have to find."""
    import random
    r = random.Random(3)
    base, texts = prose(4, 300, 10 ** 5).split(" "), []
    for k in range(160):
        w = list(base)
        for at in r.sample(range(300), k * 60 // 160):
            w[at] = f"n{k}x{at}"
        texts.append(" ".join(w))
        if k % 8 == 7:
            w[r.randrange(300)] = "twin"
            texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(classes(range(len(texts)), texts)))
    assert len(set(want.values())) > 5
    assert {x.doc_id: x.class_id for x in near_dup.near_duplicates(df).collect()} == want


@pytest.mark.parametrize("pairwise", [16_384, 0])
def test_crowd_of_hardly_similar_texts(spark, monkeypatch, pairwise):
    """Copies of a text that is not there itself, each nearly similar to all
    others: what is verified does not grow with the square of their number."""
    import random
    r = random.Random(5)
    base, texts, verified = prose(6, 300, 10 ** 5).split(" "), [], []
    for k in range(150):
        w = list(base)
        for at in r.sample(range(0, 300, 6), 4 + k % 2):
            w[at] = f"n{k}x{at}"
        texts.append(" ".join(w))
    texts += [t + " tail" for t in texts[::30]]
    seen = _linking.similarities

    def similarities(pairs, sets, name):
        verified.append(pairs.count())
        return seen(pairs, sets, name)

    monkeypatch.setattr(_linking, "similarities", similarities)
    monkeypatch.setattr(_linking, "PAIRWISE_NODES", pairwise)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(classes(range(len(texts)), texts)))
    assert len(set(want.values())) > 20
    assert {x.doc_id: x.class_id for x in near_dup.near_duplicates(df).collect()} == want
    assert sum(verified[1 if pairwise else 2:]) <= 3 * len(texts), verified


def test_carried_sets_share_no_less(spark):
    one, two = [1, 2, 1 << 40], [5, 5 + (1 << 31)]
    sets = spark.createDataFrame([(b"a", one), (b"b", two), (b"c", list(range(_linking.CARRIED_ELEMENTS + 1)))], "node binary, elements array<long>")
    assert [(bytes(x.node), len(x.own)) for x in _linking.carried(sets).collect()] == [(b"a", 3)]


def test_keep_one(spark):
    ids, texts = _case()
    rows = [(d, t, "k") for d, t in zip(ids, texts)] + [(ids[0], texts[0], "k"), (None, texts[1], "k"), (None, "only here and nowhere else", "k"), (None, None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = near_dup.keep_one(df)
    assert out.columns == df.columns
    want = [d for d, c, t in zip(ids, classes(ids, texts), texts) if d == c]
    got = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert got == sorted(want)
    assert sorted(str(r.text) for r in out.collect() if r.doc_id is None) == ["None", "only here and nowhere else"]
    assert near_dup.keep_one(df.limit(0)).count() == 0


# SpotSigs

def _sets(text):
    import re
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    content = [x for x in w if x not in fingerprint.ANCHORS]
    out, seen = set(), 0
    for x in w:
        if x in fingerprint.ANCHORS:
            if seen + 3 <= len(content):
                out.add((x, *content[seen:seen + 3]))
        else:
            seen += 1
    if not out and w:
        out = {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
    return out | ({(x,) for x in content} if len(w) < fingerprint.SHORT else set())


def _anchored(seed, n):
    words = prose(seed, n, 300).split(" ")
    return " ".join(f"{w} {fingerprint.ANCHORS[(seed * 7 + k * k) % 40]}" if k % 3 else w for k, w in enumerate(words))


def test_fingerprints_and_likeness_against_sets(spark):
    texts = [_anchored(k, 5 + 40 * k) for k in range(8)] + [*ODD, "the the the", "of a b c", "of a b", prose(3, 200), _anchored(3, 125) + " more words here", "The OF a b c"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, own string").drop("own")
    signed = fingerprint.add_signatures(df, own=fingerprint.F.col("text"))
    rows = {r.doc_id: r.own for r in signed.collect()}
    for a in range(len(texts)):
        assert len(rows[a]) == len(_sets(texts[a])) and rows[a] == sorted(set(rows[a]))
    pairs = spark.createDataFrame([(a, b, rows[a], rows[b]) for a in rows for b in rows], "a long, b long, x array<long>, y array<long>")
    for r in pairs.select("a", "b", fingerprint.likeness(fingerprint.F.col("x"), fingerprint.F.col("y")).alias("j")).collect():
        s, t = _sets(texts[r.a]), _sets(texts[r.b])
        assert abs(r.j - (len(s & t) / len(s | t) if s | t else 1.0)) < 1e-12


def test_next_and_edited(spark):
    rows = [(k * 3, f"{k}é🙂" * (k % 9)) for k in range(4000)] + [(6, "tie"), (None, "loose"), (9, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int")
    got = fingerprint.with_next(df)
    found = sorted((r.doc_id, r.text, r.next_text) for r in got.collect() if r.doc_id is not None)
    order = sorted(((d, t or "") for d, t in rows if d is not None), reverse=True)
    assert found == sorted((d, t, order[(k + 1) % len(order)][1]) for k, (d, t) in enumerate(order))
    assert [(r.text, r.next_text) for r in got.where("doc_id IS NULL").collect()] == [("loose", "")]
    F = fingerprint.F
    for r in got.select("text", "next_text", fingerprint.edited(F.col("text"), F.col("next_text")).alias("e")).collect():
        half = len(r.text) // 2
        assert r.e == r.text[:len(r.text) - half] + r.next_text[:half]
    assert fingerprint.with_next(df.limit(0)).count() == 0
    assert [tuple(r) for r in fingerprint.with_next(df.where("doc_id = 3")).collect()] == [(3, "1é🙂", "1é🙂")]


def test_spot_classes_against_brute_force(spark):
    texts = []
    for k in range(6):
        t = _anchored(k, 60 + 50 * k)
        texts += [t, t, t + " " + prose(90 + k, 4), _edited(t, 40, 3), _edited(t, 9, 2)]
    texts += ODD
    sets, n = [_sets(t) for t in texts], len(texts)
    parent = list(range(n))
    for a in range(n):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
                parent = [new if p == old else p for p in parent]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in fingerprint.near_duplicates(df).collect()} == dict(enumerate(parent))


def test_fingerprint_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "the a b c")], "doc_id long, text string")
    plan = fingerprint.add_signatures(fingerprint.with_next(df), s=fingerprint.F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
