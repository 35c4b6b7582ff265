import math
import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, prose, spaced  # noqa: E402

from tidewater.llm import mixing  # noqa: E402


def _water(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by raising the level until the share is spent."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= level * w[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_and_closeness(spark):
    rows = [(k, ["b", "a", None, "c", "d", "ab"][k % 6 if k % 3 else 0], prose(k, 1 + (k * 7) % 90)) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.decisions(df).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(spaced(t))
    want = _water(sizes)
    taken = {}
    for r in got:
        assert math.isclose(r["__target"], want[r["__source"]], rel_tol=1e-12)
        assert r["__copies"] <= 2
        taken[r["__source"]] = taken.get(r["__source"], 0) + r["__size"] * r["__copies"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 200 + 0.02 * want[s]
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.decisions(df.repartition(7)).collect()), key=str)


def test_mix_emits_copies_and_keeps_columns(spark):
    rows = [(k, "s", t, k) for k, t in enumerate([*ODD, "a b c", "a b c"])] + [(3, "s", "x", 3), (None, None, "q r", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, copy long")
    out = mixing.mix_sources(df)
    assert out.columns == ["doc_id", "source", "text", "copy"]
    want = {(r["__doc"], r["__source"], r["__size"]): r["__copies"] for r in mixing.decisions(df).collect()}
    per_row = {}
    for r in out.collect():
        key = (r.doc_id, r.source, len(spaced(r.text)))
        per_row.setdefault(key, []).append(r.copy)
    for key, copies in want.items():
        times = sum((d, s, len(spaced(t))) == key for d, s, t, _ in rows)
        assert sorted(per_row.get(key, [])) == sorted(list(range(copies)) * times)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_the_query_has_one_row_per_row(spark, tmp):
    from tidewater.llm import queries
    rows = [(k, prose(k, 3 + k % 20), "en", "x" if k % 3 else "y", 1) for k in range(300)] * 2 + [(None, None, None, None, 0)] * 3
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    got = queries.op2_mix_sources(spark, tmp).collect()
    assert len(got) == len(rows)
    taken, target = {}, {}
    for r in got:
        s = None if r.doc_id is None else ("x" if r.doc_id % 3 else "y")
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in taken)
    one = {}
    for r in got:
        assert one.setdefault(r.doc_id, r.taken) == r.taken
    copies = mixing.mix_sources(spark.read.parquet(f"{tmp}/documents.parquet")).groupBy("source").count().collect()
    assert sum(r["count"] for r in copies) == sum(r.taken // r.size for r in got if r.size)
