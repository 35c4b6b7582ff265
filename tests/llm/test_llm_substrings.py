import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, kept_words, prose, spaced  # noqa: E402

from tidewater.llm import substrings  # noqa: E402


def _run(spark, rows, schema="doc_id long, text string", **how):
    df = spark.createDataFrame(rows, schema)
    return {r.doc_id: r for r in substrings.remove_repeats(df, **how).collect()}


def test_against_brute_force_with_many_batches_and_ranges(spark):
    shared = prose(1, 60)
    texts = [prose(k, 120) for k in range(2, 30)]
    texts += [prose(40 + k, 30) + " " + shared + "\n" + prose(70 + k, 5) for k in range(12)]
    texts += [texts[0], texts[0], prose(3, 120) + " tail", prose(1, 20), *ODD, " ".join([shared] * 3), prose(2, 12), prose(2, 13)]
    ids = [(k * 37) % 101 for k in range(len(texts))]
    got = _run(spark, list(zip(ids, texts)), batch_bytes=2000, range_bytes=500)
    for d, t, (removed, left) in zip(ids, texts, kept_words(ids, texts)):
        assert (got[d].n_words, got[d].n_removed, got[d].kept_text) == (len(spaced(t)), removed, left)
        assert sum(s.end - s.start for s in got[d].removed) == removed


def test_equal_and_null_ids(spark):
    t = prose(5, 40)
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, t), (2, t)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(df).collect())
    assert got == [(False, 1, 0), (False, 1, 0), (False, 2, 40), (True, 0, 40), (True, 0, 40)]


def test_levels_follow_the_longest_repeat(spark):
    long = prose(7, 300)
    words = long.split(" ")
    rows = [(1, long), (2, prose(8, 30) + " " + " ".join(words[10:70])), (3, prose(9, 40)), (4, " ".join(words[200:214])), (5, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.remove_repeats(df).select("batch", "doc_id", "longest", "repeats")
    got = {r.doc_id: r.longest for r in substrings.extend(found).collect()}
    assert got == {1: 52, 2: 52, 3: 0, 4: 13, 5: 300}


def test_empty_table_extra_columns_and_long_text(spark):
    assert _run(spark, []) == {}
    long = prose(11, 200_000, 10 ** 9)
    df = spark.createDataFrame([(1, long, 5, "b"), (2, "x " + long, 6, "c"), (3, "z" * 3_000_000, 7, "d")],
                               "doc_id long, text string, batch long, n_words string")
    got = {r.doc_id: (r.n_words, r.n_removed, len(r.kept_text)) for r in substrings.remove_repeats(df).collect()}
    assert got == {1: (200_000, 0, len(long)), 2: (200_001, 200_000, 1), 3: (1, 0, 3_000_000)}
