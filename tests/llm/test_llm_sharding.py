import collections
import itertools
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD, prose  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tidewater.llm import sharding  # noqa: E402


def sums(sizes, where, k):
    out = [0] * k
    for s, w in zip(sizes, where):
        out[w] += s
    return out


def greedy(sizes, k):
    """Largest first into the emptiest shard."""
    out = [0] * k
    for s in sorted(sizes, reverse=True):
        out[out.index(min(out))] += s
    return max(out) - min(out)


def test_differencing_two_shards_by_hand():
    # 8 7 6 5 4 -> 8-7=1, 6-5=1, 4-1=3, 3-1=2: a difference of 2
    where = sharding.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sums([8, 7, 6, 5, 4], where, 2)) == [14, 16]


@pytest.mark.parametrize("k", [2, 3, 5])
def test_differencing_near_the_optimum(k):
    r = random.Random(k)
    for _ in range(20):
        sizes = [r.randrange(1, 50) for _ in range(8)]
        best = min(max(x) - min(x) for w in itertools.product(range(k), repeat=8) for x in [sums(sizes, w, k)])
        got = sums(sizes, sharding.differencing(sizes, k), k)
        assert sum(got) == sum(sizes) and max(got) - min(got) <= best + max(sizes)


def test_differencing_beats_greedy_on_many_sizes():
    r = random.Random(1)
    sizes = [int(r.lognormvariate(8, 1)) + 1 for _ in range(4000)]
    got = sums(sizes, sharding.differencing(sizes, 16), 16)
    assert max(got) - min(got) <= greedy(sizes, 16) and max(got) - min(got) < 50


def test_differencing_small_cases():
    assert sharding.differencing([], 4) == [] and sharding.differencing([5], 4) == [0]
    assert sorted(sharding.differencing([1, 1, 1, 1], 4)) == [0, 1, 2, 3]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def check(rows, texts, shards=16):
    """Sizes, groups in one shard, gapless slots."""
    by_shard, by_text = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "bytes"
        assert 0 <= r["shard"] < shards
        by_shard[r["shard"]].append(r["slot"])
        by_text[t].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_shards(spark):
    texts = dict(enumerate([*ODD, *[prose(k, 1 + k % 200) for k in range(1500)], *["same text"] * 700]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    out = rows_of(sharding.shard_documents(df))
    check(out, texts)
    assert len(out) == len(texts)
    sizes = [r["size"] for r in out]
    got = sums(sizes, [r["shard"] for r in out], 16)
    assert max(got) - min(got) < 50


def test_group_larger_than_a_shard_is_alone(spark):
    texts = {k: "x" * 300 for k in range(200)} | {1000 + k: prose(k, 5) for k in range(900)}
    out = rows_of(sharding.shard_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    check(out, texts)
    hot = {r["shard"] for r in out if r["doc_id"] < 200}
    assert len(hot) == 1 and not [r for r in out if r["doc_id"] >= 1000 and r["shard"] in hot]
    rest = [s for k, s in enumerate(sums([r["size"] for r in out], [r["shard"] for r in out], 16)) if k not in hot]
    assert max(rest) - min(rest) < 50


def test_units_and_blocks_bound_the_work(spark):
    texts = {k: prose(k, 3 + k % 40) for k in range(3000)}
    rows = sharding.measured(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), keep_text=False)
    assert sharding.place_units(rows, 4, units=64).count() <= 128
    out = rows_of(sharding.assign_shards(rows, 4, units=64, block_rows=50))
    check(out, texts, 4)
    got = sums([r["size"] for r in out], [r["shard"] for r in out], 4)
    assert max(got) - min(got) < 0.02 * sum(got)


def test_repeated_rows_nulls_clashing_columns_and_empty_table(spark):
    rows = [(None, None, 9, 9), (None, None, 9, 9), (1, "a", 0, 0), (1, "a", 0, 0), (2, "", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int, shard int")
    out = rows_of(sharding.shard_documents(df))
    check(out, {None: None, 1: "a", 2: ""})
    assert len(out) == 5 and set(out[0]) == {"doc_id", "text", "size", "text_crc32", "law", "shard", "slot"}
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_written_shards_hold_slots_in_order(spark, tmp):
    texts = {k: prose(k, 1 + k % 30) for k in range(500)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sharding.write_shards(df, f"{tmp}/out", shards=4, file_rows=40)
    back = rows_of(spark.read.parquet(f"{tmp}/out").withColumn("shard", __import__("pyspark").sql.functions.col("shard").cast("int")))
    check(back, texts, 4)
    for s in range(4):
        files = [f for f in os.listdir(f"{tmp}/out/shard={s}") if f.endswith(".parquet")]
        assert len(files) >= 2
        for f in files:
            slots = [r.slot for r in spark.read.parquet(f"{tmp}/out/shard={s}/{f}").collect()]
            assert slots == sorted(slots)


def test_query_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = rows_of(E.queries()["op13_shards"](spark, sf))
    check(out, texts)
    assert len(out) == len(texts) and all(r["grown_shard"] is None for r in out)
    big = collections.Counter()
    for t in texts.values():
        big[t] += len(t.encode()) + 1
    got = sums([r["size"] for r in out], [r["shard"] for r in out], 16)
    assert max(got) - min(got) <= greedy(list(big.values()), 16) and max(got) - min(got) < 0.02 * sum(got) / 16
