"""Dedup and keyed changes: determinism and metamorphic properties."""

from pyspark.sql import functions as F

from tidewater.operators import changes as M
from tidewater.operators.dedup import dedup_by_key, dedup_rows, keep_one, latest_by

ROWS = [(1, "2024-01-01", "a", 10.0), (1, "2024-01-02", "b", None), (1, "2024-01-02", "a", 5.0),
        (2, "2024-01-01", "c", 1.0), (2, "2024-01-01", "c", 1.0), (3, None, "d", 2.0)]
SCHEMA = "id int, ts string, v string, amount double"


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_one_independent_of_partitioning(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = _set(keep_one(df, ["id"]))
    b = _set(keep_one(df.repartition(3, "v").sortWithinPartitions(F.desc("ts")), ["id"]))
    assert a == b and len(a) == 3


def test_dedup_drops_incomplete_first(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r.id: r for r in dedup_by_key(df, ["id"], required=["id", "ts", "amount"]).collect()}
    assert set(out) == {1, 2}                     # id 3 has no ts
    assert out[1].amount is not None              # the null-amount copy never wins (T2)


def test_dedup_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert dedup_rows(df).count() == 5
    with_ids = df.withColumn("tx", F.monotonically_increasing_id())
    assert dedup_rows(with_ids, ignore=["tx"]).count() == 5        # id kept, not counted (T9)


def test_latest_by(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).na.drop(subset=["ts"])
    out = {r.id: r for r in latest_by(df, ["id"], "ts").collect()}
    assert out[1].ts == "2024-01-02" and out[1].v == "b"          # tie on ts broken by all columns


def test_upsert_last_write_wins_and_order_independent(spark):
    base = spark.createDataFrame([(1, "old", 1), (2, "keep", 1)], "k int, v string, seq int")
    ch1 = spark.createDataFrame([(1, "new", 2), (3, "ins", 1)], "k int, v string, seq int")
    ch2 = spark.createDataFrame([(1, "newer", 3)], "k int, v string, seq int")
    once = M.upsert(M.upsert(base, ch1, ["k"], "seq"), ch2, ["k"], "seq")
    swapped = M.upsert(M.upsert(base, ch2, ["k"], "seq"), ch1, ["k"], "seq")
    both = M.upsert(base, ch1.unionByName(ch2), ["k"], "seq")
    assert _set(once) == _set(swapped) == _set(both) == [(1, "newer", 3), (2, "keep", 1), (3, "ins", 1)]
    assert _set(M.upsert(once, ch1.unionByName(ch2), ["k"], "seq")) == _set(once)   # idempotent


def test_delete_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    dels = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    assert _set(M.delete_keys(df, dels, ["k"])) == [(1, "a"), (3, "c")]


def test_partial_update(spark):
    base = spark.createDataFrame([(1, "  one ", "d1"), (2, "two", "d2"), (3, "three", "d3"), (4, "four", "d4")],
                                 "id int, name string, description string")
    upd = spark.createDataFrame([(1, None, None, False), (2, "   ", "x", True), (3, " New ", None, True)],
                                "id int, name string, description string, has_description boolean")
    got = {r.id: (r.name, r.description) for r in M.partial_update(base, upd, "id").collect()}
    assert got == {1: ("one", "d1"), 2: ("", "x"), 3: ("New", None), 4: ("four", "d4")}


def test_fold_changelog(spark):
    log = spark.createDataFrame([(1, 1, "insert", "a"), (1, 2, "update", "b"), (2, 1, "insert", "c"),
                                 (2, 2, "delete", None), (3, 1, "insert", "d")], "k int, seq int, op string, v string")
    assert _set(M.fold_changelog(log, ["k"], "seq").select("k", "v")) == [(1, "b"), (3, "d")]


def test_dashboard_status_vocabulary(spark):
    # Writers store 'processed' / 'manual' but the dashboard counts 'completed' / 'failed'
    from tidewater.operators.reports import dashboard_stats
    rep = spark.createDataFrame([("processed", 3), ("manual", 0), ("failed", 2)], "status string, record_count int")
    as_reference = dashboard_stats(rep).first()
    assert (as_reference.total, as_reference.completed, as_reference.failed, as_reference.total_records) == (3, 0, 1, 5)
    ours = dashboard_stats(rep, completed=("completed", "processed")).first()
    assert ours.completed == 1
    empty = dashboard_stats(rep.limit(0)).first()
    assert (empty.total, empty.total_records) == (0, 0)          # COALESCE(SUM, 0)
