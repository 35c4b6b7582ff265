"""What a run of the lake and of the keyed store moves: tasks by rows, only
repeated loads staged, rows written once."""

import os

from pyspark.sql import functions as F

from tidewater.sinks import keyed, lake


def _files(path):
    return {f for at, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(lake, "TASK_ROWS", 10)
    df = spark.range(300).select(F.col("id"), (F.col("id") % 60).alias("d"))
    run = df.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    assert lake._spread(df, run, ["d"]).rdd.getNumPartitions() == 30
    assert lake._spread(df.limit(0), run.limit(0), ["d"]).count() == 0


def test_only_repeated_loads_are_staged(spark, tmp, monkeypatch):
    staged, path = [], f"{tmp}/lake"
    real = lake.overwrite_staged

    def seen(df, *rest, **named):
        staged.append(sorted(tuple(r) for r in df.select("v", lake.LOAD).collect()))
        real(df, *rest, **named)

    monkeypatch.setattr(lake, "overwrite_staged", seen)
    rows = lambda *r: spark.createDataFrame(list(r), f"v INT, day STRING, {lake.LOAD} STRING")
    lake.write_load(rows((1, "01", "a"), (2, "02", "a"), (3, None, "a")), path, ["day"])
    lake.write_load(rows((9, "01", "x")), path, ["day"])
    assert staged == []
    # a comes again with another row of a new day, b and a null load are new
    lake.write_load(rows((4, "01", "a"), (5, "03", "a"), (6, "01", "b"), (7, None, "b"), (8, "02", None)), path, ["day"])
    assert staged == [[(4, "a"), (9, "x")]]
    got = sorted((r.v, r.day, r[lake.LOAD]) for r in lake.read_loads(spark, path).collect())
    assert got == [(4, "01", "a"), (5, "03", "a"), (6, "01", "b"), (7, None, "b"), (8, "02", None), (9, "01", "x")]
    assert not [f for f in os.listdir(path) if f.startswith("_staged") or f == "_pending"]


def test_staged_files_are_moved_and_a_broken_move_is_finished(spark, tmp, monkeypatch):
    path, names, real = f"{tmp}/store", [], lake.finish_pending

    def broken(spark, at):
        stage = [f for f in os.listdir(at) if f.startswith("_staged")] if os.path.isdir(at) else []
        if stage:
            names.append(_files(f"{at}/{stage[0]}"))
            one = [f for f in os.listdir(f"{at}/{stage[0]}") if "=" in f][0]
            if os.path.isdir(f"{at}/{one}"):         # taken away, and the run breaks off
                os.rename(f"{at}/{one}", f"{tmp}/gone-{len(names)}")

    change = lambda *r: spark.createDataFrame(list(r), "k INT, v STRING")
    keyed.upsert_into(spark, path, change(*[(k, "old") for k in range(40)]), ["k"], buckets=4)
    monkeypatch.setattr(lake, "finish_pending", broken)
    keyed.upsert_into(spark, path, change(*[(k, "new") for k in range(0, 40, 2)]), ["k"])
    monkeypatch.setattr(lake, "finish_pending", real)
    assert names[0]
    got = {r.k: r.v for r in keyed.read_current(spark, path).collect()}
    assert got == {k: "new" if k % 2 == 0 else "old" for k in range(40)}
    assert names[0] <= {f for at, _, fs in os.walk(path) if "_bucket=" in at for f in fs}


def test_large_buckets_are_written_where_they_were_merged(spark, tmp, monkeypatch):
    dealt, real = [], lake.overwrite_staged

    def seen(df, *rest, **named):
        dealt.append("REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString())
        real(df, *rest, **named)

    monkeypatch.setattr(lake, "overwrite_staged", seen)
    change = lambda v: spark.range(200).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    for limit, v in ((200_000, "a"), (10, "b"), (99, "c"), (100, "d")):
        monkeypatch.setattr(keyed, "BUCKET_ROWS", limit)
        keyed.upsert_into(spark, f"{tmp}/store", change(v), ["k"], buckets=4)
        assert {(r.k, r.v) for r in keyed.read_current(spark, f"{tmp}/store").collect()} == {(k, v) for k in range(200)}
    assert dealt == [True, False, False, True]


def test_dead_letters_are_compressed_and_read_back(spark, tmp):
    bad = spark.createDataFrame([("x", "why", "f", "l1"), ("y", "why", "g", "l2")], f"record STRING, reason STRING, source_file STRING, {lake.LOAD} STRING")
    for _ in range(2):
        lake.dead_letter(bad, f"{tmp}/dead", "job", as_read=True)
    assert all(f.endswith(".json.gz") for f in _files(f"{tmp}/dead"))
    assert sorted((r.record, r[lake.LOAD]) for r in spark.read.json(f"{tmp}/dead").collect()) == [("x", "l1"), ("y", "l2")]
