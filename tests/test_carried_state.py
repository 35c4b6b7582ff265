"""State and counts that are carried instead of recomputed: the alarm stream's
boundary table, mergeable percentiles, exact AUC, serial ids, loads, retries."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from fixtures import ORDERS, SALES_HEADER, SALES_ROWS, order_json, write_text
from tidewater.operators import alarms as AL
from tidewater.operators import model as ML
from tidewater.plans import runners as J
from tidewater.sinks import audit, keyed, lake
from tidewater.streaming import arrivals
from tidewater.streaming import jobs as S

POINTS = "m STRING, ts TIMESTAMP, v DOUBLE"
T0 = dt.datetime(2024, 1, 1)


def points(path, rows):
    write_text(path, [json.dumps({"m": m, "ts": str(T0 + dt.timedelta(seconds=s)), "v": float(v)}) for m, s, v in rows])


def batch_edges(spark, src, n, end):
    stats = AL.window_stats(spark.read.schema(POINTS).json(src), "ts", "v", 300, keys=["m"], stats=("sum",))
    out = AL.alarm_transitions(stats.where(F.col("period_start") < end), "sum", 5, ">", n, 300, ["m"], end=F.lit(end))
    return sorted(tuple(r) for r in out.collect())


def alarm_stream(spark, tmp, n, delay="0 seconds"):
    stream = spark.readStream.schema(POINTS).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    S.start_alarm_stream(stream, "ts", "v", "sum", 300, n, 5, ">", ["m"], f"{tmp}/state", f"{tmp}/edges", f"{tmp}/ck", delay=delay).awaitTermination()


@pytest.mark.parametrize("n", [1, 2, 3])
def test_alarm_stream_over_many_batches_and_restarts_equals_batch(spark, tmp, n):
    r = random.Random(n)
    for f in range(6):
        rows = [(m, 300 * p + 10 * k, r.choice([0, 6, 6, 9])) for p in range(7 * f, 7 * f + 7) for k, m in enumerate("abc") if r.random() < 0.8]
        points(f"{tmp}/in/{f}.json", rows + [("tick", 300 * (7 * f + 7) - 1, 0)])
        if f in (2, 5):
            alarm_stream(spark, tmp, n)                       # stopped and started again
    points(f"{tmp}/in/9.json", [("tick", 300 * 60, 0)])       # silence, then time goes on
    alarm_stream(spark, tmp, n)
    got = sorted((r.m, r.period_start, r.state) for r in spark.read.parquet(f"{tmp}/edges").collect())
    end = max(x.f for x in [spark.read.parquet(f"{tmp}/state").agg(F.max("frontier").alias("f")).first()])
    want = batch_edges(spark, f"{tmp}/in", n, end)
    assert got == want and {s for *_, s in got} == {"ALARM", "OK"}
    assert len(got) == len(set(got))


def test_alarm_state_is_bounded_and_a_replayed_batch_changes_nothing(spark, tmp):
    for f in range(8):
        points(f"{tmp}/in/{f}.json", [(m, 300 * p, 9) for p in range(40 * f, 40 * f + 40) for m in "ab"])
    alarm_stream(spark, tmp, 2)
    folders = [d for d in os.listdir(f"{tmp}/state") if d.startswith("batch=")]
    assert len(folders) <= 2
    last = max(folders, key=lambda d: int(d.split("=")[1]))
    assert spark.read.parquet(f"{tmp}/state/{last}").count() <= 2 * 2 + 1         # N periods of two keys, and the frontier
    before = sorted(map(str, spark.read.parquet(f"{tmp}/edges").collect()))
    commits = f"{tmp}/ck/commits"
    newest = max(int(x) for x in os.listdir(commits) if x.isdigit())
    for name in (str(newest), f".{newest}.crc"):                                  # as if the driver was lost before the commit
        if os.path.exists(f"{commits}/{name}"):
            os.rename(f"{commits}/{name}", f"{tmp}/uncommitted{name}")
    alarm_stream(spark, tmp, 2)
    assert sorted(map(str, spark.read.parquet(f"{tmp}/edges").collect())) == before


def test_late_points_do_not_reopen_a_state(spark, tmp):
    points(f"{tmp}/in/0.json", [("a", 0, 9), ("a", 300, 9), ("a", 900, 0)])
    points(f"{tmp}/in/1.json", [("a", 1, 100), ("a", 1500, 0), ("a", 1801, 0)])   # second 1 is long closed
    alarm_stream(spark, tmp, 2)
    got = sorted((r.period_start, r.state) for r in spark.read.parquet(f"{tmp}/edges").collect())
    at = lambda s: T0 + dt.timedelta(seconds=s)
    assert got == [(at(300), "ALARM"), (at(600), "OK")]


# ---------------------------------------------------------------- W2: sketches
def _metric(spark, n, days=1):
    h = F.xxhash64("id")
    value = F.pmod(h, F.lit(10 ** 9)).cast("double") / 1e6
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("m"), value.alias("v"),
                                 F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(600 * days))).alias("ts"))


def test_sketches_are_exact_while_they_are_small(spark):
    df = _metric(spark, 4000)
    rolled = AL.merge_sketches(AL.window_sketches(df, "ts", "v", 60, ["m"]), 300, ["m"])
    got = {(r.m, r.period_start): (r.p, r["count"]) for r in rolled.withColumn("p", AL.sketch_percentile(0.99)).collect()}
    want = {}
    for r in df.collect():
        want.setdefault((r.m, dt.datetime.fromtimestamp(int(r.ts.timestamp()) // 300 * 300)), []).append(r.v)
    assert {k: v[1] for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for k, v in want.items():
        assert got[k][0] == sorted(v)[-(-99 * len(v) // 100) - 1]


def test_rolled_up_percentiles_keep_their_rank_error(spark):
    df = _metric(spark, 200_000)
    day = df.where("m = 'b'")
    parts = [AL.window_sketches(day.where(F.col("v") % 1 < 0.5), "ts", "v", 60, ["m"]), AL.window_sketches(day.where(F.col("v") % 1 >= 0.5), "ts", "v", 60, ["m"])]
    rolled = AL.merge_sketches(AL.merge_sketches(parts[0].unionByName(parts[1]), 120, ["m"]), 600, ["m"])
    row = rolled.select("count", *[AL.sketch_percentile(q).alias(f"q{int(q * 100)}") for q in (0.5, 0.9, 0.99)], F.length("sketch").alias("size")).first()
    assert row["count"] == day.count() and row["size"] < 200_000
    for q in (0.5, 0.9, 0.99):
        rank = day.where(F.col("v") <= row[f"q{int(q * 100)}"]).count() / row["count"]
        assert abs(rank - q) < 0.004


# ---------------------------------------------------------------- ML3: AUC
def brute_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


def test_auc_equals_brute_force(spark):
    r = random.Random(4)
    cases = [[(r.choice([0.1, 0.2, 0.3, 0.35, 0.9]), r.randrange(2)) for _ in range(200)], [(r.random(), r.randrange(2)) for _ in range(300)],
             [(0.5, k % 2) for k in range(50)], [(0.1, 1), (0.2, 1)], []]
    for rows in cases:
        df = spark.createDataFrame([*rows, (None, 1), (0.3, None)], "s double, y int").repartition(5)
        got = ML.rank_sum_auc(df, "s", "y").first()
        assert (got.positives, got.negatives) == (sum(y for _, y in rows), sum(1 - y for _, y in rows))
        want = brute_auc(rows)
        assert got.auc == want or abs(got.auc - want) < 1e-12


def test_auc_has_no_window_over_all_scores(spark):
    plan = ML.rank_sum_auc(spark.range(1000).selectExpr("id / 7.0 AS s", "id % 2 AS y"), "s", "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("windowspecdefinition(_range") >= 1


# ---------------------------------------------------------------- K10: serial ids
@pytest.mark.parametrize("split", ["128m", "600", "97"])
def test_serial_ids_do_not_depend_on_the_splits(spark, tmp, split):
    for f in range(3):
        write_text(f"{tmp}/in/{f}.csv", ["name,score", *[f"n{f}-{k},{k}" for k in range(150)]])
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        from tidewater.sources.files import read_csv
        df = read_csv(spark, f"{tmp}/in", "name STRING, score INT", path_col="source_file", block_col="source_block").where("score % 10 <> 3")
        got = {r.name: r.id for r in audit.with_serial_ids(df, last=1000).collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want = [f"n{f}-{k}" for f in range(3) for k in range(150) if k % 10 != 3]
    assert got == {n: 1001 + i for i, n in enumerate(want)}


def test_scores_have_serial_ids_across_runs(spark, tmp):
    write_text(f"{tmp}/b/a.csv", ["name,subject,score", "x,M,80", "y,M,60"])
    J.run_scores(spark, f"{tmp}/b", f"{tmp}/t")
    write_text(f"{tmp}/b/b.csv", ["Score,Name,Subject", "90,z,M", "91,z,M"])
    for _ in range(2):
        out = J.run_scores(spark, f"{tmp}/b", f"{tmp}/t")
        assert [(r.id, r.student_name, r.score) for r in out.orderBy("id").collect()] == [(1, "x", 80), (2, "y", 60), (3, "z", 90), (4, "z", 91)]


# ---------------------------------------------------------------- one row per document, whatever comes again
def test_two_reports_of_one_name_are_two_rows(spark, tmp):
    write_text(f"{tmp}/r/a.json", [json.dumps({"filename": "same", "data": [1, 2]})])
    write_text(f"{tmp}/r/b.json", [json.dumps({"filename": "same", "data": [3]})])
    for _ in range(2):
        dash = J.run_reports(spark, f"{tmp}/r", f"{tmp}/audit", f"{tmp}/outbox").first()
        assert (dash.total, dash.total_records) == (2, 3)
    rows = lake.read_partitioned(spark, f"{tmp}/audit").collect()
    assert len({r.id for r in rows}) == 2


def test_two_incidents_of_one_id_are_two_alerts(spark, tmp):
    for k in range(2):
        write_text(f"{tmp}/i/{k}.json", [json.dumps({"id": "evt", "message": f"m{k}", "severity": "HIGH"})])
    for _ in range(2):
        assert J.run_incidents(spark, f"{tmp}/i", f"{tmp}/store", f"{tmp}/logs", f"{tmp}/outbox") == {"alert": 2}
    texts = sorted(r.alert_text for r in spark.read.json(f"{tmp}/outbox").collect())
    assert texts == [f'High severity incident: {{"id":"evt","message":"m{k}","severity":"HIGH"}}' for k in range(2)]


def test_an_order_in_two_files_stays_one_when_they_come_again(spark, tmp):
    a = write_text(f"{tmp}/raw/a.json", [order_json(r) for r in ORDERS[:5]])
    b = write_text(f"{tmp}/raw/b.json", [order_json(r) for r in ORDERS[3:8]])
    for path in (f"{tmp}/raw", a, b, a, f"{tmp}/raw"):
        J.run_orders_etl(spark, path, f"{tmp}/lake")
        assert J.read_orders(spark, f"{tmp}/lake").count() == 8
        assert J.warehouse_rows(spark, f"{tmp}/lake").select("order_id").distinct().count() == 8


# ---------------------------------------------------------------- K1: loads
def _files(path):
    return [f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "/_" not in d]


def test_files_follow_bytes_and_not_loads(spark, tmp):
    for k in range(30):
        write_text(f"{tmp}/in/{k:02}.csv", [SALES_HEADER, *[r.replace("TXN", f"T{k}") for r in SALES_ROWS]])
    assert J.run_sales(spark, f"{tmp}/in", f"{tmp}/lake")["clean_rows"] == 300
    assert len(_files(f"{tmp}/lake")) == 1                         # one day, thirty loads
    J.run_sales(spark, f"{tmp}/in/07.csv", f"{tmp}/lake")          # one of them again: its day is packed anew
    assert len(_files(f"{tmp}/lake")) == 1 and lake.read_partitioned(spark, f"{tmp}/lake").count() == 300


def test_only_touched_days_are_read_and_written(spark, tmp):
    day = lambda d: [r.replace("2024-01-15", d).replace("TXN", d) for r in SALES_ROWS]
    a = write_text(f"{tmp}/in/a.csv", [SALES_HEADER, *day("2024-01-15"), *day("2024-01-16")])
    J.run_sales(spark, a, f"{tmp}/lake")
    J.run_sales(spark, write_text(f"{tmp}/in/b.csv", [SALES_HEADER, *day("2024-01-17")]), f"{tmp}/lake")
    kept = {f for f in _files(f"{tmp}/lake") if "day=17" in f}
    write_text(a, [SALES_HEADER, *day("2024-01-16")[:4]])
    J.run_sales(spark, a, f"{tmp}/lake")
    assert {f for f in _files(f"{tmp}/lake") if "day=17" in f} == kept
    got = {r.day: r["count"] for r in lake.read_partitioned(spark, f"{tmp}/lake").groupBy("day").count().collect()}
    assert got == {"16": 4, "17": 10}


def test_a_run_that_breaks_off_is_mended(spark, tmp, monkeypatch):
    a = write_text(f"{tmp}/in/a.csv", [SALES_HEADER, *SALES_ROWS])
    b = write_text(f"{tmp}/in/b.csv", [SALES_HEADER, *[r.replace("TXN", "B") for r in SALES_ROWS]])
    J.run_sales(spark, f"{tmp}/in", f"{tmp}/lake")
    real = lake.write_partitioned

    def dies(df, path, *args, **how):
        if how.get("mode") == "overwrite" and "lake-errors" not in path:
            import shutil
            for d in [d for d in os.listdir(path) if d.startswith("year=")]:
                shutil.move(f"{path}/{d}", f"{tmp}/taken-{d}")       # the old partition is gone, the new one is not there
            raise RuntimeError("driver lost")
        real(df, path, *args, **how)

    with monkeypatch.context() as m:
        m.setattr(lake, "write_partitioned", dies)
        with pytest.raises(RuntimeError):
            J.run_sales(spark, a, f"{tmp}/lake")
    J.run_sales(spark, b, f"{tmp}/lake")                            # any next run finishes it first
    assert lake.read_partitioned(spark, f"{tmp}/lake").count() == 20


def test_keyed_store_finishes_an_upsert_that_broke_off(spark, tmp, monkeypatch):
    path = f"{tmp}/kv"
    keyed.upsert_into(spark, path, spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("seq")), ["k"], "seq", buckets=4)
    late = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("seq"))

    def dies(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(lake, "write_partitioned", dies)
        with pytest.raises(RuntimeError):
            keyed.upsert_into(spark, path, late, ["k"], "seq")
    assert keyed.read_current(spark, path).where("seq = 1").count() == 10 and keyed.read_current(spark, path).count() == 100


# ---------------------------------------------------------------- A12: observed counts
def test_jobs_do_not_count_on_their_own(spark, tmp, monkeypatch):
    from pyspark.sql import DataFrame
    src = write_text(f"{tmp}/in/s.csv", [SALES_HEADER, *SALES_ROWS, "TXN-X,S,P,N,c,1,1,oops,2024-01-15,cash", "broken"])
    orders = write_text(f"{tmp}/raw/o.json", [order_json(r) for r in ORDERS] + ["{broken"])
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "count", lambda self: pytest.fail("a job counted"))
        assert J.run_sales(spark, src, f"{tmp}/lake") == {"raw_rows": 12, "clean_rows": 10, "rejected_rows": 2}
        assert J.run_orders_etl(spark, orders, f"{tmp}/olake") == {"rows": 20, "rejected": 1}


# ---------------------------------------------------------------- ST5: retry per file
def test_one_poison_file_among_ten(spark, tmp):
    for k in range(10):
        write_text(f"{tmp}/in/{k}.csv", ["id", str(k)])
    landed, tried = [], []

    def handle(session, paths):
        names = [int(os.path.basename(p)[:-4]) for p in paths]
        tried.append(names)
        if 4 in names:
            raise ValueError("cannot read 4")
        landed.extend(names)

    go = lambda: arrivals.process_arrivals(spark, f"{tmp}/in", f"{tmp}/outcomes", f"{tmp}/ck", handle, max_attempts=3)
    assert go() == {"done": 9, "failed": 1, "parked": 0}
    assert sorted(landed) == [0, 1, 2, 3, 5, 6, 7, 8, 9] and len(tried) <= 9
    write_text(f"{tmp}/in/10.csv", ["id", "10"])
    assert go() == {"done": 1, "failed": 1, "parked": 0}
    assert go() == {"done": 0, "failed": 0, "parked": 1}
    assert go() == {"done": 0, "failed": 0, "parked": 0}
    state = {os.path.basename(r.path): (r.status, r.attempts, r.error) for r in arrivals.outcomes(spark, f"{tmp}/outcomes").collect()}
    assert state["4.csv"] == ("parked", 3, "ValueError: cannot read 4") and state["10.csv"] == ("done", 1, None) and len(state) == 11


def test_fraud_queue_parks_an_unreadable_file(spark, tmp):
    header = ("transaction_id,amount,merchant_category,hour_of_day,day_of_week,user_account_age_days,"
              "previous_fraud_count,distance_from_home_km,is_foreign_transaction,transaction_frequency_24h")
    for k in range(3):
        write_text(f"{tmp}/in/{k}.csv", [header, f"t{k},125000,grocery,10,1,730,0,2.5,0,2"])
    with open(f"{tmp}/in/bad.csv.gz", "wb") as f:
        f.write(b"\x1f\x8b\x08 this is no gzip")
    os.rename(f"{tmp}/in/bad.csv.gz", f"{tmp}/in/bad.gz.csv")       # read as text: a file of one odd header
    out = J.run_fraud_queue(spark, f"{tmp}/in", f"{tmp}/feat", f"{tmp}/pq", dt.date(2024, 1, 15), f"{tmp}/outcomes", f"{tmp}/ck")
    assert out == {"done": 4, "failed": 0, "parked": 0}
    assert sorted(r.transaction_id for r in lake.read_partitioned(spark, f"{tmp}/pq").collect()) == ["t0", "t1", "t2"]
    assert spark.read.json(f"{tmp}/pq-errors").count() >= 1
