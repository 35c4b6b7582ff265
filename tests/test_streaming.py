"""Structured Streaming: envelope stream -> enrich -> fan-out (exactly-once
by batch id), raw landing with dead letter, stream dedup, CSV arrivals."""

import base64
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from fixtures import ORDERS, order_json, write_text
from tidewater.sinks.fanout import folder_writer
from tidewater.streaming import jobs as S

ORDER_SCHEMA = ("order_id STRING, customer_id STRING, product_id STRING, product_name STRING, category STRING, "
                "quantity INT, unit_price DOUBLE, total_amount DOUBLE, order_status STRING, payment_method STRING, "
                "region STRING, timestamp STRING")


def _envelopes(folder, rows, start=0):
    lines = []
    for i, payload in enumerate(rows):
        data = base64.b64encode(payload.encode()).decode() if payload is not None else "%%%not-base64"
        lines.append(json.dumps({"sequence_number": str(start + i), "partition_key": "k", "data": data}))
    return write_text(os.path.join(folder, f"part-{start:05d}.json"), lines)


def test_enrich_fanout_exactly_once(spark, tmp):
    src, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    first = _envelopes(src, [order_json(r) for r in ORDERS[:10]], 0)
    _envelopes(src, [order_json(r) for r in ORDERS[10:]] + ["{broken", None], 10)
    stream = S.enrich(S.envelope_stream(spark, src, max_files_per_trigger=1), ORDER_SCHEMA)
    writers = {"lake": folder_writer(f"{out}/lake", where=~F.col("failed")),
               "dead": folder_writer(f"{out}/dead", where=F.col("failed")),
               "direct": None}                                   # optional path switched off
    S.start_fanout(stream, writers, ck).awaitTermination()
    lake = spark.read.json(f"{out}/lake")
    assert lake.count() == 20 and lake.select("order_id").distinct().count() == 20
    assert {r.category for r in lake.select("category").distinct().collect()} >= {"food_beverage", "home_appliance"}
    assert spark.read.json(f"{out}/dead").count() == 2
    assert lake.where("category_missing").count() == 0
    # replaying a batch id rewrites its own folder: no duplicates
    replay = S.enrich(spark.read.schema(S.ENVELOPE_SCHEMA).json(first), ORDER_SCHEMA)
    writers["lake"](replay, 0)
    assert spark.read.json(f"{out}/lake").count() == 20
    # restarting on the same checkpoint reads nothing new
    S.start_fanout(S.enrich(S.envelope_stream(spark, src), ORDER_SCHEMA), writers, ck).awaitTermination()
    assert spark.read.json(f"{out}/lake").count() == 20


def test_stream_equals_batch(spark, tmp):
    src, ck = f"{tmp}/in", f"{tmp}/ck"
    _envelopes(src, [order_json(r) for r in ORDERS], 0)
    clock = F.lit("2024-02-01 00:00:00").cast("timestamp")
    collected = []

    def sink(df, batch_id):
        collected.extend(tuple(r) for r in df.select("order_id", "category", "processed_at").collect())

    S.run_available_now(S.enrich(S.envelope_stream(spark, src), ORDER_SCHEMA, clock), sink, ck)
    batch = S.enrich(spark.read.schema(S.ENVELOPE_SCHEMA).json(src), ORDER_SCHEMA, clock)
    assert sorted(collected) == sorted(tuple(r) for r in batch.select("order_id", "category", "processed_at").collect())


def test_raw_landing_with_error_prefix(spark, tmp):
    src = f"{tmp}/in"
    _envelopes(src, [order_json(r) for r in ORDERS[:2]] + [order_json(ORDERS[2], category=None), "{bad"], 0)
    q = S.land_raw(S.enrich(S.envelope_stream(spark, src), ORDER_SCHEMA), f"{tmp}/raw", f"{tmp}/err",
                   f"{tmp}/ck", available_now=True)
    q.awaitTermination()
    raw = spark.read.json(f"{tmp}/raw")
    assert raw.count() == 3 and {"year", "month", "day", "hour"} <= set(raw.columns)
    flagged = raw.where("category_missing").select("order_id", "category").collect()
    assert [(r.order_id, r.category) for r in flagged] == [("ORD-20240115-000003", "")]
    assert spark.read.json(f"{tmp}/err").count() == 1


def test_stream_dedup_within_watermark(spark, tmp):
    src = f"{tmp}/in"
    rows = [{"id": "a", "ts": "2024-01-01 00:00:00"}, {"id": "a", "ts": "2024-01-01 00:00:10"},
            {"id": "b", "ts": "2024-01-01 00:01:00"}]
    write_text(f"{src}/p0.json", [json.dumps(r) for r in rows])
    stream = spark.readStream.schema("id STRING, ts TIMESTAMP").json(src)
    got = []
    q = (S.dedup_stream(stream, ["id"], "ts", "10 minutes").writeStream
         .foreachBatch(lambda df, i: got.extend(r.id for r in df.collect()))
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(got) == ["a", "b"]


def test_csv_arrivals_suffix_and_prefix(spark, tmp):
    src = f"{tmp}/data/sales"
    write_text(f"{src}/a.csv", ["id,v", "1,x"])
    write_text(f"{src}/b.CSV", ["id,v", "2,y"])
    write_text(f"{src}/c.txt", ["id,v", "3,z"])
    got = []
    q = (S.csv_arrivals(spark, src, "id INT, v STRING").writeStream
         .foreachBatch(lambda df, i: got.extend(r.id for r in df.select("id", "source_file").collect()))
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(got) == [1, 2]


def test_streaming_upsert_into_keyed_store(spark, tmp):
    from tidewater.sinks import keyed
    src, store = f"{tmp}/in", f"{tmp}/store"
    _envelopes(src, [order_json(r) for r in ORDERS[:5]], 0)
    resend = order_json(ORDERS[0], order_status="refunded")          # same key, later sequence
    _envelopes(src, [order_json(r) for r in ORDERS[5:8]] + [resend], 100)
    stream = S.enrich(S.envelope_stream(spark, src, max_files_per_trigger=1), ORDER_SCHEMA).where(~F.col("failed"))
    rows = stream.select("order_id", F.col("sequence_number").cast("long").alias("seq"), "order_status", "total_amount")
    q = (rows.writeStream.foreachBatch(keyed.upsert_batch_writer(store, ["order_id"], "seq", buckets=4))
             .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    cur = {r.order_id: r.order_status for r in keyed.read_current(spark, store).collect()}
    assert len(cur) == 8 and cur["ORD-20240115-000001"] == "refunded"


def test_window_stats_stream_equals_batch(spark, tmp):
    from tidewater.operators.alarms import window_stats
    src = f"{tmp}/metrics"
    t0 = dt.datetime(2024, 1, 1)
    rows = [{"m": "lag", "ts": str(t0 + dt.timedelta(seconds=37 * i)), "v": float(i % 7)} for i in range(60)]
    write_text(f"{src}/a.json", [json.dumps(r) for r in rows[:30]])
    write_text(f"{src}/b.json", [json.dumps(r) for r in rows[30:]])
    stream = spark.readStream.schema("m STRING, ts TIMESTAMP, v DOUBLE").option("maxFilesPerTrigger", 1).json(src)
    got = []
    q = (S.window_stats_stream(stream, "ts", "v", 300, keys=["m"], delay="0 seconds").writeStream
         .outputMode("append").foreachBatch(lambda df, i: got.extend(tuple(r) for r in df.collect()))
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    batch = window_stats(spark.read.schema("m STRING, ts TIMESTAMP, v DOUBLE").json(src), "ts", "v", 300, keys=["m"])
    expected = sorted(tuple(r) for r in batch.collect())
    # append mode emits only windows the watermark has closed: all but the last
    assert sorted(got) == expected[:-1]


def test_alarm_stream_matches_batch_on_closed_windows(spark, tmp):
    from tidewater.operators.alarms import alarm_transitions, window_stats
    src = f"{tmp}/metrics"
    t0 = dt.datetime(2024, 1, 1)
    values = [9, 9, 1, 9, 9, 9, 0, 9]                 # one value per 5-minute period
    rows = [{"m": "errors", "ts": str(t0 + dt.timedelta(minutes=5 * i, seconds=30)), "v": float(v)}
            for i, v in enumerate(values)]
    write_text(f"{src}/a.json", [json.dumps(r) for r in rows[:4]])
    write_text(f"{src}/b.json", [json.dumps(r) for r in rows[4:]])
    stream = spark.readStream.schema("m STRING, ts TIMESTAMP, v DOUBLE").option("maxFilesPerTrigger", 1).json(src)
    q = S.start_alarm_stream(stream, "ts", "v", "sum", 300, 2, 5, ">", ["m"], f"{tmp}/state", f"{tmp}/alarms",
                             f"{tmp}/ck", delay="0 seconds")
    q.awaitTermination()
    got = sorted((r.period_start, r.state) for r in spark.read.parquet(f"{tmp}/alarms").collect())
    # batch reference over the windows the watermark closed (all but the last)
    batch_stats = window_stats(spark.read.schema("m STRING, ts TIMESTAMP, v DOUBLE").json(src), "ts", "v", 300,
                               keys=["m"], stats=("sum",))
    last = batch_stats.agg(F.max("period_start")).first()[0]
    expected = sorted((r.period_start, r.state) for r in
                      alarm_transitions(batch_stats.where(F.col("period_start") < F.lit(last)), "sum", 5, ">", 2, 300,
                                        ["m"]).collect())
    assert got == expected and ("ALARM" in {s for _, s in got})
