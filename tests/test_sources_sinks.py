"""File sources and remaining sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import write_text
from tidewater.functions.features import LOAN_FEATURES
from tidewater.operators.routing import route_by_severity
from tidewater.sinks import audit, keyed, lake
from tidewater.sources import files


def test_headerless_label_first(spark, tmp):
    p = write_text(f"{tmp}/train.csv", ["0,35,50000,10000,36,700,5,0.3,1,4,0", "1,22,15000,20000,60,520,0,0.8,0,1,5"])
    df = files.read_label_first_csv(spark, p, "default", LOAN_FEATURES)
    assert df.columns[0] == "default" and df.count() == 2 and df.first().credit_score == 700.0
    out = f"{tmp}/export"
    lake.write_label_first_csv(df, out, "default", LOAN_FEATURES)
    back = spark.read.csv(out)
    assert back.count() == 2 and len(back.columns) == 11


def test_json_documents_and_routing(spark, tmp):
    for i, sev in enumerate(["HIGH", "high", None, "LOW"]):
        with open(write_text(f"{tmp}/inc/{i}.json", [""]), "w") as f:
            json.dump({"id": f"evt-{i}", "message": "CPU usage high", "severity": sev}, f, indent=2)
    inc = files.read_json_documents(spark, f"{tmp}/inc", "id STRING, message STRING, severity STRING")
    routed = {r.id: (r.route, r.log_key) for r in route_by_severity(inc).collect()}
    assert routed == {"evt-0": ("alert", None), "evt-1": ("log", "log-evt-1.json"),
                      "evt-2": ("log", "log-evt-2.json"), "evt-3": ("log", "log-evt-3.json")}


def test_listing_latest_and_arrival_filter(spark, tmp):
    write_text(f"{tmp}/b/scores-2.csv", ["name,subject,score", "Budi,Math,80"])
    write_text(f"{tmp}/b/scores-1.csv", ["name,subject,score", "Ani,English,60"])
    listed = files.list_files(spark, f"{tmp}/b")
    assert sorted(r.name for r in listed.collect()) == ["scores-1.csv", "scores-2.csv"]
    assert files.latest_object(spark, f"{tmp}/b").endswith("scores-2.csv")
    keys = spark.createDataFrame([("data/sales/x.CSV",), ("data/sales/y.csv",), ("other/z.csv",), ("data/sales/t.txt",)], "k string")
    assert [r.k for r in keys.where(files.arrival_filter("k", "data/sales/")).collect()] == ["data/sales/x.CSV", "data/sales/y.csv"]
    assert keys.where(files.arrival_filter("k", "", ".csv", case_sensitive=True)).count() == 2


def test_csv_corrupt_record_kept(spark, tmp):
    p = write_text(f"{tmp}/s.csv", ["name,subject,score", "Budi,Math,80", "Ani,English,notanumber"])
    df = files.read_csv(spark, p, "name STRING, subject STRING, score INT").cache()
    bad = df.where(F.col(files.CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0].name == "Ani"


def test_keyed_store_last_write_wins(spark, tmp):
    path = f"{tmp}/kv"
    a = spark.createDataFrame([("o1", 1, "x"), ("o2", 1, "y")], "order_id string, seq int, v string")
    b = spark.createDataFrame([("o1", 2, "x2"), ("o3", 1, "z")], "order_id string, seq int, v string")
    keyed.upsert_into(spark, path, a, ["order_id"], "seq", buckets=4)
    touched = keyed.upsert_into(spark, path, b, ["order_id"], "seq", buckets=4)
    assert 1 <= touched <= 2                                   # only buckets of o1 and o3 rewritten
    cur = {r.order_id: r.v for r in keyed.read_current(spark, path).collect()}
    assert cur == {"o1": "x2", "o2": "y", "o3": "z"}
    keyed.upsert_into(spark, path, b, ["order_id"], "seq", buckets=4)   # retried batch: same result
    again = sorted(tuple(r) for r in keyed.read_current(spark, path).collect())
    assert again == sorted(tuple(r) for r in keyed.read_current(spark, path).collect()) and len(again) == 3


def test_keyed_store_only_rewrites_touched_buckets(spark, tmp):
    path = f"{tmp}/kv2"
    base = spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("seq"))
    keyed.upsert_into(spark, path, base, ["k"], "seq", buckets=8)
    files_of = lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files_of()
    one = spark.createDataFrame([(7, 1)], "k bigint, seq int")
    assert keyed.upsert_into(spark, path, one, ["k"], "seq", buckets=8) == 1
    assert len(before) == 8 and len(before - files_of()) == 1
    cur = keyed.read_current(spark, path)
    assert cur.count() == 200 and cur.where("k = 7").first().seq == 1 and cur.columns == ["k", "seq"]


def test_keyed_store_refuses_another_bucket_count(spark, tmp):
    path = f"{tmp}/kv3"
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("seq"))
    keyed.upsert_into(spark, path, rows, ["k"], "seq", buckets=4)
    with pytest.raises(ValueError):
        keyed.upsert_into(spark, path, rows, ["k"], "seq", buckets=64)
    with pytest.raises(ValueError):
        keyed.upsert_into(spark, path, rows, ["seq"], "seq")
    assert keyed.upsert_into(spark, path, rows.limit(0), ["k"], "seq") == 0 and keyed.read_current(spark, f"{tmp}/none") is None


def test_replace_leaves_no_stale_partition(spark, tmp):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "v string, p string")
    lake.write_partitioned(df, f"{tmp}/t", ["p"], mode="replace")
    lake.write_partitioned(df.where("p = '1'"), f"{tmp}/t", ["p"], mode="replace")
    assert [r.v for r in lake.read_partitioned(spark, f"{tmp}/t").collect()] == ["a"]


def test_batch_folder_is_replaced_when_it_comes_again_in_another_hour(spark, tmp):
    from tidewater.sinks.fanout import folder_writer
    for hour in ("08", "09"):
        df = spark.createDataFrame([("a", hour)], "v string, hour string")
        folder_writer(f"{tmp}/raw", partition_cols=("hour",))(df, 3)
    assert [(r.v, str(r.hour)) for r in spark.read.json(f"{tmp}/raw").collect()] == [("a", "09")]


def test_one_bad_record_does_not_end_the_batch(spark):
    import base64
    from tidewater.sources.envelope import decode_envelope
    data = [base64.b64encode(b).decode() for b in (b'{"k": 1}', b'{"k\xc3(": 2}', b"{x")] + ["%%", None]
    df = spark.createDataFrame(list(enumerate(data)), "i int, data string")
    got = {r.i: (r.record.k if r.record else None, r.failed) for r in decode_envelope(df, "k INT").collect()}
    assert got == {0: (1, False), 1: (None, True), 2: (None, True), 3: (None, True), 4: (None, True)}


def test_totals_are_not_rounded_by_row(spark):
    from tidewater.operators.reports import money_sum
    assert spark.range(1000).select(F.lit(0.004).alias("x")).agg(money_sum("x").alias("s")).first().s == 4.0


def test_catalog_table_takes_new_columns(spark, tmp):
    from tidewater.sources.catalog import listed_partitions, register_table
    lake.write_partitioned(spark.createDataFrame([("a", "01")], "id string, month string"), f"{tmp}/t", ["month"])
    register_table(spark, "tw_grows", f"{tmp}/t", "id STRING, month STRING", ["month"])
    lake.write_partitioned(spark.createDataFrame([("b", 2.5, "02")], "id string, tax double, month string"), f"{tmp}/t", ["month"])
    t = register_table(spark, "tw_grows", f"{tmp}/t", "id STRING, month STRING", ["month"])
    assert {(r.id, r.tax) for r in t.collect()} == {("a", None), ("b", 2.5)}
    assert sorted(r.month for r in listed_partitions(spark, f"{tmp}/t", ["month"]).collect()) == ["01", "02"]
    spark.sql("DROP TABLE tw_grows")


def test_arrival_prefix_is_the_start_of_the_key(spark):
    keys = spark.createDataFrame([("archive/data/sales/x.csv",), ("data/sales/x.csv",), ("/root/in/data/sales/y.csv",)], "k string")
    assert [r.k for r in keys.where(files.arrival_filter("k", "data/sales/")).collect()] == ["data/sales/x.csv"]
    assert [r.k for r in keys.where(files.arrival_filter("k", "data/sales/", root="/root/in")).collect()] == ["/root/in/data/sales/y.csv"]


def test_json_by_date_and_audit(spark, tmp):
    preds = spark.createDataFrame([("t1", 0.8, "2024-01-15 10:00:00"), ("t2", 0.1, "2024-01-16 10:00:00")],
                                  "transaction_id string, fraud_score double, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    lake.write_json_by_date(preds, f"{tmp}/pred", "ts")
    assert sorted(os.listdir(f"{tmp}/pred"))[:2] == ["_SUCCESS", "date=2024-01-15"] or \
        "date=2024-01-15" in os.listdir(f"{tmp}/pred")
    reps = spark.createDataFrame([("a.json", [1, 2, 3]), ("b.json", [])], "filename string, data array<int>")
    rows = audit.report_audit(reps).collect()
    assert [(r.filename, r.record_count, r.status) for r in rows] == [("a.json", 3, "processed"), ("b.json", 0, "processed")]
    filled = audit.with_defaults(spark.createDataFrame([("Budi", None)], "name string, updated_at timestamp"),
                                 {"updated_at": F.current_timestamp()}, id_col="id").first()
    assert filled.updated_at is not None and filled.id is not None


def test_catalog_registration_and_partitions(spark, tmp):
    from tidewater.sources.catalog import register_table, show_partitions
    df = spark.createDataFrame([("a", 1.0, "2024", "01", "15"), ("b", 2.0, "2024", "02", "01")],
                               "id string, amount double, year string, month string, day string")
    lake.write_partitioned(df, f"{tmp}/t", ["year", "month", "day"], mode="overwrite")
    t = register_table(spark, "tw_sales_cat", f"{tmp}/t", "id STRING, amount DOUBLE, year STRING, month STRING, day STRING",
                       ["year", "month", "day"])
    assert t.where("month = '01'").count() == 1
    parts = sorted(r[0] for r in show_partitions(spark, "tw_sales_cat").collect())
    assert parts == ["year=2024/month=01/day=15", "year=2024/month=02/day=01"]
    spark.sql("DROP TABLE tw_sales_cat")


def test_distributed_warehouse_table(spark, tmp):
    from tidewater.sinks.warehouse import write_distributed
    df = spark.createDataFrame([("o1", "jakarta", "2024-01-15 09:00:00"), ("o2", "bali", "2024-01-15 08:00:00"),
                                ("o3", "jakarta", "2024-01-15 08:00:00")], "order_id string, region string, event_ts string")
    write_distributed(df, "tw_orders_wh", "region", "event_ts", mode="overwrite", buckets=4)
    t = spark.table("tw_orders_wh")
    assert t.count() == 3
    # bucketed on region: an aggregate on the bucket key needs no shuffle
    plan = t.groupBy("region").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    spark.sql("DROP TABLE tw_orders_wh")


def test_direct_load_repairs_invalid_utf8(spark):
    from tidewater.sinks.warehouse import direct_load
    df = spark.createDataFrame([("o1",)], "order_id string").withColumn("product_name", F.unhex(F.lit("C328")).cast("string"))
    assert df.select(F.is_valid_utf8("product_name")).first()[0] is False
    out = direct_load(df).select("product_name", F.is_valid_utf8("product_name").alias("ok")).first()
    assert out.ok is True and "�" in out.product_name


def test_latest_by_mtime(spark, tmp):
    import time
    write_text(f"{tmp}/m/z-old.csv", ["a"])
    time.sleep(1.1)
    write_text(f"{tmp}/m/a-new.csv", ["a"])
    assert files.latest_object(spark, f"{tmp}/m").endswith("z-old.csv")          # key order (reference rule)
    assert files.latest_object(spark, f"{tmp}/m", by="mtime").endswith("a-new.csv")


def test_query_results_to_results_location(spark, tmp):
    import __spark_entry__ as E
    res = E.queries()["sales_by_payment"](spark, "/root/testdata/sf0.001")
    lake.write_csv(res, f"{tmp}/results/q1")
    lake.write_csv(res, f"{tmp}/results/q1")                      # overwrite: re-running keeps one copy
    back = spark.read.option("header", True).csv(f"{tmp}/results/q1")
    assert back.columns == res.columns and back.count() == res.count()
