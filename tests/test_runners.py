"""End-to-end jobs on small fixtures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from fixtures import ORDERS, SALES_HEADER, SALES_ROWS, order_json, write_text
from tidewater.functions.features import FRAUD_FEATURES
from tidewater.plans import runners as J
from tidewater.sinks import keyed, lake


def test_sales_job_audit_and_rerun(spark, tmp):
    raw = write_text(f"{tmp}/data/sales/s.csv", [SALES_HEADER, *SALES_ROWS, "TXN-X,S,P,N,c,1,1,oops,2024-01-15,cash"])
    a = J.run_sales(spark, raw, f"{tmp}/lake")
    assert a == {"raw_rows": 11, "clean_rows": 10, "rejected_rows": 1}
    J.run_sales(spark, raw, f"{tmp}/lake")                      # the same upload again replaces itself
    assert lake.read_partitioned(spark, f"{tmp}/lake").count() == 10
    bad = spark.read.json(f"{tmp}/lake-errors").collect()
    assert len(bad) == 1 and "TXN-X" in bad[0].record and bad[0].reason == "missing required value"


def test_sales_uploads_of_one_day_are_kept(spark, tmp):
    day = [r.replace("TXN-20240115", "TXN-B") for r in SALES_ROWS[:3]]
    J.run_sales(spark, write_text(f"{tmp}/data/a.csv", [SALES_HEADER, *SALES_ROWS]), f"{tmp}/lake")
    b = write_text(f"{tmp}/data/b.csv", [SALES_HEADER, *day])
    J.run_sales(spark, b, f"{tmp}/lake")
    assert lake.read_partitioned(spark, f"{tmp}/lake").count() == 13
    J.run_sales(spark, b, f"{tmp}/lake")                        # twice: still once
    assert lake.read_partitioned(spark, f"{tmp}/lake").count() == 13
    # a corrected upload whose rows moved to another day leaves none behind
    J.run_sales(spark, write_text(b, [SALES_HEADER, day[0].replace("2024-01-15", "2024-01-16")]), f"{tmp}/lake")
    back = lake.read_partitioned(spark, f"{tmp}/lake")
    assert back.count() == 11 and back.where("day = '16'").count() == 1
    J.run_sales(spark, write_text(b, [SALES_HEADER, "x,y"]), f"{tmp}/lake")
    assert lake.read_partitioned(spark, f"{tmp}/lake").count() == 10


def test_orders_keep_a_row_with_one_bad_optional_value(spark, tmp):
    lines = [order_json(ORDERS[0]), order_json(ORDERS[1], quantity="two"), "{broken", order_json(ORDERS[2], total_amount="free")]
    raw = write_text(f"{tmp}/raw/o.json", lines)
    assert J.run_orders_etl(spark, raw, f"{tmp}/lake", f"{tmp}/dead") == {"rows": 2, "rejected": 2}
    back = {r.order_id: r.quantity for r in lake.read_partitioned(spark, f"{tmp}/lake").collect()}
    assert back == {"ORD-20240115-000001": 1, "ORD-20240115-000002": None}
    dead = {r.reason: r.record for r in spark.read.json(f"{tmp}/dead").collect()}
    assert dead["unreadable"] == "{broken" and '"free"' in dead["missing required value"]


def test_orders_job_and_warehouse(spark, tmp):
    lines = [order_json(r) for r in ORDERS] + [order_json(ORDERS[0])]   # re-sent record
    raw = write_text(f"{tmp}/raw/o.json", lines)
    assert J.run_orders_etl(spark, raw, f"{tmp}/lake") == {"rows": 20, "rejected": 0}
    wh = J.warehouse_rows(spark, f"{tmp}/lake")
    assert wh.count() == 20 and wh.columns[-1] == "event_ts"


def test_fraud_features_job(spark, tmp):
    header = ("transaction_id,amount,merchant_category,hour_of_day,day_of_week,user_account_age_days,"
              "previous_fraud_count,distance_from_home_km,is_foreign_transaction,transaction_frequency_24h")
    rows = ["t1,125000,grocery,10,1,730,0,2.5,0,2", "t2,4500000,electronics,2,0,45,1,1200.0,1,18",
            "t3,125000,grocery,10,1,730,0,2.5,0,2", "t4,-1,gas,25,1,730,0,2.5,0,2"]
    write_text(f"{tmp}/in/tx.csv", [header, *rows])
    out = J.run_fraud_features(spark, f"{tmp}/in", f"{tmp}/feat", f"{tmp}/pq", dt.date(2024, 1, 15))
    assert out == {"rows": 3, "rejected": 1}                      # equal features, two transactions (T9)
    again = J.run_fraud_features(spark, f"{tmp}/in", f"{tmp}/feat", f"{tmp}/pq", dt.date(2024, 1, 15))
    assert again == out
    pq = lake.read_partitioned(spark, f"{tmp}/pq")
    assert sorted(r.transaction_id for r in pq.collect()) == ["t1", "t2", "t3"]
    dead = spark.read.json(f"{tmp}/pq-errors").collect()
    assert [r.reason for r in dead] == ["amount_not_positive,hour_out_of_range"]
    ids = spark.read.parquet(f"{tmp}/feat-ids")
    assert ids.count() == 3 and "transaction_id" not in spark.read.option("header", True).csv(f"{tmp}/feat").columns
    assert set(FRAUD_FEATURES) <= set(pq.columns)
    assert {(r.year, r.month, r.day) for r in pq.select("year", "month", "day").collect()} == {("2024", "01", "15")}


def test_scores_job(spark, tmp):
    write_text(f"{tmp}/bucket/a-scores.csv", ["name,subject,score", "Old,Math,10"])
    write_text(f"{tmp}/bucket/b-scores.csv", ["name,subject,score", "Budi,Math,80", "Ani,English,60", "John,Science,90",
                                               "Edge,Math,74", "Edge2,Math,75"])
    out = J.run_scores(spark, f"{tmp}/bucket", f"{tmp}/table")
    assert out.count() == 5
    J.run_scores(spark, f"{tmp}/bucket", f"{tmp}/table")                # the same object again
    rows = lake.read_partitioned(spark, f"{tmp}/table").collect()
    assert len(rows) == 5 and len({r.id for r in rows}) == 5 and all(r.created_at for r in rows)
    assert {r.student_name: r.status for r in rows} == {"Budi": "PASS", "Ani": "FAIL", "John": "PASS", "Edge": "FAIL", "Edge2": "PASS"}
    write_text(f"{tmp}/bucket/c-scores.csv", ["name,subject,score", "Same,Math,80", "Same,Math,80"])
    twice = J.run_scores(spark, f"{tmp}/bucket", f"{tmp}/table").where("student_name = 'Same'").collect()
    assert len(twice) == 2 and twice[0].id != twice[1].id               # equal rows, ids of their own


def test_incidents_job(spark, tmp):
    for i, sev in enumerate(["HIGH", "LOW", None]):
        with open(write_text(f"{tmp}/inc/{i}.json", [""]), "w") as f:
            json.dump({"id": f"evt-{i}", "message": "CPU usage high", "severity": sev}, f, indent=2)
    counts = J.run_incidents(spark, f"{tmp}/inc", f"{tmp}/store", f"{tmp}/logs", f"{tmp}/outbox")
    assert counts == {"alert": 1, "log": 2}
    assert keyed.read_current(spark, f"{tmp}/store").count() == 3
    text = spark.read.json(f"{tmp}/outbox").first().alert_text
    assert text == 'High severity incident: {"id":"evt-0","message":"CPU usage high","severity":"HIGH"}'
    write_text(f"{tmp}/inc/3.json", ["{not json"])
    J.run_incidents(spark, f"{tmp}/inc", f"{tmp}/store", f"{tmp}/logs", f"{tmp}/outbox")
    assert spark.read.json(f"{tmp}/outbox").count() == 1 and spark.read.json(f"{tmp}/logs").count() == 2
    assert spark.read.json(f"{tmp}/store-errors").first().record.strip() == "{not json"


def test_visitor_summary_upsert_by_date(spark, tmp):
    v = spark.createDataFrame([(1, "2024-01-15 23:59:59"), (2, "2024-01-16 00:00:00"), (3, "2024-01-16 08:00:00")],
                              "id int, visit_time string").withColumn("visit_time", F.col("visit_time").cast("timestamp_ntz"))
    J.run_visitor_summary(spark, v, f"{tmp}/summary")
    cur = J.run_visitor_summary(spark, v, f"{tmp}/summary")            # re-run replaces, no extra rows (T6)
    assert sorted((str(r.date), r.total_visitors) for r in cur.collect()) == [("2024-01-15", 1), ("2024-01-16", 2)]


def test_reports_job(spark, tmp):
    docs = {"ok.json": {"filename": "ok.json", "data": [1, 2, 3]}, "empty.json": {"filename": "e", "data": []},
            "nofile.json": {"data": [1]}, "notlist.json": {"filename": "n", "data": "[1,2]"}}
    for k, d in docs.items():
        write_text(f"{tmp}/reports/{k}", [json.dumps(d)])
    dash = J.run_reports(spark, f"{tmp}/reports", f"{tmp}/audit", f"{tmp}/outbox").first()
    assert (dash.total, dash.completed, dash.failed, dash.total_records) == (1, 1, 0, 3)
    J.run_reports(spark, f"{tmp}/reports", f"{tmp}/audit", f"{tmp}/outbox")             # again: replaced
    assert lake.read_partitioned(spark, f"{tmp}/audit").count() == 1
    notes = {r.key: (r.subject, r.message) for r in spark.read.json(f"{tmp}/outbox").collect()}
    assert notes["ok.json"][0].endswith("Report Processed: ok.json") and notes["empty.json"][0].endswith("FAILED")
    assert "Report ID:    null" not in notes["ok.json"][1] and len(notes) == 4
    assert notes["notlist.json"][1].endswith('Error: data_not_non_empty_list\nEvent: {"filename": "n", "data": "[1,2]"}')


def _label_first(path, n, nfeat, seed):
    import random
    rnd = random.Random(seed)
    lines = []
    for i in range(n):
        y = 1 if i % 4 == 0 else 0
        feats = [round(rnd.random() + (2.0 if (y and j == 0) else 0.0), 3) for j in range(nfeat)]
        lines.append(",".join([str(y)] + [str(f) for f in feats]))
    return write_text(path, lines)


def test_fraud_model_job(spark, tmp):
    _label_first(f"{tmp}/train.csv", 200, 9, 1)
    _label_first(f"{tmp}/val.csv", 60, 9, 2)
    score_df = spark.read.schema(", ".join(["label int"] + [f"{c} double" for c in FRAUD_FEATURES])).csv(f"{tmp}/val.csv") \
        .withColumn("transaction_id", F.monotonically_increasing_id().cast("string"))
    out = J.run_fraud_model(spark, f"{tmp}/train.csv", f"{tmp}/val.csv", score_df, f"{tmp}/pred", maxIter=5)
    assert out["auc"] > 0.9
    pred = spark.read.json(f"{tmp}/pred")
    assert pred.count() == 60 and {"fraud_score", "label", "confidence", "scored_at", "date"} <= set(pred.columns)


def test_loan_model_job(spark, tmp):
    from tidewater.functions.features import LOAN_FEATURES
    _label_first(f"{tmp}/train.csv", 200, 10, 3)
    _label_first(f"{tmp}/val.csv", 60, 10, 4)
    applicants = spark.read.schema(", ".join(["default int"] + [f"{c} double" for c in LOAN_FEATURES])).csv(f"{tmp}/val.csv")
    scored, auc = J.run_loan_model(spark, f"{tmp}/train.csv", f"{tmp}/val.csv", applicants, maxIter=5)
    assert auc > 0.9
    rows = scored.select("probability", "risk_level", "recommendation").collect()
    assert len(rows) == 60 and all(0 <= r.probability <= 100 for r in rows)


def test_sales_stream_reads_only_new_files(spark, tmp):
    landing, out, ck = f"{tmp}/data/sales", f"{tmp}/lake", f"{tmp}/ck"
    write_text(f"{landing}/day1.csv", [SALES_HEADER, *SALES_ROWS[:4]])
    write_text(f"{landing}/day1b.CSV", [SALES_HEADER, *SALES_ROWS[4:7]])
    write_text(f"{landing}/notes.txt", ["not a sales file"])
    first = J.run_sales_stream(spark, landing, out, ck)
    assert first["rows"] == 7
    write_text(f"{landing}/day2.csv", [SALES_HEADER, *SALES_ROWS[7:]])
    second = J.run_sales_stream(spark, landing, out, ck)
    assert second["rows"] == 3                                   # only the new file
    lake_rows = lake.read_partitioned(spark, out)
    assert lake_rows.count() == 10 and lake_rows.select("transaction_id").distinct().count() == 10


def test_sales_stream_recovers_from_a_failed_batch(spark, tmp, monkeypatch):
    import pytest
    from tidewater.sinks import lake as lake_mod
    landing, out, ck = f"{tmp}/data/sales", f"{tmp}/lake", f"{tmp}/ck"
    write_text(f"{landing}/day1.csv", [SALES_HEADER, *SALES_ROWS])
    real = lake_mod.write_load
    calls = {"n": 0}

    def flaky(*args, **how):
        calls["n"] += 1
        real(*args, **how)     # files land, then the batch "dies" before commit
        raise RuntimeError("executor lost")

    monkeypatch.setattr(lake_mod, "write_load", flaky)
    with pytest.raises(Exception):
        J.run_sales_stream(spark, landing, out, ck)
    monkeypatch.setattr(lake_mod, "write_load", real)
    again = J.run_sales_stream(spark, landing, out, ck)  # same files again: the offsets were never committed
    assert calls["n"] == 1 and again["rows"] == 10
    assert lake_mod.read_partitioned(spark, out).count() == 10          # the replayed files replaced themselves


def test_orders_incremental_upsert_across_runs(spark, tmp):
    from tidewater.sinks import keyed as keyed_mod
    landing, store, ck = f"{tmp}/raw", f"{tmp}/store", f"{tmp}/ck"
    write_text(f"{landing}/h1.json", [order_json(r) for r in ORDERS[:10]])
    first = J.run_orders_incremental(spark, landing, store, ck, buckets=4)
    assert first["rows"] == 10
    resent = order_json(ORDERS[0], order_status="refunded", timestamp="2024-01-15T14:00:00Z")
    write_text(f"{landing}/h2.json", [order_json(r) for r in ORDERS[10:]] + [resent, "{broken"])
    second = J.run_orders_incremental(spark, landing, store, ck, buckets=4)
    assert second["rows"] == 11                                    # only the new file was read
    cur = keyed_mod.read_current(spark, store)
    assert cur.count() == 20
    assert cur.where("order_id = 'ORD-20240115-000001'").first().order_status == "refunded"
