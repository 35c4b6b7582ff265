"""Whole jobs on the driver tables: files are written to the shared folder, and
the job that reads them is checked (S1, A12, K1, K10, ML3, W2-W5 with carried
state, F5, K9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alarms as AL
from ..operators import model as ML
from ..session import read_table, scratch_path
from .jobs import sales_etl
from .record_queries import _RAW_SALES, _SALES, raw_sales
from .registry import query


# ---------------------------------------------------------------- S1: header binding
# Three uploads: the columns as they are (odd names), in reverse order, and
# without the payment method but with a column that nobody asked for.
def _uploads(spark, sf) -> list[str]:
    path, raw = scratch_path(spark, "uploads"), raw_sales(spark, sf)
    third = F.pmod(F.col("product-id").cast("long"), F.lit(3))
    parts = {"a": raw.where(third == 0), "b": raw.where(third == 1).select(*[F.col(f"`{c}`") for c in reversed(raw.columns)]),
             "c": raw.where(third == 2).drop("payment_method").withColumn("Approved By", F.lit("x"))}
    for name, part in parts.items():
        (part.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{path}/{name}"))
    return [f"{path}/{name}" for name in parts]


@query("sales_header_binding", _SALES.replace("       payment_method, strftime", "       CASE WHEN CAST(product_id AS BIGINT) % 3 <> 2 THEN payment_method END AS payment_method, strftime"),
       covers="S1 P1")
def sales_header_binding(spark, sf):
    from ..sources.files import CORRUPT, read_csv
    from .runners import SALES_SCHEMA
    return sales_etl(read_csv(spark, _uploads(spark, sf), SALES_SCHEMA).drop(CORRUPT))


# ---------------------------------------------------------------- A12, K1: one run, its counts and its lake
@query("sales_run_counts", f"""
WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS raw_rows, (SELECT count(*) FROM ({_SALES})) AS clean_rows)
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS rejected_rows, clean_rows AS lake_rows, raw_rows - clean_rows AS dead_rows FROM c
""", covers="A12 K1 F7")
def sales_run_counts(spark, sf):
    """Three uploads through the job, the first one twice: what the second run
    counts, and what is in the lake and in the dead letter afterwards."""
    from ..sinks.lake import read_partitioned
    from .runners import run_sales
    uploads, out = _uploads(spark, sf), scratch_path(spark, "sales-run")
    run_sales(spark, uploads[0], f"{out}/lake")
    done = run_sales(spark, uploads, f"{out}/lake")
    lake_rows = read_partitioned(spark, f"{out}/lake").agg(F.count(F.lit(1)).alias("lake_rows"))
    dead = spark.read.schema("record STRING, load STRING").json(f"{out}/lake-errors").agg(F.count(F.lit(1)).alias("dead_rows"))
    counts = [F.lit(done[c]).cast("long").alias(c) for c in ("raw_rows", "clean_rows", "rejected_rows")]
    return lake_rows.join(dead).select(*counts, "lake_rows", "dead_rows")


# ---------------------------------------------------------------- F5, K9: one row per document
_DOCUMENTS = """
SELECT l_orderkey % 50 AS k, l_orderkey % 7 AS name, count(*) AS n FROM lineitem GROUP BY 1, 2"""


@query("incident_documents", f"""
SELECT 'evt-' || name AS id, CASE WHEN k % 3 = 0 THEN 'alert' ELSE 'log' END AS route, count(*) AS documents
FROM ({_DOCUMENTS}) GROUP BY 1, 2
""", covers="F5 S4 K7")
def incident_documents(spark, sf):
    """JSON documents of few ids, sent twice: one alert or log per document."""
    from .runners import run_incidents
    path = scratch_path(spark, "incidents")
    docs = read_table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 50).alias("k"), (F.col("l_orderkey") % 7).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    docs = docs.select(F.concat(F.lit("evt-"), "name").alias("id"), F.format_string("%d lines", "n").alias("message"),
                       F.when(F.col("k") % 3 == 0, "HIGH").when(F.col("k") % 3 == 1, "low").alias("severity"))
    docs.coalesce(1).write.option("maxRecordsPerFile", 1).json(f"{path}/in")
    for _ in range(2):
        run_incidents(spark, f"{path}/in", f"{path}/store", f"{path}/logs", f"{path}/outbox")
    sent = spark.read.schema("id STRING, load STRING").json(f"{path}/outbox").select("id", F.lit("alert").alias("route"))
    logged = spark.read.schema("id STRING, load STRING, date STRING").json(f"{path}/logs").select("id", F.lit("log").alias("route"))
    return sent.unionByName(logged).groupBy("id", "route").agg(F.count(F.lit(1)).alias("documents"))


# ---------------------------------------------------------------- K10, L1: serial ids
@query("event_serial_ids", """
SELECT event_id, user_id, 1000 + row_number() OVER (ORDER BY event_id) AS id FROM events WHERE event_type <> 'error' ORDER BY id DESC LIMIT 500
""", covers="K10 L1")
def event_serial_ids(spark, sf):
    """Ids after the table's last one (1000), in the order of the file, and the
    newest 500."""
    from ..operators.reports import top_k
    from ..sinks.audit import with_serial_ids
    ev = read_table(spark, sf, "events").where(F.col("event_type") != "error").select(
        "event_id", "user_id", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"))
    return top_k(with_serial_ids(ev, last=1000).select("event_id", "user_id", "id"), 500, [F.desc("id")])


# ---------------------------------------------------------------- ML3: exact AUC
@query("doc_length_auc", """
WITH s AS (SELECT d.n_chars % 1000 AS s, l.quality AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL),
p AS (SELECT s, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS n FROM s GROUP BY s),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM p)
SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
       round(CAST(sum(p * (2 * below + n)) AS DOUBLE) / (2 * CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)), 12) AS auc
FROM r
""", covers="ML3")
def doc_length_auc(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 1000).alias("score"))
    scored = docs.join(read_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return ML.rank_sum_auc(scored, "score", "quality").withColumn("auc", F.round("auc", 12))


# ---------------------------------------------------------------- W2: percentiles of merged sketches
@query("event_p99_rollup", """
SELECT event_type, time_bucket(INTERVAL '3600 seconds', ts, TIMESTAMP '1970-01-01') AS period_start, count(*) AS count,
       list_sort(list(value))[CAST((99 * count(*) + 99) // 100 AS INTEGER)] AS p99
FROM events GROUP BY 1, 2
""", covers="W2")
def event_p99_rollup(spark, sf):
    """Hourly p99 from sketches of 60 s, merged to 300 s and to the hour."""
    sk = AL.window_sketches(read_table(spark, sf, "events"), "ts", "value", 60, ["event_type"])
    hours = AL.merge_sketches(AL.merge_sketches(sk, 300, ["event_type"]), 3600, ["event_type"])
    return hours.select("event_type", "period_start", "count", AL.sketch_percentile(0.99).alias("p99"))


# ---------------------------------------------------------------- W3-W5: the alarm stream
CUTS = ("2024-01-08", "2024-01-16", "2024-01-24")


@query("event_alarm_stream", """
WITH m AS (SELECT max(ts) AS w FROM events),
s AS (SELECT event_type, time_bucket(INTERVAL '3600 seconds', ts, TIMESTAMP '1970-01-01') AS period_start, max(value) AS v FROM events GROUP BY 1, 2),
c AS (SELECT event_type, period_start, v FROM s, m WHERE period_start + INTERVAL '3600 seconds' <= w),
e AS (SELECT max(period_start) AS until FROM c),
b AS (SELECT event_type, min(period_start) AS lo FROM c GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, until, INTERVAL '3600 seconds')) AS period_start FROM b, e),
x AS (SELECT g.event_type, g.period_start, CASE WHEN c.v > 60 THEN 1 ELSE 0 END AS br
      FROM g LEFT JOIN c ON g.event_type = c.event_type AND g.period_start = c.period_start),
st AS (SELECT event_type, period_start, CASE WHEN sum(br) OVER (PARTITION BY event_type ORDER BY period_start
         ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2 THEN 'ALARM' ELSE 'OK' END AS state FROM x)
SELECT event_type, period_start, state FROM (
  SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY event_type ORDER BY period_start) AS prev FROM st) WHERE state <> prev
""", covers="W3 W4 W5 ST3")
def event_alarm_stream(spark, sf):
    """Events arrive in four uploads, the stream is stopped after each and
    started again: the edges are those of the whole table."""
    from ..streaming.jobs import start_alarm_stream
    path = scratch_path(spark, "alarm-stream")
    ev = read_table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    day = [F.lit(c).cast("timestamp") for c in CUTS]
    upload = sum((F.col("ts") >= d).cast("int") for d in day)
    for k in range(len(CUTS) + 1):
        ev.where(upload == k).write.parquet(f"{path}/in/upload={k}")
        stream = spark.readStream.schema("event_type STRING, ts TIMESTAMP, value DOUBLE").parquet(f"{path}/in/*")
        start_alarm_stream(stream, "ts", "value", "max", 3600, 2, 60, ">", ["event_type"], f"{path}/state", f"{path}/edges",
                           f"{path}/checkpoint", delay="0 seconds").awaitTermination()
    edges = spark.read.schema("event_type STRING, period_start TIMESTAMP, state STRING").parquet(f"{path}/edges")
    return edges.select("event_type", F.col("period_start").cast("timestamp_ntz").alias("period_start"), "state")


# ---------------------------------------------------------------- S11: loads of other types
@query("lineitem_widened_loads", """
SELECT l_orderkey, CAST(CASE WHEN l_orderkey % 2 = 0 THEN l_linenumber ELSE l_linenumber + 5000000000 END AS BIGINT) AS number,
       CASE WHEN l_orderkey % 2 = 0 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) ELSE l_extendedprice END AS amount,
       CASE WHEN l_orderkey % 2 = 1 THEN l_returnflag END AS flag, CASE WHEN l_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS load
FROM lineitem
""", covers="S11")
def lineitem_widened_loads(spark, sf):
    """A load with int columns, then one with bigint, double and a new column."""
    from ..sources.catalog import read_widened
    path, li = scratch_path(spark, "widened"), read_table(spark, sf, "lineitem")
    even = F.col("l_orderkey") % 2 == 0
    li.where(even).select("l_orderkey", F.col("l_linenumber").cast("int").alias("number"), F.col("l_quantity").cast("int").alias("amount")).write.parquet(f"{path}/load=a")
    li.where(~even).select("l_orderkey", (F.col("l_linenumber") + F.lit(5000000000)).cast("long").alias("number"), F.col("l_extendedprice").alias("amount"),
                           F.col("l_returnflag").alias("flag")).write.parquet(f"{path}/load=b")
    return read_widened(spark, path)[0].select("l_orderkey", "number", "amount", "flag", "load")
