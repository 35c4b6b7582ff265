"""Report audit table and dashboard.

A conversation is an uploaded report: ``filename`` = conv-<id>.json, ``data``
= its turns. The audit row carries the record count; the array itself is
never built (a count aggregate is combined map-side, a collected array would
put a whole hot conversation into one row).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contracts as K
from ..functions.clean import non_blank
from ..functions.rules import report_notification, status_badge
from ..operators.reports import dashboard_stats
from ..session import read_table
from ..sinks import audit
from .registry import query

# A fixed processing clock keeps the stamps reproducible.
RUN_CLOCK = "2024-02-01 00:00:00"

# A report whose turns are all white space is failed; of the others some still
# process and some have an unknown status, so that every badge occurs.
_WHITE = "chr(9) || chr(10) || chr(13) || ' '"
_STATUS = "CASE WHEN conv_id % 9 = 0 THEN 'processing' WHEN conv_id % 9 = 1 THEN 'Completed' WHEN conv_id % 9 = 2 THEN NULL WHEN filled > 0 AND conv_id % 9 <> 3 THEN 'processed' ELSE 'failed' END"
_AUDIT_SQL = f"""
SELECT conv_id, 'conv-' || CAST(conv_id AS VARCHAR) || '.json' AS filename, n AS record_count, {_STATUS} AS status,
       TIMESTAMP '{RUN_CLOCK}' AS created_at
FROM (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE trim(text, {_WHITE}) <> '') AS filled FROM conversations GROUP BY conv_id)
"""


def report_audit_rows(spark, sf):
    conv = read_table(spark, sf, "conversations")
    per = conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("record_count"), F.count_if(non_blank("text")).alias("filled"))
    per = per.withColumn("filename", F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit(".json")))
    return audit.report_audit(per, data="record_count", status=F.expr(_STATUS), created_at=F.lit(RUN_CLOCK).cast("timestamp_ntz"))


def _conv_id():
    return F.regexp_extract("filename", r"-(\d+)\.", 1).cast("long").alias("conv_id")


@query("report_audit", f"""
WITH r AS ({_AUDIT_SQL})
SELECT conv_id, filename, record_count, status, created_at, true AS id_is_own FROM r
""", covers="K9 A11 P20")
def report_audit(spark, sf):
    """The audit rows of the sink. Ids are hashes, which SQL cannot repeat:
    that no two reports share one is checked instead."""
    rows = report_audit_rows(spark, sf)
    ids = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(ids, "id").select(_conv_id(), "filename", "record_count", "status", "created_at", (F.col("n") == 1).alias("id_is_own"))


# Our fix for trap T7: 'processed' counts as completed.
COMPLETED, FAILED = ("completed", "processed"), ("failed", "error")


@query("report_dashboard", f"""
WITH r AS ({_AUDIT_SQL})
SELECT count(*) AS total,
       count(*) FILTER (WHERE status IN ('completed', 'processed')) AS completed,
       count(*) FILTER (WHERE status IN ('failed', 'error')) AS failed,
       CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records
FROM r
""", covers="A8")
def report_dashboard(spark, sf):
    return dashboard_stats(report_audit_rows(spark, sf), completed=COMPLETED, failed=FAILED)


@query("report_badges", f"""
WITH r AS ({_AUDIT_SQL})
SELECT CASE WHEN lower(coalesce(status, '')) IN ('completed', 'success') THEN 'success'
            WHEN lower(coalesce(status, '')) IN ('failed', 'error') THEN 'error'
            WHEN lower(coalesce(status, '')) = 'processing' THEN 'info' ELSE 'warning' END AS badge,
       count(*) AS n
FROM r GROUP BY 1
""", covers="P21")
def report_badges(spark, sf):
    return report_audit_rows(spark, sf).groupBy(status_badge("status").alias("badge")).agg(F.count(F.lit(1)).alias("n"))


@query("report_notifications", f"""
WITH r AS ({_AUDIT_SQL})
SELECT conv_id,
       CASE WHEN coalesce(status = 'processed', false) THEN '[reports] Report Processed: ' || filename
            ELSE '[reports] Report Processing FAILED' END AS subject,
       CASE WHEN coalesce(status = 'processed', false) THEN
            'Report successfully processed.' || chr(10) || chr(10) || 'File:         ' || filename || chr(10) ||
            'Report ID:    ' || CAST(conv_id AS VARCHAR) || chr(10) || 'Record count: ' || CAST(record_count AS VARCHAR) ||
            chr(10) || 'Status:       ' || status
            ELSE 'Report processing failed.' || chr(10) || chr(10) || 'Error: ' || CASE WHEN conv_id % 9 = 3 THEN 'no records' ELSE 'Unknown error' END ||
            chr(10) || 'Event: {{"filename":"' || filename || '","record_count":' || record_count || '}}' END AS message
FROM r
""", covers="P22")
def report_notifications(spark, sf):
    r = report_audit_rows(spark, sf).withColumn("conv_id", _conv_id())
    error = F.when(F.col("conv_id") % 9 == 3, "no records")
    n = report_notification("status", "filename", "conv_id", "record_count", error=error, event=F.to_json(F.struct("filename", "record_count")))
    return r.select("conv_id", n["subject"].alias("subject"), n["message"].alias("message"))


# ---------------------------------------------------------------- P19
_DATA = """CASE conv_id % 6 WHEN 0 THEN '{"filename": "a", "data": [1, 2]}' WHEN 1 THEN '{"filename": "a", "data": []}' WHEN 2 THEN '{"data": "[1,2]"}'
  WHEN 3 THEN '{broken' WHEN 4 THEN NULL ELSE '{"data": {"a": 1}}' END"""


@query("report_contract", f"""
WITH d AS (SELECT DISTINCT conv_id, {_DATA} AS doc FROM conversations),
j AS (SELECT conv_id, CASE WHEN json_valid(doc) THEN doc::JSON END AS doc FROM d)
SELECT conv_id, coalesce(json_type(doc, '$.data') = 'ARRAY' AND json_array_length(doc, '$.data') > 0, false) AS has_data,
       array_to_string(list_filter(['filename', 'data'], lambda x: NOT list_contains(coalesce(json_keys(doc), []), x)), ',') AS missing
FROM j
""", covers="P18 P19")
def report_contract(spark, sf):
    docs = read_table(spark, sf, "conversations").select("conv_id").distinct().withColumn("doc", F.expr(_DATA))
    return docs.select("conv_id", K.non_empty_json_array("doc", "$.data").alias("has_data"),
                       F.array_join(K.missing_keys("doc", ["filename", "data"]), ",").alias("missing"))
