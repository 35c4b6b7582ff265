"""Order stream jobs on the driver tables: enrichment (ST1 batch form),
lake ETL + warehouse load (K5, D1, T2) and the direct load (K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import enforce
from ..sinks.warehouse import direct_load, warehouse_load
from ..sources.envelope import decode_envelope, encode_envelope, parse_json_isolated, record_fields
from .jobs import enrich_orders, orders_etl
from .registry import query
from .runners import ORDER_SCHEMA
from .tables import ORDER_RECORDS_SQL, order_records

# A fixed processing clock keeps the stamp reproducible (P8: injectable clock).
RUN_CLOCK = "2024-02-01 00:00:00"
RUN_STAMP = "2024-02-01T00:00:00.000000+00:00"


def _enriched(spark, sf):
    """Stream side: records -> base64 envelope -> decode -> enrich."""
    rec = order_records(spark, sf)
    env = encode_envelope(rec.withColumn("_json", F.to_json(F.struct(*rec.columns))), seq="order_id", payload="_json")
    dec = decode_envelope(env, ORDER_SCHEMA)
    dec = dec.where(~F.col("failed")).select(*record_fields(dec))
    return enrich_orders(dec, clock=F.lit(RUN_CLOCK).cast("timestamp_ltz")).withColumn("total_amount", enforce("total_amount", "double"))


def _landed(spark, sf):
    """Batch side: what the stream landed in the lake (enriched records as
    JSON lines, K2), read back as the ETL reads raw JSON (S2)."""
    rec = enrich_orders(order_records(spark, sf), clock=F.lit(RUN_CLOCK).cast("timestamp_ltz"))
    lines = rec.select(F.to_json(F.struct(*rec.columns)).alias("value"))
    parsed = parse_json_isolated(lines, "value", ORDER_SCHEMA, required=[])
    return parsed.where(~F.col("failed")).select(*record_fields(parsed, "parsed"))


# ---------------------------------------------------------------- ST1 (S7 + P7 + P8)
@query("order_stream_enrich", f"""
WITH r AS ({ORDER_RECORDS_SQL})
SELECT order_id, replace(replace(lower(coalesce(category, '')), ' & ', '_'), ' ', '_') AS category,
       total_amount, region, '{RUN_STAMP}' AS processed_at
FROM r
""", covers="ST1 S7 P7 P8")
def order_stream_enrich(spark, sf):
    return _enriched(spark, sf).select("order_id", "category", "total_amount", "region", "processed_at")


_ETL_COLS = ("customer_id, product_id, product_name, category, quantity, unit_price, total_amount, "
             "order_status, payment_method, region, \"timestamp\", processed_at, event_ts, year, month, day")


# ---------------------------------------------------------------- K5 (+ orders ETL, D1, T2)
@query("orders_warehouse_load", f"""
WITH r AS ({ORDER_RECORDS_SQL}),
e AS (
  SELECT order_id, customer_id, product_id, product_name,
         replace(replace(lower(coalesce(category, '')), ' & ', '_'), ' ', '_') AS category,
         quantity, unit_price, total_amount, order_status, payment_method, region, "timestamp",
         '{RUN_STAMP}' AS processed_at FROM r),
c AS (
  SELECT order_id, customer_id, product_id, trim(product_name) AS product_name, lower(trim(category)) AS category,
         quantity, unit_price, total_amount, lower(trim(order_status)) AS order_status,
         lower(trim(payment_method)) AS payment_method, lower(trim(region)) AS region, "timestamp", processed_at,
         CAST(CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_ts,
         strftime(CAST(CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP), '%Y') AS year,
         strftime(CAST(CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP), '%m') AS month,
         strftime(CAST(CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP), '%d') AS day
  FROM e),
d AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_ETL_COLS}) AS rn FROM c
      WHERE order_id IS NOT NULL AND "timestamp" IS NOT NULL AND total_amount IS NOT NULL)
SELECT order_id, customer_id, product_id, product_name, category, quantity, unit_price, total_amount,
       order_status, payment_method, region, "timestamp", processed_at, event_ts
FROM d WHERE rn = 1
""", covers="K5 D1 P4 P9 ST6")
def orders_warehouse_load(spark, sf):
    return warehouse_load(orders_etl(_landed(spark, sf)))


# ---------------------------------------------------------------- K6
@query("orders_direct_load", f"""
WITH r AS ({ORDER_RECORDS_SQL})
SELECT substring(order_id, 1, 50) AS order_id, substring(customer_id, 1, 50) AS customer_id,
       substring(product_id, 1, 50) AS product_id,
       substring(CASE quantity % 10 WHEN 1 THEN repeat(product_name, 20) WHEN 2 THEN product_name || chr(65533) || '(' ELSE product_name END, 1, 200) AS product_name,
       substring(replace(replace(lower(coalesce(category, '')), ' & ', '_'), ' ', '_'), 1, 100) AS category,
       quantity, unit_price, total_amount, substring(order_status, 1, 50) AS order_status,
       substring(payment_method, 1, 50) AS payment_method, substring(region, 1, 50) AS region,
       substring("timestamp", 1, 50) AS "timestamp", '{RUN_STAMP}' AS processed_at
FROM r
""", covers="K6 ST2")
def orders_direct_load(spark, sf):
    # names that are too long for their column, and names with a broken byte
    q, name = F.col("quantity").cast("int") % 10, F.col("product_name")
    broken = F.concat(name.cast("binary"), F.unhex(F.lit("C328"))).cast("string")
    rows = _landed(spark, sf).withColumn("product_name", F.when(q == 1, F.repeat(name, F.lit(20))).when(q == 2, broken).otherwise(name))
    return direct_load(rows)
