"""The reference's batch jobs as DataFrame transformations (no I/O here;
``plans.runners`` wires them to sources and sinks)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.dedup import dedup_by_key, dedup_rows

# Required fields of each job.
SALES_REQUIRED = ["transaction_id", "sale_date", "amount"]
ORDERS_REQUIRED = ["order_id", "timestamp", "total_amount"]
FEATURES_REQUIRED = ["amount_log", "merchant_cat_encoded", "hour_of_day"]


def incomplete(required: list[str]) -> F.Column:
    """Which rows lack a required value (after the casts)."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return missing


def sales_typed(raw: DataFrame) -> DataFrame:
    """CSV sales with snake names and types; values that do not cast are null."""
    return C.normalize_column_names(raw).withColumns({
        "amount": C.enforce("amount", "double"),
        "quantity": C.enforce("quantity", "int"),
        "unit_price": C.enforce("unit_price", "double"),
        "sale_date": C.enforce("sale_date", "date", "yyyy-MM-dd"),
        "product_name": C.trimmed("product_name"),
        "category": C.lower_trimmed("category"),
    })


def sales_etl(raw: DataFrame, drop_after_cast: bool = True) -> DataFrame:
    """CSV sales -> clean rows with year/month/day partitions.

    ``drop_after_cast=False`` reproduces the reference's order (drop nulls,
    then cast), where a value that fails to cast survives as null (T1)."""
    if not drop_after_cast:
        raw = C.drop_incomplete(C.normalize_column_names(raw), SALES_REQUIRED)
    df = sales_typed(raw)
    if drop_after_cast:
        df = C.drop_incomplete(df, SALES_REQUIRED)
    return C.with_date_partitions(df, "sale_date")


def orders_typed(raw: DataFrame) -> DataFrame:
    """Order JSON, typed; a value that does not cast is null (only a missing
    required one costs the order)."""
    return raw.withColumns({
        "product_name": C.trimmed("product_name"),
        "category": C.lower_trimmed("category"),
        "region": C.lower_trimmed("region"),
        "order_status": C.lower_trimmed("order_status"),
        "payment_method": C.lower_trimmed("payment_method"),
        "quantity": C.enforce("quantity", "int"),
        "unit_price": C.enforce("unit_price", "double"),
        "total_amount": C.enforce("total_amount", "double"),
        "event_ts": C.parse_iso_timestamp("timestamp").cast("timestamp_ntz"),
    })


def orders_etl(raw: DataFrame) -> DataFrame:
    """Order JSON -> clean, typed, one row per order_id, partitioned.

    Rows missing a required field are dropped *before* the dedup (T2)."""
    df = C.with_date_partitions(orders_typed(raw), "event_ts")
    return dedup_by_key(df, ["order_id"], required=ORDERS_REQUIRED)


def features_etl(features: DataFrame, run_date: _dt.date) -> DataFrame:
    """Feature rows -> typed, deduplicated, ingest-date partitions. Only rows
    equal in every column are one: with their ids, two transactions with equal
    features stay two (T9)."""
    types = {"amount_log": "double", "merchant_cat_encoded": "int", "hour_of_day": "int",
             "day_of_week": "int", "account_age_days": "int", "prev_fraud_count": "int",
             "distance_km_log": "double", "is_foreign": "int", "tx_freq_24h": "int"}
    df = C.drop_incomplete(dedup_rows(features), FEATURES_REQUIRED)
    df = C.enforce_types(df, types)
    return df.withColumns(C.ingest_partitions(run_date))


def enrich_orders(decoded: DataFrame, clock: F.Column | None = None) -> DataFrame:
    """Stream enrichment: category slug + processed_at stamp (ST1)."""
    return decoded.withColumns({"category": C.slug("category"), "processed_at": C.iso_stamp(clock)})
