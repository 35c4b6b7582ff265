"""Typed warehouse loads (K5, K6).

Columns are always matched **by name** and emitted in DDL order (trap T8:
JSON-inferred Parquet has alphabetical columns, so a positional load would
shift values between columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Warehouse DDL (column, type, VARCHAR width or None).
ORDERS_DDL = [
    ("order_id", "string", 50), ("customer_id", "string", 50), ("product_id", "string", 50),
    ("product_name", "string", 200), ("category", "string", 100), ("quantity", "int", None),
    ("unit_price", "double", None), ("total_amount", "double", None), ("order_status", "string", 50),
    ("payment_method", "string", 50), ("region", "string", 50), ("timestamp", "string", 50),
    ("processed_at", "string", 50), ("event_ts", "timestamp_ntz", None),
]
ORDERS_DIRECT_DDL = [c for c in ORDERS_DDL if c[0] != "event_ts"]


def typed_columns(df: DataFrame, ddl, truncate: bool = False, fix_utf8: bool = False) -> DataFrame:
    """Select DDL columns by name (missing -> null), cast, optionally replace
    invalid UTF-8 and truncate text to the column width."""
    present = set(df.columns)
    cols = []
    for name, typ, width in ddl:
        c = F.col(name) if name in present else F.lit(None)
        c = c.cast(typ) if typ.startswith("timestamp") else c.try_cast(typ)
        if typ == "string" and fix_utf8:
            c = F.make_valid_utf8(c)
        if typ == "string" and truncate and width:
            c = F.substring(c, 1, width)
        cols.append(c.alias(name))
    return df.select(*cols)


def warehouse_load(df: DataFrame, ddl=ORDERS_DDL) -> DataFrame:
    """K5: cleaned rows -> the fixed typed table, by name."""
    return typed_columns(df, ddl)


def direct_load(df: DataFrame, ddl=ORDERS_DIRECT_DDL) -> DataFrame:
    """K6: raw JSON rows -> table: match by name, replace invalid characters,
    truncate to column width (no dedup: the direct path keeps re-sends)."""
    return typed_columns(df, ddl, truncate=True, fix_utf8=True)


def write_distributed(df: DataFrame, table: str, dist_key: str, sort_key: str, mode: str = "append",
                      buckets: int | None = None) -> None:
    """Mirror a distribution key + sort key: rows with the same key land in
    the same bucket, sorted inside it, so later joins / range scans on the
    key avoid a shuffle."""
    w = df.write.mode(mode)
    if buckets:
        w.bucketBy(buckets, dist_key).sortBy(sort_key).saveAsTable(table)
    else:
        # rebalance splits a hot key over several tasks and packs small ones
        df.hint("rebalance", dist_key).sortWithinPartitions(dist_key, sort_key).write.mode(mode).saveAsTable(table)
