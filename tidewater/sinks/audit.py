"""Audit and insert-with-defaults sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def report_audit(reports: DataFrame, filename: str = "filename", data: str = "data",
                 status: str | Column = "processed", created_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """K9: (id, filename, record_count, status, created_at) per validated
    report, one row each. ``data`` is the records or their number; ``status`` a
    text or a column. The id is a hash of the file name and of the columns in
    ``keep`` (the load, say), which stay: reports that call themselves the same
    have ids of their own, and one that is processed again keeps its id."""
    ts = F.current_timestamp() if created_at is None else created_at
    size = F.size(F.col(data)) if reports.schema[data].dataType.typeName() == "array" else F.col(data)
    return reports.select(F.xxhash64(F.col(filename), *keep).alias("id"), F.col(filename).alias("filename"), size.alias("record_count"),
                          (F.lit(status) if isinstance(status, str) else status).alias("status"), ts.alias("created_at"), *keep)


def with_defaults(df: DataFrame, defaults: dict[str, Column], id_col: str | None = None) -> DataFrame:
    """Fill missing columns / nulls with defaults (e.g. now()), and add a
    random surrogate id; for serial ones see ``with_serial_ids``."""
    out = df
    for c, d in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), d) if c in df.columns else d)
    return out.withColumn(id_col, F.uuid()) if id_col else out


def with_serial_ids(df: DataFrame, id_col: str = "id", file: str = "source_file", block: str = "source_block", last: int = 0) -> DataFrame:
    """Ids last + 1, last + 2, ... without gaps, in the order of the rows in
    their files (by path, then place), however the scan is split. ``file`` and
    ``block`` are ``_metadata.file_path`` and ``_metadata.file_block_start`` of
    the row; ``df`` is a scan with any filters, before any shuffle.

    A scan reads a split of a file in one piece, so a row's id is the number of
    rows in the pieces before, one count per piece, and its place in the piece,
    which ``monotonically_increasing_id`` gives up to a constant. Only the
    pieces' counts are ordered in one task (one row per input split)."""
    at = df.withColumn("_at", F.monotonically_increasing_id())
    pieces = at.groupBy(file, block).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = F.sum("_rows").over(Window.orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(F.col(file).alias("_file"), F.col(block).alias("_block"), "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = at.join(pieces, (F.col(file) == F.col("_file")) & (F.col(block) == F.col("_block")))
    kept = [F.col(f"`{c}`") for c in df.columns if c != id_col]
    return joined.select(*kept, (F.lit(last) + F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("long").alias(id_col))
