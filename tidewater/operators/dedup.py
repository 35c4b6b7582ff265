"""Deduplication (D1, D2; D3 lives in ``tidewater.streaming``).

Survivor selection is an aggregate, not a ``row_number()`` window: ``min`` /
``max`` of a struct is combined map-side, so a key holding a third of all rows
is reduced inside every map task before the shuffle. A window would have to
ship every copy of that key to one task and sort it there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _order_cols(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> list[str]:
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    return order + rest


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
             latest: bool = False) -> DataFrame:
    """One row per key, chosen deterministically.

    The survivor is the row that sorts first (``latest=False``) or last
    (``latest=True``) by ``order`` and then by every remaining column, so the
    result does not depend on input order or partitioning. Ties on all
    columns are exact copies, so which copy survives is irrelevant.
    Null ordering follows Spark's default (nulls sort first).
    """
    keys = list(keys)
    cols = _order_cols(df, keys, order)
    if not cols:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in cols])
    pick = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_survivor"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col("_survivor")[c].alias(c) for c in cols]).select(*df.columns)


def dedup_by_key(df: DataFrame, keys: Sequence[str], required: Sequence[str] | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Business-key dedup. Rows missing a required field are dropped
    *before* choosing the survivor (trap T2: the reverse order can keep the
    incomplete copy and then lose the key altogether)."""
    if required:
        df = df.na.drop(how="any", subset=list(required))
    return keep_one(df, keys, order)


def dedup_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop exact copies. ``ignore`` lists columns (e.g. an id kept for
    lineage, trap T9) that do not make two rows different."""
    if not ignore:
        return df.dropDuplicates()
    subset = [c for c in df.columns if c not in set(ignore)]
    return keep_one(df, subset, order=list(ignore))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus copies in one aggregation pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                       (F.sum("n") - F.count(F.lit(1))).alias("surplus_rows"))


def latest_by(df: DataFrame, keys: Sequence[str], seq: Sequence[str] | str) -> DataFrame:
    """Last write wins: the row with the greatest ``seq`` per key."""
    seq = [seq] if isinstance(seq, str) else list(seq)
    return keep_one(df, keys, order=seq, latest=True)
