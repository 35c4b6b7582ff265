"""Report aggregations (A1-A12), top-k (L1-L3) and labelled unions.

Every report is a hash aggregate: Spark computes partial aggregates inside
each map task and shuffles one row per group per task, so a hot group costs
no more shuffle than a cold one.

Money is summed as it is, in double precision, and only a group's total is
rounded (to ``scale`` decimals). No row is rounded: amounts of any scale add up
to their sum. The rounding also hides the order of the additions, unless the
true sum lies within its noise (about 1e-16 of the total per row) of a half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(col, scale: int = 2) -> Column:
    """Sum of an amount; the total, not the rows, is rounded."""
    return F.round(F.sum(_c(col).cast("double")), scale)


# ---------------------------------------------------------------- A1
def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------------- A2, A4-A7
def totals_by(df: DataFrame, keys: Sequence[str | Column], amount: str | Column,
              total_name: str = "total_revenue", count_name: str = "tx_count",
              extra: Sequence[Column] = (), scale: int = 2) -> DataFrame:
    """Sum of an amount and row count per group."""
    return df.groupBy(*keys).agg(money_sum(amount, scale).alias(total_name),
                                 F.count(F.lit(1)).alias(count_name), *extra)


# ---------------------------------------------------------------- A3, L1, L2
def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First k rows by ``order``; planned as TakeOrderedAndProject (each
    task keeps its own k best, the driver merges k x tasks rows)."""
    return df.orderBy(*order).limit(k)


# ---------------------------------------------------------------- A8
def dashboard_stats(reports: DataFrame, status: str = "status", records: str = "record_count",
                    completed: Sequence[str] = ("completed",), failed: Sequence[str] = ("failed",)) -> DataFrame:
    """Total, completed, failed and total records in one pass (trap T7: the
    status vocabularies are parameters)."""
    s = F.col(status)
    return reports.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(s.isin(*completed), F.lit(False))).alias("completed"),
        F.count_if(F.coalesce(s.isin(*failed), F.lit(False))).alias("failed"),
        F.coalesce(F.sum(F.col(records).cast("long")), F.lit(0).cast("long")).alias("total_records"),
    )


# ---------------------------------------------------------------- A9
def daily_counts(df: DataFrame, ts: str, date_name: str = "date", count_name: str = "total_visitors",
                 keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(F.to_date(F.col(ts)).alias(date_name), *keys).agg(F.count(F.lit(1)).alias(count_name))


# ---------------------------------------------------------------- A10
def positive_rate(df: DataFrame, label: str, keys: Sequence[str] = (), name: str = "positive_rate") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(label).cast("double")).alias(name),
                                 F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- A12
def clean_audit(raw: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raw rows vs rows that survive the null drop, in one scan."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(ok).alias("clean_rows"),
                   F.count_if(~ok).alias("dropped_rows"))


# ---------------------------------------------------------------- U1
def labelled_counts(**frames: DataFrame) -> DataFrame:
    """UNION ALL of (label, count) rows, e.g. clean path vs direct path."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias("source"), "row_count")
             for label, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- F2
def optional_filter(df: DataFrame, **equals) -> DataFrame:
    """Equality filter on the given columns; a value of None means no filter."""
    for c, v in equals.items():
        if v is not None:
            df = df.where(F.col(c) == F.lit(v))
    return df


# ---------------------------------------------------------------- F3
def day_filter(df: DataFrame, ts: str, day) -> DataFrame:
    """Rows whose timestamp falls on ``day``, as a half-open range so the
    predicate reaches the Parquet scan (``to_date(ts) = d`` would not)."""
    start = F.lit(day).cast("date")
    col = F.col(ts)
    lo = start.cast(df.schema[ts].dataType.simpleString())
    hi = F.date_add(start, 1).cast(df.schema[ts].dataType.simpleString())
    return df.where((col >= lo) & (col < hi))
