"""Metric alarms over tumbling windows.

``alarm(df, ts, value, stat, period_s, eval_periods, threshold, cmp)``

Plan shape, chosen for scale:

* W1/W2 statistics are one hash aggregate on (key, window): partial
  aggregation map-side, so a hot metric costs one row per window per task.
* W3 "N consecutive breaching periods" is *not* a running window over an
  ordered series (that would put a whole metric key in one task). Each
  breaching period p votes for the N periods p, p+1, ..., p+N-1; a period is in
  ALARM when it receives N votes. This is an explode + hash aggregate and
  parallelises over (key, period). Missing periods cast no vote, which is
  exactly "missing data = not breaching" (W4) without building a grid.
* W5 transitions compare each ALARM period with its predecessor the same way
  (a mark for p and for p+1), again a hash aggregate.
* No window is ordered over a key's series, and none runs over all keys: there
  is no task per key, and no single task without keys.
* The dense per-period state series (W4) is optional; its grid is filled in
  two levels, blocks of periods first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARATORS = {
    ">": lambda v, t: v > t,
    ">=": lambda v, t: v >= t,
    "<": lambda v, t: v < t,
    "<=": lambda v, t: v <= t,
}

STATISTICS = {
    "sum": lambda v: F.sum(v),
    "avg": lambda v: F.avg(v),
    "average": lambda v: F.avg(v),
    "max": lambda v: F.max(v),
    "maximum": lambda v: F.max(v),
    "min": lambda v: F.min(v),
    "count": lambda v: F.count(v),
    # exact, linear interpolation (same definition as SQL percentile_cont);
    # its buffer holds one entry per *distinct* value of a (key, window)
    # group, so use it when values come from a bounded domain (cents,
    # milliseconds, status codes)
    "p99": lambda v: F.percentile(v, 0.99),
    # fixed-size sketch (relative rank error 1/10000) for unbounded domains
    # or very hot groups
    "p99_approx": lambda v: F.percentile_approx(v, 0.99, 10000),
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _step(period_s: int) -> Column:
    return F.expr(f"INTERVAL {int(period_s)} SECONDS")


# ---------------------------------------------------------------- W1, W2, W6, W7
def window_stats(df: DataFrame, ts: str, value: str | Column | None, period_s: int,
                 keys: Sequence[str] = (), stats: Sequence[str] = ("sum", "avg", "max", "count"),
                 period_col: str = "period_start") -> DataFrame:
    """One row per (keys, tumbling window) with the requested statistics."""
    v = _c(value) if value is not None else F.lit(1)
    aggs = [STATISTICS[s](v).alias(s) for s in stats]
    w = F.window(F.col(ts), f"{int(period_s)} seconds")
    return (df.groupBy(*keys, w.alias("_w")).agg(*aggs)
              .select(*keys, F.col("_w.start").alias(period_col), *stats))


def multi_metric_series(df: DataFrame, ts: str, metric: str, period_s: int = 60, value: str | None = None,
                        period_col: str = "period_start", value_col: str = "value") -> DataFrame:
    """One row per window and metric, whatever metrics occur: the long form
    of a dashboard's series (none is left out for not being on a list)."""
    w = F.window(F.col(ts), f"{int(period_s)} seconds")
    total = F.sum(F.col(value)) if value else F.count(F.lit(1))
    return (df.groupBy(w.alias("_w"), metric).agg(total.alias(value_col))
              .select(F.col("_w.start").alias(period_col), metric, value_col))


# ---------------------------------------------------------------- W2, mergeable
#: KLL sketches of this size err by some 0.13 % of rank (2.3 / k ** 0.9), and hold
#: up to so many values exactly
SKETCH_K = 4096


def window_sketches(df: DataFrame, ts: str, value: str | Column, period_s: int = 60, keys: Sequence[str] = (), k: int = SKETCH_K,
                    period_col: str = "period_start") -> DataFrame:
    """One row per (keys, tumbling window): a KLL sketch of the values, of a
    bounded size whatever their number, and their count. Percentiles of longer
    windows, or of batches that came later, merge these rows (``merge_sketches``)
    without reading a point again."""
    w = F.window(F.col(ts), f"{int(period_s)} seconds")
    return (df.where(_c(value).isNotNull()).groupBy(*keys, w.alias("_w"))
              .agg(F.kll_sketch_agg_double(_c(value).cast("double"), k).alias("sketch"), F.count(F.lit(1)).alias("count"))
              .select(*keys, F.col("_w.start").alias(period_col), "sketch", "count"))


def merge_sketches(sketches: DataFrame, period_s: int, keys: Sequence[str] = (), k: int = SKETCH_K, period_col: str = "period_start") -> DataFrame:
    """Sketches of windows of ``period_s``, a multiple of the windows given:
    those of one longer window, or of one window in several batches."""
    w = F.window(F.col(period_col), f"{int(period_s)} seconds")
    return (sketches.groupBy(*keys, w.alias("_w")).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("count").alias("count"))
                    .select(*keys, F.col("_w.start").alias(period_col), "sketch", "count"))


def sketch_percentile(q: float = 0.99, sketch: str = "sketch") -> Column:
    """The least value that has a share ``q`` of the values at or below it."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(q)))


# ---------------------------------------------------------------- W3, W4
MISSING = "notBreaching"


def _checked(missing: str) -> None:
    if missing != MISSING:
        raise ValueError(f"missing data can only be {MISSING!r}, not {missing!r}")


def _votes(stats: DataFrame, stat: str, threshold: float, cmp: str, keys: Sequence[str], period_col: str, n: int,
           period_s: int) -> DataFrame:
    """Each breaching period votes for itself and the next n-1 periods."""
    breach = F.coalesce(COMPARATORS[cmp](F.col(stat), F.lit(threshold)), F.lit(False))
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    v = stats.where(breach).select(*keys, F.col(period_col).alias("_p"), k.alias("_k"))
    return v.select(*keys, (F.col("_p") + F.make_dt_interval(secs=F.col("_k") * int(period_s))).alias("_at"))


def alarm_periods(stats: DataFrame, stat: str, threshold: float, cmp: str, eval_periods: int,
                  period_s: int, keys: Sequence[str] = (), period_col: str = "period_start", missing: str = MISSING) -> DataFrame:
    """(keys, period) for every period whose last ``eval_periods`` periods all
    breach. Periods without a data point never breach."""
    _checked(missing)
    keys, n = list(keys), int(eval_periods)
    votes = _votes(stats, stat, threshold, cmp, keys, period_col, n, period_s)
    return (votes.groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") == n).select(*keys, F.col("_at").alias(period_col)))


# ---------------------------------------------------------------- W5
def alarm_transitions(stats: DataFrame, stat: str, threshold: float, cmp: str, eval_periods: int,
                      period_s: int, keys: Sequence[str] = (), period_col: str = "period_start", missing: str = MISSING,
                      end=None) -> DataFrame:
    """State changes (OK->ALARM, ALARM->OK). The state before the first period
    is OK. Missing data does not breach, past the last point as in a gap: an
    alarm whose data stops returns to OK in the next period. ``end`` is the
    time of the evaluation: changes from it on are not known yet.

    Plan: votes -> hash aggregate -> ALARM periods; each ALARM period p then
    marks p as "alarm now" and p+1 as "alarm before" -> hash aggregate; an
    edge is where exactly one holds. No key's series is ordered anywhere."""
    keys = list(keys)
    alarm = alarm_periods(stats, stat, threshold, cmp, eval_periods, period_s, keys, period_col, missing)
    marks = F.explode(F.array(
        F.struct(F.col(period_col).alias("at"), F.lit(1).alias("cur"), F.lit(None).cast("int").alias("prev")),
        F.struct((F.col(period_col) + _step(period_s)).alias("at"), F.lit(None).cast("int").alias("cur"),
                 F.lit(1).alias("prev"))))
    edges = (alarm.select(*keys, marks.alias("_m")).groupBy(*keys, F.col("_m.at").alias("_at"))
                  .agg(F.max("_m.cur").alias("_cur"), F.max("_m.prev").alias("_prev"))
                  .where(F.col("_cur").isNull() | F.col("_prev").isNull()))
    if end is not None:
        edges = edges.where(F.col("_at") < (F.lit(end) if not isinstance(end, Column) else end))
    return edges.select(*keys, F.col("_at").alias(period_col),
                        F.when(F.col("_cur") == 1, F.lit("ALARM")).otherwise(F.lit("OK")).alias("state"))


#: periods of one block of the dense grid
BLOCK_PERIODS = 1440


def alarm_states(stats: DataFrame, stat: str, threshold: float, cmp: str, eval_periods: int,
                 period_s: int, keys: Sequence[str] = (), period_col: str = "period_start", missing: str = MISSING,
                 end=None) -> DataFrame:
    """The dense per-period state series of each key, from its first
    observed period to its last (or up to ``end``, the time of the evaluation).

    The grid is filled in two levels: a key's range is cut into blocks of
    ``BLOCK_PERIODS`` periods, which are dealt out and then filled, so that
    neither a long gap nor a long series is one row or one task. Grid rows and
    votes meet in one hash aggregate on (key, period)."""
    _checked(missing)
    keys, n = list(keys), int(eval_periods)
    last = F.max(period_col)
    if end is not None:
        last = F.greatest(last, (F.lit(end) if not isinstance(end, Column) else end) - _step(period_s))
    ranges = stats.groupBy(*keys).agg(F.min(period_col).alias("_lo"), last.alias("_hi")).where("_lo IS NOT NULL")
    blocks = ranges.select(*keys, "_hi", F.explode(F.sequence("_lo", "_hi", _step(period_s * BLOCK_PERIODS))).alias("_b"))
    blocks = blocks.hint("rebalance")
    inner = F.sequence("_b", F.least(F.col("_b") + _step(period_s * (BLOCK_PERIODS - 1)), F.col("_hi")), _step(period_s))
    grid = blocks.select(*keys, F.explode(inner).alias("_at")).withColumns({"_grid": F.lit(1), "_vote": F.lit(0)})
    votes = _votes(stats, stat, threshold, cmp, keys, period_col, n, period_s).withColumns({"_grid": F.lit(0), "_vote": F.lit(1)})
    agg = grid.unionByName(votes).groupBy(*keys, "_at").agg(F.max("_grid").alias("_grid"), F.sum("_vote").alias("_votes"))
    return agg.where(F.col("_grid") == 1).select(
        *keys, F.col("_at").alias(period_col),
        F.when(F.col("_votes") == n, F.lit("ALARM")).otherwise(F.lit("OK")).alias("state"))


def alarm(df: DataFrame, ts: str, value: str | Column | None, stat: str, period_s: int,
          eval_periods: int, threshold: float, cmp: str = ">", keys: Sequence[str] = (),
          output: str = "transitions", missing: str = MISSING, end=None) -> DataFrame:
    """Convenience: statistic per window, then transitions or dense states."""
    stats = window_stats(df, ts, value, period_s, keys, stats=(stat,))
    fn = alarm_transitions if output == "transitions" else alarm_states
    return fn(stats, stat, threshold, cmp, eval_periods, period_s, keys, missing=missing, end=end)


def reference_alarm(df: DataFrame, name: str, ts: str, value: str | Column | None, keys: Sequence[str] = (), **how) -> DataFrame:
    """One of ``REFERENCE_ALARMS`` over a metric's points."""
    stat, period_s, eval_periods, threshold, cmp = REFERENCE_ALARMS[name]
    return alarm(df, ts, value, stat, period_s, eval_periods, threshold, cmp, keys, **how)


# Alarm definitions from the reference's monitoring setup
# (statistic, period seconds, evaluation periods, threshold, comparator). Their
# 99th percentiles are of continuous values, so a fixed-size sketch takes them.
REFERENCE_ALARMS = {
    "stream_iterator_age_ms": ("max", 300, 2, 60000, ">"),
    "function_errors": ("sum", 300, 1, 5, ">="),
    "function_duration_p99_ms": ("p99_approx", 300, 2, 45000, ">"),
    "function_duration_avg_ms": ("avg", 300, 2, 45000, ">"),
    "etl_failed_tasks": ("sum", 300, 1, 1, ">="),
    "etl_executor_run_time_ms": ("max", 60, 8, 60000, ">"),
    "model_errors": ("sum", 300, 1, 5, ">="),
    "cpu_high": ("avg", 120, 2, 80, ">="),
    "lb_5xx": ("sum", 300, 1, 10, ">"),
    "lb_4xx": ("sum", 300, 2, 50, ">"),
    "target_response_p99_s": ("p99_approx", 60, 3, 2.0, ">"),
    "cpu_high_asg": ("avg", 120, 3, 80, ">="),
    "db_free_storage_bytes": ("avg", 300, 1, 5368709120, "<"),
    "db_connections": ("avg", 60, 2, 100, ">"),
}
