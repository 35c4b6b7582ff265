"""Metric alarms on the driver tables (W1-W7): events are the metric stream
(metric = event_type, value = value); ship lag (line ship date minus order
date) stands in for consumer lag."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alarms as AL
from ..session import read_table
from .registry import query

_STATS_CTE = """
s AS (
  SELECT event_type, time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01') AS period_start,
         round(sum(value), 2) AS total
  FROM events GROUP BY 1, 2)"""


def _rounded_stats(spark, sf, period_s: int):
    ev = read_table(spark, sf, "events")
    st = AL.window_stats(ev, "ts", "value", period_s, keys=["event_type"], stats=("sum", "max", "count"))
    total = F.round("sum", 2)
    return st.select("event_type", "period_start", total.alias("sum"), "max", "count", (total / F.col("count")).alias("avg"))


# ---------------------------------------------------------------- W1
@query("event_window_stats", """
SELECT event_type, time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01') AS period_start,
       round(sum(value), 2) AS sum, max(value) AS max, count(*) AS count, round(sum(value), 2) / count(*) AS avg
FROM events GROUP BY 1, 2
""", covers="W1")
def event_window_stats(spark, sf, period_s: int = 300):
    return _rounded_stats(spark, sf, period_s)


# ---------------------------------------------------------------- W2
@query("event_window_p99", """
SELECT event_type, time_bucket(INTERVAL '3600 seconds', ts, TIMESTAMP '1970-01-01') AS period_start,
       round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY 1, 2
""", covers="W2")
def event_window_p99(spark, sf, period_s: int = 3600):
    # Interpolated percentiles of 2-decimal values have at most 4 decimals;
    # rounding to 6 removes floating-point noise of the interpolation order.
    # Exact is safe here: values are cents in a bounded range, so a group's
    # buffer has a bounded number of distinct entries ("p99_approx" otherwise).
    ev = read_table(spark, sf, "events")
    st = AL.window_stats(ev, "ts", "value", period_s, keys=["event_type"], stats=("p99",))
    return st.withColumn("p99", F.round("p99", 6))


# Alarm on the 5-minute value total per event type: breach when the total is
# >= 40 for 2 consecutive periods; periods without events do not breach.
ALARM_THRESHOLD, ALARM_PERIODS = 40, 2

_GRID_SQL = f"""
WITH {_STATS_CTE},
b AS (SELECT event_type, min(period_start) AS lo, max(period_start) AS hi FROM s GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, hi + INTERVAL '300 seconds', INTERVAL '300 seconds')) AS period_start FROM b),
x AS (SELECT g.event_type, g.period_start, CASE WHEN s.total >= {ALARM_THRESHOLD} THEN 1 ELSE 0 END AS br
      FROM g LEFT JOIN s ON g.event_type = s.event_type AND g.period_start = s.period_start),
st AS (SELECT event_type, period_start,
              CASE WHEN sum(br) OVER (PARTITION BY event_type ORDER BY period_start
                        ROWS BETWEEN {ALARM_PERIODS - 1} PRECEDING AND CURRENT ROW) = {ALARM_PERIODS}
                   THEN 'ALARM' ELSE 'OK' END AS state
       FROM x)"""


def _value_totals(spark, sf):
    st = AL.window_stats(read_table(spark, sf, "events"), "ts", "value", 300, keys=["event_type"], stats=("sum",))
    return st.withColumn("sum", F.round("sum", 2))


# ---------------------------------------------------------------- W3, W5
@query("event_alarm_transitions", _GRID_SQL + """
SELECT event_type, period_start, state FROM (
  SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY event_type ORDER BY period_start) AS prev FROM st)
WHERE state <> prev
""", covers="W3 W4 W5")
def event_alarm_transitions(spark, sf):
    return AL.alarm_transitions(_value_totals(spark, sf), "sum", ALARM_THRESHOLD, ">=", ALARM_PERIODS, 300,
                                keys=["event_type"])


# ---------------------------------------------------------------- W4
@query("event_alarm_states", _GRID_SQL + """
SELECT event_type, period_start, state FROM st SEMI JOIN b ON st.event_type = b.event_type AND st.period_start <= b.hi
""", covers="W4")
def event_alarm_states(spark, sf):
    return AL.alarm_states(_value_totals(spark, sf), "sum", ALARM_THRESHOLD, ">=", ALARM_PERIODS, 300,
                           keys=["event_type"])


# ---------------------------------------------------------------- W6
# Ship lag: a line's ship time minus its order time, in ms; alarm when the
# weekly maximum exceeds 60 days for 2 consecutive weeks.
LAG_PERIOD_S, LAG_LIMIT_MS, LAG_PERIODS = 7 * 86400, 60 * 86400 * 1000, 2


@query("ship_lag_alarm", f"""
WITH s AS (
  SELECT time_bucket(INTERVAL '{LAG_PERIOD_S} seconds', l.l_shipdate, TIMESTAMP '1970-01-01') AS period_start,
         max(epoch_ms(l.l_shipdate) - epoch_ms(o.o_orderdate)) AS max_lag_ms
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
b AS (SELECT min(period_start) AS lo, max(period_start) AS hi FROM s),
g AS (SELECT unnest(generate_series(lo, hi + INTERVAL '{LAG_PERIOD_S} seconds', INTERVAL '{LAG_PERIOD_S} seconds')) AS period_start FROM b),
x AS (SELECT g.period_start, CASE WHEN s.max_lag_ms > {LAG_LIMIT_MS} THEN 1 ELSE 0 END AS br
      FROM g LEFT JOIN s ON g.period_start = s.period_start),
st AS (SELECT period_start, CASE WHEN sum(br) OVER (ORDER BY period_start ROWS BETWEEN {LAG_PERIODS - 1} PRECEDING
                                   AND CURRENT ROW) = {LAG_PERIODS} THEN 'ALARM' ELSE 'OK' END AS state FROM x)
SELECT period_start, state FROM (SELECT *, lag(state, 1, 'OK') OVER (ORDER BY period_start) AS prev FROM st)
WHERE state <> prev
""", covers="W6")
def ship_lag_alarm(spark, sf):
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    # Reduce lines to one row per (order, week) before the join: the lag of
    # the latest line is the week's lag for that order.
    w = F.window("l_shipdate", f"{LAG_PERIOD_S} seconds")
    per_order = li.groupBy("l_orderkey", w.alias("_w")).agg(F.max("l_shipdate").alias("ship"))
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    lag_ms = (F.unix_micros(F.col("ship").cast("timestamp_ltz")) - F.unix_micros(F.col("o_orderdate").cast("timestamp_ltz"))) / 1000
    stats = j.groupBy(F.col("_w.start").alias("period_start")).agg(F.max(lag_ms.cast("long")).alias("max_lag_ms"))
    return AL.alarm_transitions(stats, "max_lag_ms", LAG_LIMIT_MS, ">", LAG_PERIODS, LAG_PERIOD_S)


# ---------------------------------------------------------------- W7
@query("event_dashboard_series", """
SELECT time_bucket(INTERVAL '60 seconds', ts, TIMESTAMP '1970-01-01') AS period_start, event_type, count(*) AS value
FROM events GROUP BY 1, 2
""", covers="W7")
def event_dashboard_series(spark, sf):
    return AL.multi_metric_series(read_table(spark, sf, "events"), "ts", "event_type", period_s=60)


# An alarm that stands when its data stops: only the first days' events are
# points, and the evaluation ends much later.
STOP, UNTIL = "2024-01-03", "2024-01-05"


@query("event_alarm_after_silence", f"""
WITH s AS (
  SELECT event_type, time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01') AS period_start, round(sum(value), 2) AS total
  FROM events WHERE ts < TIMESTAMP '{STOP}' GROUP BY 1, 2),
b AS (SELECT event_type, min(period_start) AS lo FROM s GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, TIMESTAMP '{UNTIL}' - INTERVAL '300 seconds', INTERVAL '300 seconds')) AS period_start FROM b),
x AS (SELECT g.event_type, g.period_start, coalesce(s.total >= 1, false) AS br
      FROM g LEFT JOIN s ON g.event_type = s.event_type AND g.period_start = s.period_start),
st AS (SELECT event_type, period_start, CASE WHEN br THEN 'ALARM' ELSE 'OK' END AS state FROM x)
SELECT event_type, period_start, state FROM (
  SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY event_type ORDER BY period_start) AS prev FROM st) WHERE state <> prev
""", covers="W3 W4 W5")
def event_alarm_after_silence(spark, sf):
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    st = AL.window_stats(read_table(spark, sf, "events").where(F.col("ts") < day(STOP)), "ts", "value", 300, keys=["event_type"], stats=("sum",))
    return AL.alarm_transitions(st.withColumn("sum", F.round("sum", 2)), "sum", 1, ">=", 1, 300, keys=["event_type"], end=day(UNTIL))
