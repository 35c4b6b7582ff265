"""Alarms: the vote formulation against a brute-force state machine."""

import datetime as dt
import random

import pytest

from tidewater.operators import alarms as AL

T0 = dt.datetime(2024, 1, 1)


def brute(points, period, n, threshold, cmp):
    """Reference state machine: dense grid from the first period to one past the
    last, missing data = not breaching, ALARM after n consecutive breaches."""
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b}
    sums = {}
    for ts, v in points:
        p = T0 + dt.timedelta(seconds=((ts - T0).total_seconds() // period) * period)
        sums[p] = sums.get(p, 0) + v
    if not sums:
        return []
    lo, hi = min(sums), max(sums)
    out, run, prev, p = [], 0, "OK", lo
    while p <= hi + dt.timedelta(seconds=period):
        run = run + 1 if p in sums and ops[cmp](sums[p], threshold) else 0
        state = "ALARM" if run >= n else "OK"
        if state != prev:
            out.append((p, state))
        prev, p = state, p + dt.timedelta(seconds=period)
    return out


def run(spark, points, period, n, threshold, cmp):
    df = spark.createDataFrame([("m", ts, float(v)) for ts, v in points], "metric string, ts timestamp_ntz, value double")
    got = AL.alarm(df, "ts", "value", "sum", period, n, threshold, cmp, keys=["metric"]).collect()
    return sorted((r.period_start, r.state) for r in got)


def at(i, s=0):
    return T0 + dt.timedelta(seconds=300 * i + s)


CASES = {
    "one breach, N=2 stays OK": ([(at(0), 1), (at(1), 9), (at(2), 1)], 2, 5, ">"),
    "two in a row alarms then recovers": ([(at(0), 9), (at(1), 9), (at(2), 1)], 2, 5, ">"),
    "breach gap breach stays OK": ([(at(0), 9), (at(2), 9), (at(3), 1)], 2, 5, ">"),
    "exact threshold under >": ([(at(0), 5), (at(1), 5)], 2, 5, ">"),
    "exact threshold under >=": ([(at(0), 5), (at(1), 5)], 2, 5, ">="),
    "less-than comparator": ([(at(0), 1), (at(1), 1), (at(2), 9)], 1, 5, "<"),
}


@pytest.mark.parametrize("name", list(CASES))
def test_cases(spark, name):
    pts, n, thr, cmp = CASES[name]
    assert run(spark, pts, 300, n, thr, cmp) == brute(pts, 300, n, thr, cmp)


def test_random_against_brute_force(spark):
    rnd = random.Random(7)
    pts = [(at(rnd.randrange(200), rnd.randrange(300)), rnd.randrange(10)) for _ in range(300)]
    for n, thr, cmp in [(1, 8, ">"), (2, 10, ">="), (3, 5, ">"), (8, 1, ">=")]:
        assert run(spark, pts, 300, n, thr, cmp) == brute(pts, 300, n, thr, cmp)


def test_dense_states_cover_grid(spark):
    pts = [(at(0), 9), (at(1), 9), (at(5), 1)]
    df = spark.createDataFrame([("m", ts, float(v)) for ts, v in pts], "metric string, ts timestamp_ntz, value double")
    st = AL.alarm(df, "ts", "value", "sum", 300, 2, 5, ">", keys=["metric"], output="states").orderBy("period_start").collect()
    assert [r.state for r in st] == ["OK", "ALARM", "OK", "OK", "OK", "OK"]


def test_unkeyed_alarm_has_no_cross_join(spark):
    pts = [(at(0), 9), (at(1), 9), (at(2), 1), (at(3), 9)]
    df = spark.createDataFrame([(ts, float(v)) for ts, v in pts], "ts timestamp_ntz, value double")
    out = AL.alarm(df, "ts", "value", "sum", 300, 2, 5, ">")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan and "Window" not in plan
    assert sorted((r.period_start, r.state) for r in out.collect()) == [(at(1), "ALARM"), (at(2), "OK")]


def test_alarm_returns_to_ok_after_silence(spark):
    pts = [(at(0), 9), (at(1), 9)]
    df = spark.createDataFrame([("m", ts, float(v)) for ts, v in pts], "metric string, ts timestamp_ntz, value double")
    now = lambda k: AL.F.lit(at(k)).cast("timestamp_ntz")
    got = lambda end, **how: sorted((r.period_start, r.state) for r in AL.alarm(
        df, "ts", "value", "sum", 300, 2, 5, ">", keys=["metric"], end=end, **how).collect())
    assert got(None) == got(now(50)) == [(at(1), "ALARM"), (at(2), "OK")]
    assert got(now(2)) == [(at(1), "ALARM")]                    # at that time nothing is known of period 2
    assert [s for _, s in got(now(5), output="states")] == ["OK", "ALARM", "OK", "OK", "OK"]
    with pytest.raises(ValueError):
        AL.alarm(df, "ts", "value", "sum", 300, 2, 5, ">", missing="breaching")


def test_long_gap_is_filled_in_blocks(spark):
    pts = [(at(0), 9), (at(20_000), 9)]
    df = spark.createDataFrame([("m", ts, float(v)) for ts, v in pts], "metric string, ts timestamp_ntz, value double")
    st = AL.alarm(df, "ts", "value", "sum", 300, 1, 5, ">", keys=["metric"], output="states")
    assert st.count() == 20_001 and st.where("state = 'ALARM'").count() == 2


def test_reference_alarm_by_name(spark):
    df = spark.createDataFrame([(at(0, s), float(s)) for s in range(0, 300, 3)], "ts timestamp_ntz, value double")
    got = AL.reference_alarm(df, "function_errors", "ts", "value").collect()
    assert [(r.period_start, r.state) for r in got if r.state == "ALARM"] == [(at(0), "ALARM")]
    assert AL.reference_alarm(df, "target_response_p99_s", "ts", "value").count() == 2


def test_dashboard_series_keeps_every_metric(spark):
    df = spark.createDataFrame([(at(0), "cpu"), (at(0), "new_one"), (at(0), "cpu"), (at(9), None)], "ts timestamp_ntz, metric string")
    got = {(r.metric, r.value) for r in AL.multi_metric_series(df, "ts", "metric", 300).collect()}
    assert got == {("cpu", 2), ("new_one", 1), (None, 1)}
