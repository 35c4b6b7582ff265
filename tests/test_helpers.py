"""Smaller public helpers: alarm periods, content ids, quarantine split,
routed writers, vector assembly, duplicate report."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions.features import assemble
from tidewater.functions.rules import content_id
from tidewater.operators import alarms as AL
from tidewater.operators.dedup import duplicate_report
from tidewater.operators.routing import route_by_severity, split_valid
from tidewater.sinks.fanout import fan_out, routed_writers


def test_alarm_periods(spark):
    t0 = dt.datetime(2024, 1, 1)
    stats = spark.createDataFrame([("m", t0 + dt.timedelta(minutes=5 * i), v) for i, v in enumerate([9.0, 9.0, 9.0, 1.0, 9.0])],
                                  "k string, period_start timestamp_ntz, sum double")
    got = [r.period_start for r in AL.alarm_periods(stats, "sum", 5, ">", 2, 300, keys=["k"]).orderBy("period_start").collect()]
    assert got == [t0 + dt.timedelta(minutes=5), t0 + dt.timedelta(minutes=10)]


def test_content_id_is_reproducible(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "x string, y int")
    ids = [r[0] for r in df.select(content_id("x", "y")).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64


def test_split_valid(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, amount double")
    good, bad = split_valid(df, {"amount_not_positive": F.col("amount") > 0})
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.errors) for r in bad.collect()) == [(2, ["amount_not_positive"]), (3, ["amount_not_positive"])]


def test_routed_writers(spark, tmp):
    inc = spark.createDataFrame([("a", "HIGH"), ("b", "LOW"), ("c", None)], "id string, severity string")
    fan_out(routed_writers(f"{tmp}/routes"))(route_by_severity(inc), 7)
    assert [r.id for r in spark.read.json(f"{tmp}/routes/alert").collect()] == ["a"]
    assert sorted(r.id for r in spark.read.json(f"{tmp}/routes/log").collect()) == ["b", "c"]


def test_assemble_vector(spark):
    df = spark.createDataFrame([(1.0, 2, None)], "a double, b int, c double")
    v = assemble(df, ["a", "b", "c"]).first().features
    assert v.size == 3 and v[0] == 1.0 and v[1] == 2.0


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k int")
    r = duplicate_report(df, ["k"]).first()
    assert (r.rows, r.distinct_keys, r.surplus_rows) == (6, 3, 3)


def test_missing_fields_on_a_map(spark):
    from tidewater.functions.contracts import missing_fields
    df = spark.createDataFrame([({"filename": "a", "data": "1"},), ({"data": "1"},), ({"filename": None},)],
                               "doc map<string,string>")
    got = [r[0] for r in df.select(missing_fields("doc", ["filename", "data"])).collect()]
    assert got == [[], ["filename"], ["filename", "data"]]


def test_optional_filter_without_value_keeps_all_rows(spark):
    from tidewater.operators.reports import optional_filter
    df = spark.createDataFrame([("electronics",), ("furniture",), ("kitchen",), ("electronics",)], "category string")
    assert optional_filter(df, category=None).count() == 4
    assert optional_filter(df, category="electronics").count() == 2
