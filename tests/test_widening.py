"""Tables whose files' schemas differ; K2: landing by size."""

import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import ORDERS, order_json, write_text
from tidewater.plans.runners import ORDER_SCHEMA
from tidewater.sources import catalog
from tidewater.streaming import jobs as S


def test_types_widen():
    cases = {("int", "bigint"): "bigint", ("tinyint", "smallint"): "smallint", ("int", "double"): "double", ("float", "double"): "double", ("int", "float"): "double",
             ("bigint", "double"): None, ("int", "string"): "string", ("date", "string"): "string", ("array<int>", "string"): None, ("boolean", "int"): None}
    for (a, b), want in cases.items():
        assert catalog.wider(a, b) == catalog.wider(b, a) == want


def _load(spark, path, day, columns):
    spark.range(3).selectExpr(*columns).write.parquet(f"{path}/day={day}")


def test_int_then_bigint_is_one_table(spark, tmp):
    _load(spark, f"{tmp}/t", "01", ["cast(id AS int) AS n", "cast(id AS float) AS x", "'a' AS s"])
    t = catalog.register_table(spark, "tw_wide", f"{tmp}/t", partition_cols=["day"])
    assert dict(t.dtypes) == {"n": "int", "x": "float", "s": "string", "day": "string"}
    _load(spark, f"{tmp}/t", "02", ["id + 5000000000 AS n", "cast(id AS double) AS x", "'b' AS s", "true AS late"])
    for _ in range(2):
        t = catalog.register_table(spark, "tw_wide", f"{tmp}/t", partition_cols=["day"])
        assert dict(t.dtypes) == {"n": "bigint", "x": "double", "s": "string", "late": "boolean", "day": "string"}
        assert sorted(r.n for r in t.collect()) == [0, 1, 2, 5000000000, 5000000001, 5000000002]
    spark.sql("DROP TABLE tw_wide")


def test_files_that_do_not_fit_are_named(spark, tmp):
    _load(spark, f"{tmp}/t", "01", ["cast(id AS int) AS n", "id AS m"])
    _load(spark, f"{tmp}/t", "02", ["id AS n", "id AS m"])
    _load(spark, f"{tmp}/t", "03", ["array(id) AS n", "id AS m"])
    table, aside = catalog.read_widened(spark, f"{tmp}/t")
    assert dict(table.dtypes) == {"n": "bigint", "m": "bigint", "day": "string"} and table.count() == 6
    told = aside.collect()
    assert told and all("day=03" in r.path and r.reason == "n: array<bigint> is not bigint" for r in told)
    with pytest.raises(ValueError, match="day=03"):
        catalog.register_table(spark, "tw_not", f"{tmp}/t", partition_cols=["day"])
    _load(spark, f"{tmp}/u", "01", ["cast(id AS int) AS n"])
    _load(spark, f"{tmp}/u", "02", ["'x' AS n", "1.5D AS late"])
    table, aside = catalog.read_widened(spark, f"{tmp}/u")
    assert sorted(r.n for r in table.collect()) == ["0", "1", "2", "x", "x", "x"] and aside.count() == 0
    assert table.where("late IS NULL").count() == 3


def test_landing_batches_stay_near_the_size_and_a_trickle_lands(spark, tmp):
    def envelopes(k, n):
        lines = [json.dumps({"sequence_number": str(100 * k + i), "partition_key": "p", "data": base64.b64encode(order_json(ORDERS[i]).encode()).decode()}) for i in range(n)]
        return os.path.getsize(write_text(f"{tmp}/in/{k:02}.json", lines))

    size = max(envelopes(k, 10) for k in range(9))

    def start():
        stream = S.enrich(S.envelope_stream(spark, f"{tmp}/in", max_bytes_per_trigger=3 * size + 10), ORDER_SCHEMA)
        return S.land_raw(stream, f"{tmp}/raw", f"{tmp}/err", f"{tmp}/ck", available_now=True)

    waits = []

    def wait(seconds):
        waits.append(seconds)
        if len(waits) == 1:
            envelopes(50, 1)                                  # a trickle

    assert S.land_rounds(start, every_s=60, rounds=2, wait=wait) == 2
    batches = spark.read.json(f"{tmp}/raw").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches) == [1, 30, 30, 30] and 0 < waits[0] <= 60
