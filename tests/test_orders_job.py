"""Order stream batch ETL: NDJSON -> clean -> dedup -> warehouse shape."""

from pyspark.sql import functions as F

from fixtures import ORDERS, ORDERS_BY_REGION, ORDERS_BY_SLUG, order_json, write_text
from tidewater.operators import reports as R
from tidewater.plans.jobs import enrich_orders, orders_etl
from tidewater.sinks.warehouse import ORDERS_DDL, direct_load, warehouse_load
from tidewater.sources.files import CORRUPT, read_ndjson

SCHEMA = ("order_id STRING, customer_id STRING, product_id STRING, product_name STRING, category STRING, "
          "quantity INT, unit_price DOUBLE, total_amount DOUBLE, order_status STRING, payment_method STRING, "
          "region STRING, timestamp STRING")


def _raw(spark, tmp, extra=()):
    path = write_text(f"{tmp}/raw/orders.json", [order_json(r) for r in ORDERS] + list(extra))
    return read_ndjson(spark, path, SCHEMA)


def test_goldens(spark, tmp):
    raw = _raw(spark, tmp)
    clean = orders_etl(enrich_orders(raw.drop(CORRUPT)))
    assert clean.count() == 20
    by_region = {r.region: (r.n, r.total) for r in
                 R.totals_by(clean, ["region"], "total_amount", total_name="total", count_name="n").collect()}
    assert by_region == ORDERS_BY_REGION
    by_slug = {r.category: (r.n, r.total) for r in
               R.totals_by(clean, ["category"], "total_amount", total_name="total", count_name="n").collect()}
    assert by_slug == ORDERS_BY_SLUG
    assert clean.agg(F.sum("total_amount")).first()[0] == 11448000


def test_null_drop_before_dedup_keeps_good_copy(spark, tmp):
    dup = order_json(ORDERS[0], total_amount=None)   # same id, missing amount (T2)
    raw = _raw(spark, tmp, [dup, "{not json"])
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = raw.where(F.col(CORRUPT).isNotNull()).select("order_id", CORRUPT).collect()
    assert len(bad) == 1 and bad[0][CORRUPT] == "{not json"       # corrupt line isolated (F7)
    clean = orders_etl(good)
    row = clean.where(F.col("order_id") == "ORD-20240115-000001").collect()
    assert len(row) == 1 and row[0].total_amount == 350000


def test_warehouse_by_name_and_direct_truncation(spark, tmp):
    long_name = "x" * 250
    raw = _raw(spark, tmp, [order_json(ORDERS[1], order_id="ORD-LONG", product_name=long_name)]).drop(CORRUPT)
    wh = warehouse_load(orders_etl(enrich_orders(raw)))
    assert wh.columns == [c for c, _, _ in ORDERS_DDL]                  # DDL order, by name (T8)
    d = direct_load(enrich_orders(raw))
    assert d.where(F.col("order_id") == "ORD-LONG").first().product_name == "x" * 200
    assert d.count() == 21                                              # direct path keeps every record
