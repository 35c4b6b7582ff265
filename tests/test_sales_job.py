"""Sales lake: CSV -> clean -> partitioned Parquet -> SQL reports (goldens)."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import (SALES_BY_CATEGORY, SALES_BY_PAYMENT, SALES_BY_STORE, SALES_HEADER, SALES_ROWS,
                      write_text)
from tidewater.operators import reports as R
from tidewater.plans.jobs import sales_etl
from tidewater.sinks.lake import read_partitioned, write_partitioned
from tidewater.sources.files import read_csv


def _clean(spark, tmp, extra=()):
    path = write_text(f"{tmp}/raw/sales.csv", [SALES_HEADER, *SALES_ROWS, *extra])
    return sales_etl(read_csv(spark, path))


def test_goldens(spark, tmp):
    df = _clean(spark, tmp)
    assert df.count() == 10
    jan = df.where((F.col("year") == "2024") & (F.col("month") == "01"))
    by_store = {r.store_id: (r.total_revenue, r.tx_count)
                for r in R.totals_by(jan, ["store_id"], "amount").collect()}
    assert by_store == SALES_BY_STORE
    by_cat = {r.category: (r.total_revenue, r.units) for r in
              R.totals_by(df, ["category"], "amount", extra=[F.sum("quantity").alias("units")]).collect()}
    assert by_cat == SALES_BY_CATEGORY
    by_pay = {r.payment_method: (r.tx_count, r.total_revenue)
              for r in R.totals_by(df, ["payment_method"], "amount").collect()}
    assert by_pay == SALES_BY_PAYMENT


def test_top_k_tie_break(spark, tmp):
    df = _clean(spark, tmp)
    cat = R.totals_by(df, ["category"], "amount")
    top = R.top_k(cat, 2, [F.col("total_revenue").desc(), F.col("category")]).collect()
    assert [r.category for r in top] == ["food", "staple"]


def test_edge_rows(spark, tmp):
    edge = [
        ",STORE-X,PROD-X,Null Id,food,1,1,1,2024-01-16,cash",                 # null id -> dropped
        "TXN-BAD-DATE,STORE-X,PROD-X,Bad Date,food,1,1,1,2024-13-45,cash",     # bad date -> dropped
        "TXN-BAD-AMT,STORE-X,PROD-X,Bad Amount,food,1,1,abc,2024-01-16,cash",  # bad amount -> dropped
        "TXN-CASE,STORE-X,PROD-X,  Padded Name  , FooD ,1,1,5,2024-01-16,cash",
    ]
    df = _clean(spark, tmp, edge)
    ids = {r.transaction_id for r in df.select("transaction_id").collect()}
    assert "TXN-BAD-DATE" not in ids and "TXN-CASE" in ids and len(ids) == 11
    row = df.where(F.col("transaction_id") == "TXN-CASE").first()
    assert row.category == "food" and row.product_name == "Padded Name"
    assert (row.year, row.month, row.day) == ("2024", "01", "16")


def test_header_normalised(spark, tmp):
    header = SALES_HEADER.replace("sale_date", " Sale-Date ").replace("payment_method", "Payment Method")
    path = write_text(f"{tmp}/raw/h.csv", [header, *SALES_ROWS])
    df = sales_etl(read_csv(spark, path))
    assert "sale_date" in df.columns and "payment_method" in df.columns
    assert df.first().sale_date == dt.date(2024, 1, 15)


def test_partitioned_roundtrip_is_idempotent(spark, tmp):
    df = _clean(spark, tmp)
    out = f"{tmp}/lake"
    write_partitioned(df, out, ["year", "month", "day"], mode="overwrite")
    write_partitioned(df, out, ["year", "month", "day"], mode="overwrite")   # re-run: no duplicates (T5)
    back = read_partitioned(spark, out)
    assert back.count() == 10
    parts = back.select("year", "month", "day").distinct().collect()
    assert [(p.year, p.month, p.day) for p in parts] == [("2024", "01", "15")]   # strings kept (T3)
    plan = back.where(F.col("month") == "01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan


def test_reference_order_keeps_uncastable_values_as_null(spark, tmp):
    # The reference drops nulls *before* casting, so a bad amount survives as null
    bad = "TXN-BAD-AMT,STORE-X,PROD-X,Bad Amount,food,1,1,abc,2024-01-16,cash"
    path = write_text(f"{tmp}/raw/t1.csv", [SALES_HEADER, *SALES_ROWS, bad])
    ours = sales_etl(read_csv(spark, path))
    theirs = sales_etl(read_csv(spark, path), drop_after_cast=False)
    assert ours.count() == 10 and theirs.count() == 11
    assert theirs.where(F.col("transaction_id") == "TXN-BAD-AMT").first().amount is None
