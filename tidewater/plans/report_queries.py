"""Reports, top-k, unions and filters on the driver tables (A*, L*, U*, F1-F4).

Table mapping (SURVEY 7.3): a lineitem row is a sale (store = l_suppkey,
product = l_partkey, amount = l_extendedprice, payment = l_linestatus,
sale date = l_shipdate); orders carry status, amount and date; events are the
click / visitor / metric stream.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports as R
from ..operators.dedup import keep_one
from ..session import read_table
from .registry import query

MONEY = "round(sum({}), 2)"


# ---------------------------------------------------------------- A1
@query("sales_row_count", "SELECT count(*) AS row_count FROM lineitem", covers="A1")
def sales_row_count(spark, sf):
    return R.row_count(read_table(spark, sf, "lineitem"))


# ---------------------------------------------------------------- A2 (flagship)
@query("sales_revenue_by_store", f"""
SELECT l_suppkey AS store_id, {MONEY.format('l_extendedprice')} AS total_revenue, count(*) AS tx_count
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'
GROUP BY l_suppkey
""", covers="A2 F1")
def sales_revenue_by_store(spark, sf, month_start: str = "1998-01-01", month_end: str = "1998-02-01"):
    li = read_table(spark, sf, "lineitem")
    jan = li.where((F.col("l_shipdate") >= F.lit(month_start).cast("timestamp_ntz"))
                   & (F.col("l_shipdate") < F.lit(month_end).cast("timestamp_ntz")))
    out = R.totals_by(jan, [F.col("l_suppkey").alias("store_id")], "l_extendedprice")
    return out.orderBy(F.col("total_revenue").desc(), F.col("store_id"))


# Amounts with four decimals: a line's price after discount. Rounding rows to
# cents before the sum would change every total.
@query("sales_net_revenue", """
SELECT l_suppkey AS store_id, round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_revenue, count(*) AS tx_count
FROM lineitem GROUP BY l_suppkey
""", covers="A2")
def sales_net_revenue(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return R.totals_by(li, [F.col("l_suppkey").alias("store_id")], F.col("l_extendedprice") * (1 - F.col("l_discount")), scale=4)


# ---------------------------------------------------------------- A3
@query("sales_top_categories", f"""
SELECT p.p_type AS category, {MONEY.format('l.l_extendedprice')} AS total_revenue,
       CAST(SUM(l.l_quantity) AS BIGINT) AS total_units
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
ORDER BY total_revenue DESC, category
LIMIT 10
""", covers="A3")
def sales_top_categories(spark, sf, k: int = 10):
    li = read_table(spark, sf, "lineitem")
    part = read_table(spark, sf, "part").select("p_partkey", "p_type")
    # Aggregate before the join: one row per part instead of one per sale,
    # so the join input no longer grows with the fact table.
    per_part = li.groupBy("l_partkey").agg(
        F.sum("l_extendedprice").alias("rev"),
        F.sum("l_quantity").alias("units"))
    joined = per_part.join(part, per_part.l_partkey == part.p_partkey)
    cat = joined.groupBy(F.col("p_type").alias("category")).agg(
        R.money_sum("rev").alias("total_revenue"),
        F.sum("units").cast("bigint").alias("total_units"))
    return R.top_k(cat, k, [F.col("total_revenue").desc(), F.col("category")])


# ---------------------------------------------------------------- A4
@query("sales_by_payment", f"""
SELECT l_linestatus AS payment_method, count(*) AS tx_count, {MONEY.format('l_extendedprice')} AS total
FROM lineitem GROUP BY l_linestatus ORDER BY tx_count DESC, payment_method
""", covers="A4")
def sales_by_payment(spark, sf):
    li = read_table(spark, sf, "lineitem")
    out = R.totals_by(li, [F.col("l_linestatus").alias("payment_method")], "l_extendedprice",
                      total_name="total", count_name="tx_count")
    return out.orderBy(F.col("tx_count").desc(), "payment_method")


def _orders_by_nation(spark, sf, extra_keys=()):
    """Order revenue and counts per customer nation (and extra customer keys).

    orders are first reduced to one row per customer (partial aggregation on
    the fact table), then joined to customer; nation and region are fixed
    25 / 5 row dimensions."""
    orders = read_table(spark, sf, "orders")
    per_cust = orders.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("rev"), F.count(F.lit(1)).alias("n"))
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", *extra_keys)
    j = per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
    per_nation = j.groupBy("c_nationkey", *extra_keys).agg(F.sum("rev").alias("rev"), F.sum("n").alias("n"))
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    return per_nation.join(geo, per_nation.c_nationkey == geo.n_nationkey)


# ---------------------------------------------------------------- A5
@query("orders_revenue_by_region", f"""
SELECT r.r_name AS region, {MONEY.format('o.o_totalprice')} AS total_revenue, count(*) AS order_count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name ORDER BY total_revenue DESC, region
""", covers="A5")
def orders_revenue_by_region(spark, sf):
    j = _orders_by_nation(spark, sf)
    out = j.groupBy(F.col("r_name").alias("region")).agg(
        R.money_sum("rev").alias("total_revenue"), F.sum("n").alias("order_count"))
    return out.orderBy(F.col("total_revenue").desc(), "region")


# ---------------------------------------------------------------- A6
@query("orders_revenue_by_region_segment", f"""
SELECT r.r_name AS region, c.c_mktsegment AS segment,
       {MONEY.format('o.o_totalprice')} AS total_revenue, count(*) AS order_count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, c.c_mktsegment
""", covers="A6")
def orders_revenue_by_region_segment(spark, sf):
    j = _orders_by_nation(spark, sf, extra_keys=("c_mktsegment",))
    return j.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment")).agg(
        R.money_sum("rev").alias("total_revenue"), F.sum("n").alias("order_count"))


# ---------------------------------------------------------------- A7
@query("orders_total_by_priority_ordinal", f"""
SELECT o_orderpriority AS priority, {MONEY.format('o_totalprice')} AS total
FROM orders GROUP BY 1 ORDER BY 2 DESC
""", covers="A7")
def orders_total_by_priority_ordinal(spark, sf):
    # ordinals in GROUP BY / ORDER BY, as the reference's warehouse query does
    return spark.sql("SELECT o_orderpriority AS priority, "
                     + MONEY.format("o_totalprice") + " AS total FROM {orders} GROUP BY 1 ORDER BY 2 DESC",
                     orders=read_table(spark, sf, "orders"))


# ---------------------------------------------------------------- A9 (+T6)
@query("daily_visitors", """
SELECT CAST(ts AS DATE) AS date, count(*) AS total_visitors FROM events GROUP BY 1
""", covers="A9")
def daily_visitors(spark, sf):
    return R.daily_counts(read_table(spark, sf, "events"), "ts")


# ---------------------------------------------------------------- A10
@query("label_positive_rate", """
SELECT avg(CAST(quality AS DOUBLE)) AS quality_rate, avg(CAST(toxic AS DOUBLE)) AS toxic_rate, count(*) AS n
FROM labels
""", covers="A10")
def label_positive_rate(spark, sf):
    lab = read_table(spark, sf, "labels")
    return lab.agg(F.avg(F.col("quality").cast("double")).alias("quality_rate"),
                   F.avg(F.col("toxic").cast("double")).alias("toxic_rate"),
                   F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- A11
@query("embedding_record_count", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS record_count FROM embeddings
""", covers="A11")
def embedding_record_count(spark, sf):
    return read_table(spark, sf, "embeddings").select("vec_id", F.size("embedding").alias("record_count"))


# ---------------------------------------------------------------- A12
# Driver tables carry no nulls; a zero discount stands in for a missing
# amount so the audit has something to drop (same CASE in the SQL twin).
@query("sales_clean_audit", """
SELECT count(*) AS raw_rows,
       count(*) FILTER (WHERE l_discount <> 0) AS clean_rows,
       count(*) FILTER (WHERE NOT (l_discount <> 0)) AS dropped_rows
FROM lineitem
""", covers="A12")
def sales_clean_audit(spark, sf):
    li = read_table(spark, sf, "lineitem")
    raw = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
                    F.col("l_shipdate").alias("sale_date"),
                    F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("amount"))
    return R.clean_audit(raw, ["transaction_id", "sale_date", "amount"])


# ---------------------------------------------------------------- L1
@query("orders_newest_by_id", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders ORDER BY o_orderkey DESC LIMIT 100
""", covers="L1")
def orders_newest_by_id(spark, sf, n: int = 100):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return R.top_k(o, n, [F.col("o_orderkey").desc()])


# ---------------------------------------------------------------- L2
@query("orders_newest_by_date", """
SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice
FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50
""", covers="L2")
def orders_newest_by_date(spark, sf, n: int = 50):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    return R.top_k(o, n, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


# ---------------------------------------------------------------- L3 (any 10 rows: how many, and are they the table's)
@query("lineitem_first_rows", """
SELECT least(count(*), 10) AS n_rows, least(count(*), 10) AS n_found FROM lineitem
""", covers="L3")
def lineitem_first_rows(spark, sf, n: int = 10):
    from ..session import scratch_path
    li, path = read_table(spark, sf, "lineitem"), scratch_path(spark, "first-rows")
    li.limit(n).write.parquet(path)
    first = spark.read.schema(li.schema).parquet(path)
    # at most n rows go to the table, not the table to them
    known = li.join(F.broadcast(first), li.columns, "left_semi").distinct().withColumn("_known", F.lit(True))
    return first.join(known, li.columns, "left").agg(F.count(F.lit(1)).alias("n_rows"), F.count("_known").alias("n_found"))


# ---------------------------------------------------------------- U1
@query("lake_vs_direct_counts", """
SELECT 'clean' AS source, count(*) AS row_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL
SELECT 'direct' AS source, count(*) AS row_count FROM lineitem
""", covers="U1 D1")
def lake_vs_direct_counts(spark, sf):
    li = read_table(spark, sf, "lineitem")
    clean = keep_one(li.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return R.labelled_counts(clean=clean, direct=li)


# ---------------------------------------------------------------- F2
@query("part_optional_filter", """
SELECT p_partkey, p_name, p_brand, p_retailprice FROM part WHERE p_brand = 'Brand#13'
""", covers="F2")
def part_optional_filter(spark, sf, brand: str | None = "Brand#13"):
    p = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return R.optional_filter(p, p_brand=brand)


# ---------------------------------------------------------------- F3
@query("events_on_day", """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
""", covers="F3")
def events_on_day(spark, sf, day: str = "2024-01-15"):
    ev = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return R.day_filter(ev, "ts", day)


# ---------------------------------------------------------------- F4
@query("order_point_lookup", """
SELECT * FROM orders WHERE o_orderkey = 42
""", covers="F4")
def order_point_lookup(spark, sf, key: int = 42):
    return read_table(spark, sf, "orders").where(F.col("o_orderkey") == F.lit(key))
