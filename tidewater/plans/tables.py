"""Driver tables mapped to the reference's record shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read_table


def transactions_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """events as card transactions (FIXTURES 'transactions').

    Per-user context (account age, earlier fraud, activity that day) comes
    from a (user, day) aggregate joined back on (user, day). The aggregate is
    combined map-side, and its windows run over a user's *days*, not over a
    user's events, so a user with a third of all events still yields one
    small row per day; AQE splits that user's side of the join.
    """
    ev = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    per_day = ev.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n_day"),
        F.count_if(F.col("event_type") == "error").alias("err_day"))
    by_user = Window.partitionBy("user_id")
    earlier = by_user.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    ctx = per_day.select(
        "user_id", "day", "n_day",
        F.coalesce(F.sum("err_day").over(earlier), F.lit(0)).alias("prior_err"),
        F.min("day").over(by_user).alias("first_day"))
    k = F.get_json_object("props", "$.k")
    j = ev.join(ctx, on=["user_id", "day"])
    return j.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        F.hour("ts").alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
        F.datediff("day", "first_day").alias("user_account_age_days"),
        F.col("prior_err").cast("int").alias("previous_fraud_count"),
        k.cast("double").alias("distance_from_home_km"),
        F.when(k.cast("int") >= 90, F.lit(1)).otherwise(F.lit(0)).alias("is_foreign_transaction"),
        F.col("n_day").cast("int").alias("transaction_frequency_24h"),
    )


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in the 12-field order-event shape (FIXTURES 'orders').

    Join order: orders -> customer -> nation first (order grain, fixed 25-row
    nation dimension broadcast), then the line-grain fact joins that on the
    order key, then part on the part key. Both big joins are shuffle joins on
    their keys; AQE splits skewed keys.
    """
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    order_geo = (o.join(c, o.o_custkey == c.c_custkey)
                  .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
                  .select("o_orderkey", "o_custkey", "o_orderstatus", "n_name"))
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate")
    p = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    # Fact-to-fact join: neither side has a size bound, so it is never
    # broadcast (a small test file would otherwise be shipped to every task).
    j = li.hint("merge").join(order_geo, li.l_orderkey == order_geo.o_orderkey).join(p, F.col("l_partkey") == p.p_partkey)
    return j.select(
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_linestatus").alias("payment_method"),
        F.col("n_name").alias("region"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
    )


ORDER_RECORDS_SQL = """
SELECT 'ORD-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
       'CUST-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
       'PROD-' || CAST(l.l_partkey AS VARCHAR) AS product_id,
       p.p_name AS product_name, p.p_type AS category, CAST(l.l_quantity AS INTEGER) AS quantity,
       p.p_retailprice AS unit_price, l.l_extendedprice AS total_amount, o.o_orderstatus AS order_status,
       l.l_linestatus AS payment_method, n.n_name AS region,
       strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
"""
