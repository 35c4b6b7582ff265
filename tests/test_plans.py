"""Plan-shape tests: the scale properties the design relies on."""

import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from tidewater.operators import alarms as AL
from tidewater.operators.dedup import keep_one

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_survivor_combines_map_side(spark):
    # one key holds a third of all rows: the partial aggregate runs before the shuffle
    rows = [(0 if i % 3 == 0 else i, i, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    p = plan(keep_one(df, ["k"], ["seq"], latest=True))
    assert "partial_max" in p and "Window" not in p
    assert p.index("Exchange") < p.index("partial_max")   # partial agg is below (printed after) the exchange


def test_alarm_reads_points_as_aggregates_and_orders_no_series(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    for output in ("transitions", "states"):
        out = AL.alarm(ev, "ts", "value", "sum", 300, 3, 100, ">", keys=["event_type"], output=output)
        p = plan(out)
        assert p.count("FileScan parquet") <= (1 if output == "transitions" else 2)     # states: grid and votes
        assert "Cartesian" not in p and "NestedLoop" not in p and "Window" not in p and "SinglePartition" not in p


def test_partition_filter_reaches_the_scan(spark):
    p = plan(E.queries()["sales_partition_filter"](spark, SF))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", p).group(1)
    assert "year" in found and "month" in found and "1998" in found


def test_fact_to_fact_join_is_not_broadcast(spark):
    p = plan(E.queries()["orders_warehouse_load"](spark, SF))
    assert re.search(r"SortMergeJoin \[l_orderkey#\d+L\], \[o_orderkey#\d+L\]", p)


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["sales_revenue_by_store"](spark, SF)
    p = plan(df)
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    read = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(c.split(":")[0] for c in read.split(",")) == {"l_suppkey", "l_extendedprice", "l_shipdate"}


def test_aggregate_before_join(spark):
    p = plan(E.queries()["sales_top_categories"](spark, SF))
    # the lineitem side of the join is an aggregate keyed by part, not raw lines
    assert re.search(r"HashAggregate\(keys=\[l_partkey#\d+L\]", p)


def test_day_filter_is_a_range(spark):
    p = plan(E.queries()["events_on_day"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in p and "LessThan(ts,2024-01-16T00:00)" in p


def test_bucketed_fact_tables_join_without_shuffle(spark):
    from tidewater.sinks.warehouse import write_distributed
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    od = spark.read.parquet(f"{SF}/orders.parquet")
    write_distributed(li, "tw_li_b", "l_orderkey", "l_orderkey", mode="overwrite", buckets=8)
    write_distributed(od, "tw_o_b", "o_orderkey", "o_orderkey", mode="overwrite", buckets=8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # force the big-table strategy
    try:
        j = spark.table("tw_li_b").join(spark.table("tw_o_b"), F.col("l_orderkey") == F.col("o_orderkey"))
        p = plan(j)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP TABLE tw_li_b")
        spark.sql("DROP TABLE tw_o_b")
