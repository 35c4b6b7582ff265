"""Connected components with DataFrame operations.

Alternating large-star and small-star steps: every step is a map-side combined
minimum per node, one join and a distinct, so a node with a third of all edges
costs one row per task in the minimum, and Spark splits its side of the join.
Each round is settled in the cluster's shared folder. Only two numbers per
round come back to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._store import discard, settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """For edges (a, b): node and component (its least node). Self-loops, edges
    with a null end and repeated edges do no harm; nodes without an edge to
    another node are not listed."""
    spark = edges.sparkSession
    kind = edges.schema["a"].dataType
    now = edges.select(F.col("a").cast(kind), F.col("b").cast(kind)).where("a <> b")
    now, path = settle(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen["n"] == 0 or seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b"))).distinct()
        mark = seen
        after, new_path = settle(_small_star(_large_star(now)), name)
        discard(spark, path)
        now, path = after, new_path
