"""Classes of similar sets from shared buckets, without pairs of a bucket.

Every bucket names centres in rounds: one, then four, sixteen, ... A centre is
compared with the bucket's nodes in other components and leaves the bucket,
having met everyone. Verified links join components; a bucket whose nodes are
all in one component is done, and rounds end when every bucket is. So no link
between components is lost, while a bucket of copies takes one round of one
comparison per copy. From the third round on a pair is counted out where it
meets, and what leaves the join is links: a crowd of texts that are hardly
similar makes no rows with the square of its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._components import components
from tidewater.llm._store import discard, release, settle


#: longs of a sketch
WORDS = 16

#: so many nodes (16 bytes each) are broadcast to find their sets, no more
BROADCAST_NODES = 200_000


def only(df: DataFrame, nodes: DataFrame, on: str = "node", how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose node is in ``nodes`` (or, with left_anti, is
    not): these are broadcast if they are few, so that ``df`` is not shuffled
    for them, and joined by a shuffle if they are not."""
    few = nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    return df.join(F.broadcast(nodes) if few else nodes, on, how)


#: sets of so many elements (8 bytes each) together are broadcast to the pairs
BROADCAST_ELEMENTS = 1_000_000


def similarities(pairs: DataFrame, sets: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Settled pairs (a, b) with the Jaccard similarity of their sets (node,
    elements). If the sets are small together they go to the pairs; else both
    are shuffled, and a hot node's side is split by Spark's skew join."""
    own, path = settle(only(sets, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()), f"{name}-own")
    few = (own.agg(F.sum(F.size("elements"))).first()[0] or 0) <= BROADCAST_ELEMENTS
    eb = own.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    ea = own.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    two = pairs.join(F.broadcast(eb) if few else eb, "b").join(F.broadcast(ea) if few else ea, "a")
    shared = F.size(F.array_intersect("ea", "eb"))
    return two.select("a", "b", (shared / (F.size("ea") + F.size("eb") - shared)).alias("j")), path


#: sets of so many elements (4 bytes each) go to the buckets, longer ones do not
CARRIED_ELEMENTS = 8192

#: centres of a bucket from which on the sets go there
CARRIED_FROM = 16


def carried(sets: DataFrame) -> DataFrame:
    """(node, own): 31 bits of each element, where these are as many as the
    elements, so that two sets share no fewer of them than elements."""
    own = F.array_distinct(F.transform("elements", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    return sets.where(F.size("elements") <= CARRIED_ELEMENTS).select("node", own.alias("own"), F.size("elements").alias("n")).where(F.size("own") == F.col("n")).drop("n")


#: so many nodes whose sets have so many elements (4 bytes each) are broadcast
#: to each other, without buckets, instead of further rounds
PAIRWISE_NODES, PAIRWISE_ELEMENTS = 16_384, 4_000_000


def _alike(threshold: float) -> Column:
    """What the carried sets ``own`` and ``oa`` say; true where one is not carried."""
    both = F.size(F.array_intersect("own", "oa"))
    return F.when(F.col("own").isNull() | F.col("oa").isNull(), F.lit(True)).otherwise(both / (F.size("own") + F.size("oa") - both) >= threshold)


def _close(threshold: float, told: bool, agree: int) -> Column:
    """What components, sizes and sketches say of a node and a centre."""
    near = (F.col("component") != F.col("ca")) & (F.least("weight", "wa") >= F.lit(threshold) * F.greatest("weight", "wa"))
    if told:
        unlike = [F.bit_count(F.get("sketch", k).bitwiseXOR(F.get("sa", k))) for k in range(WORDS)]
        near = near & (sum(unlike[1:], unlike[0]) <= 64 * WORDS - agree)
    return near


def _all_pairs(left: DataFrame, own: DataFrame, threshold: float, told: bool, agree: int) -> DataFrame:
    """Pairs (a, b) of all nodes that may be similar and are not linked yet."""
    spark = left.sparkSession
    facts = ["weight", "component", *["sketch"] * told]
    nodes = left.select("node", *facts).dropDuplicates(["node"]).join(own, "node", "left")
    others = nodes.select(F.col("node").alias("a"), F.col("weight").alias("wa"), F.col("component").alias("ca"), F.col("own").alias("oa"),
                          *[F.col("sketch").alias("sa")] * told)
    near = (F.col("node") < F.col("a")) & _close(threshold, told, agree) & _alike(threshold)
    return nodes.repartition(8 * spark.sparkContext.defaultParallelism, "node").join(F.broadcast(others), near).select("a", F.col("node").alias("b"))


def link_buckets(buckets: DataFrame, sets: DataFrame, threshold: float, name: str,
                 sketch: Callable[[DataFrame], DataFrame] | None = None, agree: int = 0) -> DataFrame:
    """(node, component) of all nodes with a link, from buckets (band, node,
    weight, score); weight is the set's size, by which pairs are pruned before
    their sets meet; the node of the highest score is the first centre.

    After the first round what is left is mostly texts that are all somewhat
    like one centre and hardly like each other. Such pairs are told apart where
    they meet in a bucket, before their sets are read, by their distances to the
    bucket's first centre, which differ by no more than 1 - ``threshold`` (1 -
    Jaccard is a metric), and by sketches: ``sketch`` makes (node, sketch), an
    array of longs, of the sets of those nodes only, and similar ones share
    ``agree`` bits or more. With ``CARRIED_FROM`` centres and more the sets
    themselves are compared there (``carried``); what passes is verified like
    all pairs. When few nodes are left, the last round compares all of them."""
    spark = buckets.sparkSession
    left = buckets.withColumn("component", F.col("node"))
    links, linked, paths, slots, comp, own_sets = None, [], [], 1, None, None
    while True:
        told, away = (["sketch"] if "sketch" in left.columns else []), (["far"] if "far" in left.columns else [])
        left = left.withColumn("slot", F.pmod(F.xxhash64("node", "band", F.lit(slots)), F.lit(slots)))
        centre = left.groupBy("band", "slot").agg(F.max(F.struct("score", "node", "weight", "component", *told, *away)).alias("c")).select(
            "band", F.col("c.node").alias("a"), F.col("c.weight").alias("wa"), F.col("c.component").alias("ca"), *[F.col("c.sketch").alias("sa")] * len(told), *[F.col("c.far").alias("fa")] * len(away))
        near = _close(threshold, bool(told), agree)
        if away:
            near = near & (F.abs(F.coalesce(F.col("far") - F.col("fa"), F.lit(0.0))) <= 1 - threshold + 1e-9)
        here, there = left, centre
        if slots >= CARRIED_FROM:
            if own_sets is None:
                own_sets, own_sets_path = settle(carried(only(sets, left.select("node").distinct())), f"{name}-carried")
            here = left.join(own_sets, "node", "left")
            there = centre.join(own_sets.select(F.col("node").alias("a"), F.col("own").alias("oa")), "a", "left")
            near = near & _alike(threshold)
        pairs, pair_path = settle(here.join(there, "band").where(near).select("a", F.col("node").alias("b")).distinct(), f"{name}-pairs")
        scored, own_path = similarities(pairs, sets, name)
        scored, scored_path = settle(scored, f"{name}-scored")
        discard(spark, own_path)
        found, link_path = settle(scored.where(F.col("j") >= threshold).select("a", "b"), f"{name}-links")
        links = found if links is None else links.union(found)
        linked.append(link_path)
        if comp is None or not found.isEmpty():
            comp = components(links, f"{name}-components")
        rest = (left.join(centre.select("band", F.col("a").alias("node")), ["band", "node"], "left_anti").drop("component", "slot")
                .join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
        mixed = rest.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band")
        rest = rest.join(mixed, "band", "left_semi")
        if slots == 1:
            # what is known of the distance to the bucket's first centre
            known = scored.select("a", F.col("b").alias("node"), (1 - F.col("j")).alias("far"))
            rest = rest.join(centre.select("band", "a"), "band").join(known, ["a", "node"], "left").drop("a")
        left, path = settle(rest, f"{name}-left")
        for old in (*paths, pair_path, scored_path):
            discard(spark, old)
        paths, slots = [path], (4 if slots < CARRIED_FROM else 16) * slots
        if left.isEmpty():
            for old in (*paths, *linked, *([] if own_sets is None else [own_sets_path])):
                discard(spark, old)
            return comp
        # shuffle files of the round
        del centre, near, here, there, pairs, scored, rest, mixed
        release(spark)
        if sketch is not None and not told:
            own, own_path = settle(sketch(only(sets, left.select("node").distinct())), f"{name}-sketches")
            left, told_path = settle(left.join(own, "node"), f"{name}-left")
            for old in (path, own_path):
                discard(spark, old)
            paths = [told_path]
        size = left.select("node", "weight").distinct().agg(F.count(F.lit(1)).alias("nodes"), F.sum("weight").alias("elements")).first()
        if size["nodes"] <= (PAIRWISE_NODES if sketch is not None else PAIRWISE_NODES // 4) and size["elements"] <= PAIRWISE_ELEMENTS:
            own, own_path = settle(carried(only(sets, left.select("node").distinct())), f"{name}-carried")
            pairs, pair_path = settle(_all_pairs(left, own, threshold, sketch is not None, agree), f"{name}-pairs")
            scored, scored_path = similarities(pairs, sets, name)
            found, link_path = settle(scored.where(F.col("j") >= threshold).select("a", "b"), f"{name}-links")
            if not found.isEmpty():
                comp = components(links.union(found), f"{name}-components")
            for old in (*paths, *linked, own_path, pair_path, scored_path, link_path, *([] if own_sets is None else [own_sets_path])):
                discard(spark, old)
            return comp
