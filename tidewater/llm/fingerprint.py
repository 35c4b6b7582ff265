"""Document fingerprints by SpotSigs, in DataFrame functions only.

Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. At
every common word (``ANCHORS``) a chain starts: the anchor and the next
``CHAIN`` content words, common words in between left out. The hashes of a
text's different chains are its signature set; sorted, in hex and joined by
commas, they are its fingerprint. A text without any such chain (in a
language without anchors here) has the chains of ``CHAIN`` words from each word,
and the chain of all its words if it has fewer. A text under ``SHORT`` words,
which few chains describe, has its single content words besides.

With the j-th common word at place p (both from 0), p - j content words stand
before it, so its chain is a slice of the content words: one filter for the
common words' places and one for the content words, no loop over words.

Likeness is the Jaccard similarity of two sets. ``near_duplicates`` partitions
sets by length (lengths whose ratio can reach the threshold meet in one of two
neighbouring partitions) and inside by the chains of a prefix that two similar
sets must share; candidates are pruned by length before their sets meet.

Defined results: null and empty texts have the empty set, whose likeness is 1 to
the empty set and 0 to any other; equal texts have equal fingerprints; repeated
rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._linking import link_buckets
from tidewater.llm._store import settle

CHAIN = 3
HASH_BITS = 40
SHORT = 48
BLOCK_ROWS = 1000            # documents of one block of the id order
SEGMENTS = 1000              # most boundaries that are asked of the id's distribution
BROADCAST_BLOCKS = 100_000

# Common words of English, German, French and Spanish prose (fixed values).
ANCHORS = tuple("""
a an and are as at be but by for from has he in is it of on or that the this to was were which with
auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu
au aux avec ce dans du elle est et il la le les ne nous pas pour qu que qui se sur un une
con como del el en la las lo los más no para por se su una y
""".split())

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns that are worked out once per row, however often and in whatever
    lambda they are used: the one-row generator keeps Catalyst from copying
    their expressions into their uses."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made)


def _hash(chain: Column) -> Column:
    return F.xxhash64(chain).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _chains(words: Column) -> Column:
    """All chains of CHAIN neighbouring words, or the one of fewer words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - CHAIN + 1, F.lit(1)))
    return F.when(F.size(words) > 0, F.transform(starts, lambda i: _hash(F.slice(words, i, CHAIN)))).otherwise(F.array().cast("array<bigint>"))


def add_signatures(df: DataFrame, **texts: Column) -> DataFrame:
    """``df`` with the signature set (sorted array of hashes) of each text."""
    kept = df.columns
    lowered = {f"__w_{n}": F.regexp_extract_all(F.translate(F.coalesce(t, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0)) for n, t in texts.items()}
    df = _once(df, **lowered)
    parts = {}
    for n in texts:
        w = F.col(f"__w_{n}")
        parts[f"__p_{n}"] = F.filter(F.transform(w, lambda x, i: F.when(x.isin(*ANCHORS), i)), lambda i: i.isNotNull())
        parts[f"__c_{n}"] = F.filter(w, lambda x: ~x.isin(*ANCHORS))
    df = _once(df, **parts)
    sets = {}
    for n in texts:
        w, places, content = F.col(f"__w_{n}"), F.col(f"__p_{n}"), F.col(f"__c_{n}")
        spots = F.filter(F.transform(places, lambda p, j: F.when(
            p - j + CHAIN <= F.size(content), _hash(F.concat(F.slice(w, p + 1, 1), F.slice(content, p - j + 1, CHAIN))))), lambda h: h.isNotNull())
        sets[f"__s_{n}"] = spots
    df = _once(df, **sets)
    done = {}
    for n in texts:
        chains = F.when(F.size(f"__s_{n}") > 0, F.col(f"__s_{n}")).otherwise(_chains(F.col(f"__w_{n}")))
        single = F.when(F.size(f"__w_{n}") < SHORT, F.transform(f"__c_{n}", lambda x: _hash(F.array(x)))).otherwise(F.array().cast("array<bigint>"))
        done[n] = F.array_sort(F.array_distinct(F.concat(chains, single)))
    return _once(df, **done).select(*[F.col(f"`{c}`") for c in kept], *texts)


def fingerprint(signatures: Column) -> Column:
    return F.array_join(F.transform(signatures, lambda h: F.lower(F.hex(h))), ",")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 where their lengths alone
    keep it under ``threshold`` (the sets are not compared then)."""
    shared = F.size(F.array_intersect(a, b))
    longer, shorter = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))
    return (F.when(longer == 0, F.lit(1.0)).when(shorter < longer * F.lit(threshold), F.lit(0.0)).when(shorter == 0, F.lit(0.0))
            .otherwise(shared / (longer + shorter - shared)))


def with_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and next_text: that of the next document in
    descending order of id, after the last the first; equal ids follow each
    other by text. Documents without id have no place, and no next text.

    The order is cut into blocks of about ``BLOCK_ROWS`` documents at quantiles
    of the id, so that the texts are shuffled once and no task sees them all;
    the last document of a block gets the first one of the block below."""
    slim = docs.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed, loose = slim.where("doc_id IS NOT NULL"), slim.where("doc_id IS NULL").select("doc_id", "text", F.lit("").alias("next_text"))
    size = placed.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    n_blocks = max(1, -(-size["n"] // BLOCK_ROWS))
    segments = min(SEGMENTS, n_blocks)
    inner = []
    if segments > 1:
        shares = [i / segments for i in range(1, segments)]
        found = placed.agg(F.percentile_approx("doc_id", shares, 100 * segments)).first()[0]
        inner = sorted(set(found) - {size["lo"]})
    edges = [size["lo"] or 0, *inner, (size["hi"] or 0) + 1]
    each = -(-n_blocks // segments)
    bounds = F.array(*[F.lit(b).cast("long") for b in edges])
    segment = F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    low, high = F.get(bounds, segment - 1), F.get(bounds, segment)
    block = segment * F.lit(each) + F.floor((F.col("doc_id") - low).cast("double") * F.lit(each) / (high - low))
    dealt = placed.withColumn("block", block.cast("long"))
    w = Window.partitionBy("block").orderBy(F.col("doc_id").desc(), F.col("text").desc())
    follows = dealt.withColumn("follows", F.lead("text").over(w))
    top = dealt.groupBy("block").agg(F.max("doc_id").alias("top"))
    top = F.broadcast(top) if n_blocks <= BROADCAST_BLOCKS else top
    heads = (dealt.join(top.withColumnRenamed("block", "b"), F.col("doc_id") == F.col("top")).groupBy("block").agg(F.max("text").alias("head")))
    order = Window.orderBy("block")
    chain = heads.select("block").withColumn("below", F.lag("block").over(order))
    wrap = F.max("block").over(Window.partitionBy())
    chain = chain.withColumn("below", F.coalesce("below", wrap))
    tails = chain.join(heads.select(F.col("block").alias("below"), "head"), "below").select("block", F.col("head").alias("tail"))
    whole = follows.join(tails, "block").select("doc_id", "text", F.coalesce("follows", "tail").alias("next_text"))
    return whole.union(loose)


def edited(text: Column, following: Column) -> Column:
    """The text whose last floor(n/2) code points are replaced by the first
    as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """doc_id and class_id (least id of the class) of every document whose
    signature set is linked by a likeness of ``threshold`` or more. Texts without
    signatures are alone."""
    slim = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    signed = add_signatures(slim, sig=F.col("text")).select("doc_id", "sig")
    signed, _ = settle(signed.withColumn("node", F.when(F.size("sig") > 0, F.sha2(fingerprint(F.col("sig")), 256))), "spot-signed")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.first("sig").alias("elements"))
    sets, _ = settle(nodes, "spot-sets")
    length = F.size("elements")
    part = F.floor(F.log(length.cast("double")) / F.lit(math.log(1 / threshold))).cast("long")
    prefix = F.slice("elements", 1, length - F.ceil(length * F.lit(threshold)).cast("int") + 1)
    met = sets.select("node", length.alias("weight"), F.explode(F.array(part, part + 1)).alias("part"), prefix.alias("prefix"))
    met = met.select("node", "weight", F.explode(F.transform("prefix", lambda h: F.xxhash64(h, "part"))).alias("band"))
    crowd = met.groupBy("band").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    met, _ = settle(met.join(crowd, "band"), "spot-met")
    score = met.groupBy("node").agg(F.sum("crowd").alias("score"))
    buckets, _ = settle(met.join(score, "node").select("band", "node", F.col("weight").cast("long").alias("weight"), "score"), "spot-buckets")
    comp = link_buckets(buckets, sets, threshold, "spot")
    whole = signed.select("doc_id", "node").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = whole.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return whole.join(names, "component", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
