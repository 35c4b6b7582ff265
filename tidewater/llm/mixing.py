"""Mixing sources to target weights.

Tokens are aggregated per source, every source gets a target by its weight, and
the repetition rate is target / tokens. A document is emitted floor(rate) times
plus one hash-seeded Bernoulli copy whose probability is the rate's fraction.

The Bernoulli draws of one stratum (about ``STRATUM`` documents of one source,
in order of size) share one hash-seeded start and are spaced evenly: document
number i is drawn if start + i * fraction passes an integer. Every document is
still drawn with exactly the fraction's probability, but what a stratum takes
is off by about one document at most, so that small sources with a few very
long documents also come near their target.

Defined results: a null text has size 0; null sources form one source, ordered
last; a source without words has rate 0; rows that repeat with the same
doc_id, source and size share one decision; an empty table gives no rows. Extra
columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
SHARE = 1.5          # of all tokens
CAP = 2.0            # most repetitions of a source
STRATUM = 256        # documents that share a start, about
SEED = "mix-1"

_SIZE, _KEY, _SRC = "__size", "__doc", "__source"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5."""
    hexed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]).cast("binary"))
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: tokens, documents, target and rate. Sources take the
    weights in turn, by code point; a source stops at ``cap`` times its tokens
    and the rest is shared again by weight: with sources in order of tokens per
    weight, the first that the remaining share cannot fill sets the level.

    The windows see one row per source, not per document."""
    per = sized.groupBy(_SRC).agg(F.sum(_SIZE).alias("tokens"), F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy(F.col(_SRC).isNull(), F.col(_SRC))
    ratio = F.col("most") / F.col("weight")
    rising = Window.orderBy(ratio, "place")
    everything = Window.partitionBy()
    per = (per.withColumn("place", F.row_number().over(by_name) - 1)
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                              (F.col("place") % len(weights) + 1).cast("int")))
           .withColumn("most", F.col("tokens") * F.lit(cap))
           .withColumn("total", F.sum("tokens").over(everything) * F.lit(share))
           .withColumn("filled", F.sum("most").over(rising) - F.col("most"))
           .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(rising) + F.col("weight"))
           .withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
           .withColumn("free", F.col("most") > F.col("level") * F.col("weight")))
    first_free = F.min(F.when(F.col("free"), F.struct(ratio.alias("r"), "place", "level"))).over(everything)
    per = per.withColumn("final", first_free["level"])
    target = F.when(F.col("final").isNull(), F.col("most")).otherwise(
        F.least(F.col("most"), F.col("final") * F.col("weight")))
    return (per.withColumn("target", target.cast("double"))
            .withColumn("rate", F.when(F.col("tokens") > 0, F.col("target") / F.col("tokens")).otherwise(F.lit(0.0)))
            .select(_SRC, "tokens", "docs", "target", "rate"))


def decisions(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
              doc: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per different (doc_id, source, size): the number of ``rows`` that
    have them, its source's tokens, target and rate, and ``copies`` (of each row)."""
    sized = docs.select(docs[doc].alias(_KEY), docs[source].alias(_SRC), word_count(docs[text]).alias(_SIZE))
    targets = source_targets(sized, weights, share, cap)
    s = sized.groupBy(_KEY, _SRC, _SIZE).agg(F.count(F.lit(1)).alias("__rows")).alias("s")
    t = targets.alias("t")
    one = s.join(t, F.col(f"s.{_SRC}").eqNullSafe(F.col(f"t.{_SRC}"))).select("s.*", "t.tokens", "t.docs", "t.target", "t.rate")
    draw = uniform(F.lit(seed), F.col(_KEY), F.col(_SIZE))
    strata = F.ceil(F.col("docs") / F.lit(STRATUM))
    one = one.withColumn("draw", draw).withColumn("stratum", F.floor(F.col("draw") * strata))
    start = uniform(F.lit(seed), F.col(_SRC), F.col("stratum"))
    w = Window.partitionBy(_SRC, "stratum").orderBy(_SIZE, "draw", _KEY)
    whole = F.floor("rate")
    fraction = F.col("rate") - whole
    place = F.row_number().over(w)
    extra = F.floor(start + place * fraction) - F.floor(start + (place - 1) * fraction)
    return one.select(_KEY, _SRC, _SIZE, "__rows", F.col("tokens").alias("__tokens"), F.col("target").alias("__target"),
                      F.col("rate").alias("__rate"), (whole + extra).cast("long").alias("__copies"))


def mix_sources(docs: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its number
    in ``copy`` (0-based). Columns of ``docs`` are kept."""
    if "copy" in docs.columns:
        docs = docs.drop("copy")
    chosen = decisions(docs, doc=doc, source=source, text=text, **how).where(F.col("__copies") > 0).alias("c")
    d = docs.withColumn(_SIZE, word_count(docs[text])).alias("d")
    on = (F.col(f"d.{doc}").eqNullSafe(F.col(f"c.{_KEY}")) & F.col(f"d.{source}").eqNullSafe(F.col(f"c.{_SRC}"))
          & (F.col(f"d.{_SIZE}") == F.col(f"c.{_SIZE}")))
    return (d.join(chosen, on)
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
            .select(*[F.col(f"d.`{c}`") for c in docs.columns], "copy"))
