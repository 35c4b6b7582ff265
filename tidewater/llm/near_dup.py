"""Near-duplicates by BagMinHash.

A document is the multiset of its 5-word shingles (a text of one to four words
is one shingle), and two documents are near-duplicates if the weighted Jaccard
similarity of their multisets, sum of minima over sum of maxima, is at least
``THRESHOLD``.

Signature. The weight axis is cut at 1, 2, 4, 8, ...: each shingle has an
independent Poisson process in time on [0, 1), [1, 2), [2, 4), [4, 8), ... with
the interval's length as its rate. Its points are split by halving down to unit
cells, and a point counts for a shingle of weight w if its cell is below w. A
counted point goes to a random one of ``BANDS * ROWS`` components, which keeps
its first point. Everything is hashed from the shingle, so two documents agree
in a component with exactly the probability of their weighted Jaccard
similarity. Generation stops at a time by which about ``ROWS * BANDS *
(ln(ROWS * BANDS) + 5)`` points came up, and goes on for the few documents with
an empty component: the effort per document hardly depends on its length.

Candidates. Documents with equal multisets are one node. Nodes that agree in a
whole band share a bucket. A bucket is never expanded into pairs: in each round
it names centres (first one, then four times as many as before), which are
compared with the bucket's nodes in other components; a centre leaves the bucket
afterwards, having met everyone. Verified links join components, and a bucket
with a single component is done. The first centre is the bucket's most
connected node, usually the original of its copies, so that rounds are few; no
link between components is lost, as rounds end only when every bucket is done.
From the second round on nodes have a sketch of 1,024 bits, one of each
component of a longer signature, which is made for these nodes only; pairs must
agree in as many bits as all but 1e-6 of similar ones do (876 at 0.8), which few
of less than 0.7 do.

Verification is exact: shared and all (shingle, occurrence) pairs are counted.

Recall of one link at similarity s is 1 - (1 - s^4)^24: 0.999997 at 0.8.

Defined results: null, empty and blank texts have no shingles and are alone in
their class; a class is named by its least id, null ids rank last; rows with
equal ids and texts are one class; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm._linking import WORDS, link_buckets, only
from tidewater.llm._store import discard, settle, small_batches
from tidewater.llm._words import SPACED, chunks, column_bytes, given_back, mix, pair, per_text, windows, word_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
SLICE_BYTES = 512 << 10      # text that is worked on at once
SLICE_ELEMENTS = 1 << 16     # elements of sets that are sketched at once

_EMPTY = np.uint64(0x1F83D9ABFB41BD6B)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one behind the other, and n+1 offsets."""
    raw, bounds = column_bytes(column)
    starts, ends, first = words(raw, bounds, SPACED)
    h, doc, n = word_hashes(raw, starts, ends), per_text(first), np.diff(first)
    at = np.arange(max(0, len(h) - SHINGLE + 1))
    at = at[doc[at] == doc[at + SHINGLE - 1]]
    value, owner = windows(h, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64), doc[at]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        acc = np.full(len(short), _EMPTY)
        for k in range(SHINGLE - 1):
            more = n[short] > k
            acc[more] = pair(acc[more], h[first[:-1][short[more]] + k])
        value, owner = np.concatenate([value, acc]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))


def _counted(value: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, shingle and weight of each document's different shingles, in
    order of owner and shingle."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])])) if len(o) else np.zeros(0, np.int64)
    return o[new], v[new], np.diff(np.append(new, len(o)))


def occurrences(value: np.ndarray) -> np.ndarray:
    """One document's shingles as a set: the k-th occurrence of a shingle is
    an element of its own."""
    v = np.sort(value)
    new = np.concatenate([[True], v[1:] != v[:-1]])
    nth = np.arange(len(v)) - np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    return pair(v, nth.astype(np.uint64))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def bag_signatures(value: np.ndarray, offsets: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (n documents x size); 0 everywhere for an empty bag."""
    n = len(offsets) - 1
    owner, shingle, weight = _counted(value, offsets)
    total = np.bincount(owner, weights=weight, minlength=n)
    # one process per shingle and interval [0,1), [1,2), [2,4), ... below its weight
    who, seed, level, most = [owner], [mix(shingle)], [np.zeros(len(owner), np.int64)], [weight]
    j = 1
    while (more := weight > 1 << (j - 1)).any():
        who.append(owner[more])
        seed.append(mix(shingle[more] + np.uint64(j * 0x9E3779B97F4A7C15 % 2 ** 64)))
        level.append(np.full(int(more.sum()), j))
        most.append(weight[more])
        j += 1
    who, seed, level, most = map(np.concatenate, (who, seed, level, most))
    rate = np.ldexp(1.0, np.maximum(level - 1, 0))
    out = np.zeros((n, size), np.uint64)
    todo, spare = total > 0, 5.0
    while todo.any():
        limit = np.where(todo, size * (np.log(size) + spare) / np.maximum(total, 1), 0.0)
        first = np.full(n * size, np.inf)
        best = np.zeros(n * size, np.uint64)
        live = np.flatnonzero(todo[who])
        time, k = np.zeros(len(live)), 0
        while len(live):
            point = mix(seed[live] ^ np.uint64(k * 0xD1B54A32D192ED03 % 2 ** 64))
            time = time - np.log(_unit(point)) / rate[live]
            near = time <= limit[who[live]]
            live, time, point = live[near], time[near], point[near]
            drawn = mix(point + np.uint64(0xA24BAED4963EE407))
            half = np.maximum(level[live] - 1, 0).astype(np.uint64)
            cell = (drawn >> np.uint64(32)) & ((np.uint64(1) << half) - np.uint64(1))     # halvings of the interval, one bit each
            cell = np.where(level[live] > 0, cell + (np.uint64(1) << half), np.uint64(0))
            count = cell < most[live].astype(np.uint64)
            slot = who[live][count] * size + ((drawn[count] & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)
            earlier = time[count] < first[slot]
            slot, when, which = slot[earlier], time[count][earlier], point[count][earlier]
            np.minimum.at(first, slot, when)
            kept = when == first[slot]
            best[slot[kept]] = which[kept]
            k += 1
        full = np.isfinite(first.reshape(n, size)).all(axis=1)
        done = todo & full
        out[done] = best.reshape(n, size)[done]
        todo, spare = todo & ~full, spare * 2
    return out


def band_hashes(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(rows):
        h = pair(h, parts[:, :, r])
    return h


def sketches(sets: DataFrame) -> DataFrame:
    """(node, sketch) of sets (node, elements): a bit of each of 64 * ``WORDS``
    components."""
    return sets.mapInArrow(_sketch, "node binary, sketch array<long>")


@given_back
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 64 * WORDS
    place = mix(np.arange(1, size + 1, dtype=np.uint64))
    for whole in batches:
        bounds = np.append(0, np.cumsum(pc.list_value_length(whole.column(1)).to_numpy(zero_copy_only=False)))
        for i, j in chunks(bounds, SLICE_ELEMENTS):
            for i in range(i, j, 256):
                batch = whole.slice(i, min(256, j - i))
                value = pc.list_flatten(batch.column(1)).to_numpy().view(np.uint64)
                offsets = bounds[i:i + len(batch) + 1] - bounds[i]
                bits = (mix(bag_signatures(value, offsets, size) ^ place) >> np.uint64(63)).astype(np.uint8)
                packed = np.packbits(bits, axis=1).view(np.int64).reshape(-1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(packed) + 1, WORDS, dtype=np.int32)), pa.array(packed))], names=["node", "sketch"])


def agreeing(threshold: float, miss_sigmas: float = 4.8) -> int:
    """Bits that all but 1e-6 of the pairs at ``threshold`` share: two bits are
    equal with probability (1 + similarity) / 2."""
    n, p = 64 * WORDS, (1 + threshold) / 2
    return int(n * p - miss_sigmas * (n * p * (1 - p)) ** 0.5)


def _nodes(value: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each document's multiset."""
    owner, shingle, weight = _counted(value, offsets)
    cut = np.searchsorted(owner, np.arange(len(offsets)))
    return [xxhash.xxh3_128_digest(shingle[i:j].tobytes() + weight[i:j].tobytes()) if j > i else None for i, j in zip(cut[:-1], cut[1:])]


def _slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, bounds = column_bytes(batch.column(text_at))
        for i, j in chunks(bounds, SLICE_BYTES):
            yield batch.slice(i, j - i)


@given_back
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "node", "weight", "bands"]
    for batch in _slices(batches, 1):
        value, offsets = shingles(batch.column(1))
        bands = band_hashes(bag_signatures(value, offsets)).view(np.int64)
        alone = np.diff(offsets) == 0
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1)))
        lists = pa.compute.if_else(pa.array(alone), pa.scalar(None, lists.type), lists)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_nodes(value, offsets), pa.binary()), pa.array(np.diff(offsets), pa.int64()), lists],
                                         names=names)


@given_back
def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, 1):
        value, offsets = shingles(batch.column(1))
        sets = [occurrences(value[i:j]).view(np.int64) for i, j in zip(offsets[:-1], offsets[1:])]
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))], names=["node", "elements"])


def _with_node(text_at: int):
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, text_at):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_nodes(*shingles(batch.column(text_at))), pa.binary())], names=[*batch.schema.names, "__node"])

    return run


def _key(node: str, doc: str) -> Column:
    """One value for a node and a document id, null ids included."""
    return F.concat(F.col(node), F.coalesce(F.col(doc).cast("string"), F.lit("null")).cast("binary")).alias("__key")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, node (the multiset's name, null without
    words) and class_id, the least id of its class."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[doc].dataType.simpleString()
    slim = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    signed, signed_path = settle(slim.mapInArrow(_sign, f"doc_id {kind}, node binary, weight long, bands array<long>"), "near-signed")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "weight", "bands")).alias("r")).select(
        "node", F.col("r.doc_id").alias("doc_id"), F.col("r.weight").alias("weight"), F.col("r.bands").alias("bands"))
    banded = nodes.select("node", "doc_id", "weight", F.explode("bands").alias("band"))
    crowd = banded.groupBy("band").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    # one row per node with its buckets, some 24 at most
    met, met_path = settle(banded.join(crowd, "band").groupBy("node").agg(
        F.first("doc_id").alias("doc_id"), F.first("weight").alias("weight"), F.sum("crowd").alias("score"), F.collect_list("band").alias("bands")), "near-met")
    names, _ = settle(signed.select("doc_id", "node"), "near-names")
    discard(spark, signed_path)
    buckets = met.select(F.explode("bands").alias("band"), "node", "weight", "score")
    # the multisets of nodes that have a bucket, from one document of each
    chosen, chosen_path = settle(met.select(_key("node", "doc_id")), "near-chosen")
    texts = slim.mapInArrow(_with_node(1), T.StructType([*slim.schema.fields, T.StructField("__node", T.BinaryType())]))
    own = only(texts.withColumn("__key", _key("__node", "doc_id")), chosen, "__key").select(F.col("__node").alias("node"), "text").dropDuplicates(["node"])
    sets, set_path = settle(own.mapInArrow(_elements, "node binary, elements array<long>"), "near-sets")
    comp = link_buckets(buckets, sets, threshold, "near", sketches, agreeing(threshold))
    for old in (met_path, set_path, chosen_path):
        discard(spark, old)
    whole = names.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = whole.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return whole.join(least, "component", "left").select("doc_id", "node", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the document of least id of each class, once; documents
    without words stay. The texts themselves are only shuffled if more rows go
    than a broadcast may name."""
    spark = docs.sparkSession
    found = near_duplicates(docs, doc, text, threshold).where("node IS NOT NULL")
    rows, rows_path = settle(found.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n"), F.first("class_id").alias("class_id")), "near-rows")
    first = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "node")
    # a class without an id has no name of its own; its node stands for it
    stay = rows.groupBy(F.col("class_id").alias("c"), F.when(F.col("class_id").isNull(), F.col("node")).alias("m")).agg(F.min(first).alias("r"))
    stay, _ = settle(stay.select(_key("r.node", "r.doc_id")), "near-stay")
    keyed = rows.select(_key("node", "doc_id"), "n")
    gone, _ = settle(only(keyed, stay, "__key", "left_anti").select("__key"), "near-gone")
    again, _ = settle(only(keyed.where("n > 1"), stay, "__key").select("__key"), "near-again")
    discard(spark, rows_path)
    at = docs.columns.index(text)
    named = docs.mapInArrow(_with_node(at), T.StructType([*docs.schema.fields, T.StructField("__node", T.BinaryType())]))
    named = named.withColumn("__key", F.coalesce(_key("__node", f"`{doc}`"), F.lit(b"")))
    kept = only(named, gone, "__key", "left_anti")
    if again.isEmpty():
        return kept.drop("__node", "__key")
    once = only(kept, again, "__key").dropDuplicates(["__key"])
    return only(kept, again, "__key", "left_anti").union(once).drop("__node", "__key")
