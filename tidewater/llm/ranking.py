"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

Every benchmark item is a query: its different terms. A term's weight is
floor(1000 ln((2 N + 2) / (2 df + 1))); a document's score sums weight times
floor(10^9 tf / (1000 tf + 20 m)) over the query's terms, in integers, with
m = 50 + floor(50 n N / L) for a document of n of all L terms in N documents.

Index. One scan turns documents into postings: the query terms they hold and
how often, and n. These are settled in the shared folder (a tenth of the text,
about) and give N, L and every df.

Search. A task reads postings in shards of ``SHARD_POSTINGS`` and inverts each.
A query's terms are taken rarest first. While a new document could still get
among the first k, postings open accumulators; once the sum of the best
contributions of all remaining terms is below the k-th partial score, no
accumulator is opened any more, and the remaining terms only update those that
exist, exactly. The k-th final score of the task's earlier shards serves as a
bound as well. A shard gives its k best per query, ties by least id; two levels
of windows merge them (group limits act before each shuffle, so a query's rows
are never in one task unless a task gave them).

Queries come to the executors in blocks of about ``BLOCK_BYTES`` of query text,
chosen by a hash of the item id; a larger table is searched block by block.

Words: A-Z lower-cased, runs of digits, letters and non-ASCII characters, known
by 64-bit hashes. Defined results: null texts and texts without terms are in no
result and in no count; rows of equal item id are one query of all their terms,
a null id is one as well; queries without terms have no rows; equal scores rank
by ascending id, null last; repeated documents are ranked one by one; empty
tables give no rows. Only ids and texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._store import settle
from tidewater.llm._words import ALNUM, LOWER, chunks, column_bytes, per_text, word_hashes, words

BEST = 50
SLICE_BYTES = 2 << 20
SHARD_POSTINGS = 2_000_000
BLOCK_BYTES = 16 << 20
SALTS = 32

_LONG = np.iinfo(np.int64)


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts and the first of each text."""
    raw, bounds = column_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = words(raw, bounds, ALNUM)
    return word_hashes(raw, starts, ends), first


class Queries:
    """A block of items: ``ids``, the sorted term hashes ``alphabet`` and, from
    ``first[i]`` to ``first[i + 1]``, the places of item i's terms in it."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        coded = ids.dictionary_encode(null_encoding="encode")
        hashes, first = _terms(texts)
        self.ids = coded.dictionary
        self.alphabet = np.unique(hashes)
        owner = coded.indices.to_numpy(zero_copy_only=False)[per_text(first)]
        pairs = np.unique(owner.astype(np.int64) * max(1, len(self.alphabet)) + np.searchsorted(self.alphabet, hashes))
        self.terms = pairs % max(1, len(self.alphabet))
        self.first = np.searchsorted(pairs // max(1, len(self.alphabet)), np.arange(len(self.ids) + 1))

    def weigh(self, df: np.ndarray, documents: int) -> None:
        """Weights of the terms; the terms of an item go rarest first."""
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        for i, j in zip(self.first[:-1], self.first[1:]):
            t = self.terms[i:j]
            self.terms[i:j] = t[np.lexsort((t, df[t]))]


def _index(alphabet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = alphabet.value
        for batch in batches:
            _, bounds = column_bytes(batch.column(1))
            for i, j in chunks(bounds, SLICE_BYTES):
                part = batch.slice(i, j - i)
                hashes, first = _terms(part.column(1))
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                pairs, tf = np.unique(per_text(first)[hit] * len(known) + at[hit], return_counts=True)
                n = np.diff(first)
                cut = pa.array(np.searchsorted(pairs // len(known), np.arange(len(n) + 1)).astype(np.int32))
                terms = pa.ListArray.from_arrays(cut, pa.array((pairs % len(known)).astype(np.int32)))
                times = pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int32)))
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), terms, times], names=["id", "n", "terms", "times"])
                yield out.filter(pa.array(n > 0))

    return run


def length_norm(n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """50 + floor(50 n N / L), without overflow on the way."""
    if len(n) and 50 * int(n.max()) * documents > _LONG.max:
        return np.array([50 + 50 * int(x) * documents // all_terms for x in n], np.int64)
    return 50 + 50 * n * documents // all_terms


class Shard:
    """Inverted postings of some documents; ``part`` holds n, terms and times
    of each (lists), ``place`` their order by id."""

    def __init__(self, n: np.ndarray, cut: np.ndarray, terms: np.ndarray, times: np.ndarray, documents: int, all_terms: int):
        self.size = len(n)
        doc = np.repeat(np.arange(self.size), np.diff(cut))
        tf = times.astype(np.int64)
        gain = 1_000_000_000 * tf // (1000 * tf + 20 * length_norm(n, documents, all_terms)[doc])
        order = np.argsort(terms, kind="stable")
        self.doc, self.gain = doc[order], gain[order]
        self.known, start = np.unique(terms[order], return_index=True)
        self.cut = np.append(start, len(order))
        self.most = np.maximum.reduceat(self.gain, start) if len(start) else np.zeros(0, np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, bound: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best above 0 and at least ``bound``,
        for terms that go rarest first."""
        at = np.searchsorted(self.known, terms)
        here = (at < len(self.known)) & (weights > 0)
        here[here] = self.known[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        left = np.append(np.cumsum((weights * self.most[at])[::-1])[::-1], 0)      # what remaining terms can add
        score = np.zeros(self.size, np.int64)
        opened = np.zeros(self.size, bool)
        opening, found = True, 0
        for i, (t, w) in enumerate(zip(at, weights)):
            docs, gains = self.doc[self.cut[t]:self.cut[t + 1]], self.gain[self.cut[t]:self.cut[t + 1]]
            if opening:
                kth = bound
                if found >= k:
                    partial = score[opened]
                    kth = max(kth, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
                opening = left[i] >= kth
            if opening:
                opened[docs] = True
                found = int(opened.sum())
                score[docs] += w * gains
            else:
                mine = opened[docs]
                score[docs[mine]] += w * gains[mine]
        hits = np.flatnonzero(opened & (score > 0) & (score >= bound))
        if len(hits) > k:
            kth = np.partition(score[hits], len(hits) - k)[len(hits) - k]
            hits = hits[score[hits] >= kth]
            hits = hits[np.lexsort((place[hits], -score[hits]))[:k]]
        return hits, score[hits]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, postings = [], 0
    for batch in batches:
        held.append(batch)
        postings += len(pc.list_flatten(batch.column(2)))
        if postings >= SHARD_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, postings = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _search(queries, documents: int, all_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        tops = [np.zeros(0, np.int64)] * len(q.ids)
        for table in _shards(batches):
            ids, n, terms, times = (table.column(c).combine_chunks() if table.num_rows else table.column(c) for c in range(4))
            cut = np.append(0, np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False)))
            shard = Shard(n.to_numpy(), cut, pc.list_flatten(terms).to_numpy(), pc.list_flatten(times).to_numpy(), documents, all_terms)
            place = np.empty(len(ids), np.int64)
            place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            items, docs, scores = [], [], []
            for i in range(len(q.ids)):
                own = q.terms[q.first[i]:q.first[i + 1]]
                bound = int(tops[i][0]) if len(tops[i]) == k else 0
                hits, score = shard.best(own, q.weight[own], k, bound, place)
                if len(hits):
                    tops[i] = np.sort(np.concatenate([tops[i], score]))[-k:]
                    items.append(np.full(len(hits), i))
                    docs.append(hits)
                    scores.append(score)
            if items:
                yield pa.RecordBatch.from_arrays([q.ids.take(pa.array(np.concatenate(items))), ids.take(pa.array(np.concatenate(docs))),
                                                  pa.array(np.concatenate(scores))], names=["item_id", "doc_id", "score"])

    return run


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy("item_id", *by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = BEST, doc: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id and score."""
    spark = docs.sparkSession
    doc_type, item_type = docs.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    own = items.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).where(F.length("text") > 0)
    blocks = -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    own = own.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    slim = docs.select(F.col(doc).alias("id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], f"item_id {item_type}, doc_id {doc_type}, score long")
    for b in range(blocks):
        table = own.where(F.col("block") == b).toArrow()
        queries = Queries(table.column("item_id"), table.column("text"))
        if not len(queries.alphabet):
            continue
        alphabet = spark.sparkContext.broadcast(queries.alphabet)
        index, _ = settle(slim.mapInArrow(_index(alphabet), f"id {doc_type}, n long, terms array<int>, times array<int>"), "rank-index")
        size = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(queries.alphabet), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():      # at most the block's terms
            df[r["t"]] = r["count"]
        if not size["docs"]:
            continue
        queries.weigh(df, size["docs"])
        search = _search(spark.sparkContext.broadcast(queries), size["docs"], size["terms"], k)
        found = found.union(index.mapInArrow(search, f"item_id {item_type}, doc_id {doc_type}, score long"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    return _first(_first(salted, k, "salt").drop("rank"), k).select("item_id", "rank", "doc_id", "score")
