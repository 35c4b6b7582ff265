"""Source divergence audit by chunk factorization.

Which terms a source uses more than its language does, and how far the sources
of a language are from each other. Texts are counted as whitespace chunks;
every globally distinct chunk is tokenized once, and its terms go back to the
documents that hold it.

1. Chunks. A scan cuts documents into batches of about ``BATCH_BYTES`` of text.
   A batch numbers its different chunks and keeps (document, chunk, times) as
   packed arrays. Both are settled in the shared folder.
2. Terms. The chunks of all batches are hashed and sorted, so that equal chunks
   stand together and are tokenized once; a chunk of every document is one row
   per batch. Terms whose chunks are in fewer than ``MIN_DOCS`` documents, all
   together, cannot be kept, and go.
3. Back. The other terms join their batch, which counts documents and occurrences
   per (language, source, term), several chunks of a term being one document's,
   and packs the counts by a hash of the term.
4. Totals. One task per hash bucket adds up its packs as they come, and terms in
   at least ``MIN_DOCS`` documents of a language are kept.

A term's share in a group of N occurrences of V kept terms is p = 1 + floor(10^9
(count + 5) / (N + 5 V)), in exact arithmetic. Distances between sources are
sums over all kept terms; they are formed per bucket of terms in a matrix of
sources by terms of at most ``CELLS`` numbers, and added up.

Defined results: null texts, languages and sources are empty strings; sources
without a kept term occur all the same; a language without kept terms has
distances 0; repeated rows count as documents of their own; an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._store import discard, settle, small_batches
from tidewater.llm._words import LOWER, SPACED, chunks, column_bytes, per_text, word_hashes, words

MIN_DOCS = 30
BEST = 50
BATCH_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
PACK_BATCHES, MAX_BUCKETS = 16, 4096     # batches per bucket of terms, about
MERGE_ROWS = 1_000_000
BROADCAST_BYTES = 16 << 20    # of terms that may be kept, to find their chunks
CELLS = 100_000

#: bytes of a term after A-Z were lower-cased: a-z, every non-ASCII byte
LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("times", pa.int64())])


def _gather(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ranges one behind the other, and n+1 offsets."""
    bounds = np.append(0, np.cumsum(ends - starts))
    return raw[np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], ends - starts)], bounds


def _strings(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    kind = pa.large_string() if bounds[-1] > 2**31 - 1 else pa.string()
    offsets = bounds.astype(np.int64 if kind == pa.large_string() else np.int32)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def _pack(x: np.ndarray) -> bytes:
    """32-bit numbers, their bytes in planes, compressed."""
    planes = x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return struct.pack("<q", len(x)) + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def _unpack(data: bytes) -> np.ndarray:
    n = struct.unpack_from("<q", data)[0]
    if not n:
        return np.zeros(0, np.int32)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").reshape(-1)


# ------------------------------------------------------------------ 1 chunks
class _Batch:
    def __init__(self):
        self.langs, self.sources, self.sizes = [], [], []
        self.hashes, self.times = [], []                  # per slice, of the different chunks of each document
        self.names, self.strings = [], []                 # per slice, its different chunks and their bytes
        self.bytes = 0

    def add(self, part: pa.RecordBatch) -> None:
        raw, bounds = column_bytes(part.column(2))
        starts, ends, first = words(raw, bounds, SPACED)
        hashes, doc = word_hashes(raw, starts, ends), per_text(first)
        order = np.lexsort((hashes, doc))
        h, d = hashes[order], doc[order]
        new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))) if len(h) else np.zeros(0, np.int64)
        self.langs.append(part.column(0))
        self.sources.append(part.column(1))
        self.sizes.append(np.bincount(d[new], minlength=len(first) - 1))
        self.hashes.append(h[new])
        self.times.append(np.diff(np.append(new, len(h))))
        names, at = np.unique(hashes, return_index=True)
        self.names.append(names)
        self.strings.append(_strings(*_gather(raw, starts[at], ends[at])).cast(pa.large_string()))
        self.bytes += len(raw)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        names, first = np.unique(np.concatenate(self.names), return_index=True)
        at = np.searchsorted(names, np.concatenate(self.hashes)).astype(np.int32)
        self.hashes.clear()
        text = pa.concat_arrays(self.strings).take(pa.array(first))
        self.strings.clear()
        # frequent chunks get small numbers, others go by the alphabet: both pack well
        docs = np.bincount(at, minlength=len(names))
        order = np.lexsort((_places(text), -docs))
        rank = np.empty(len(names), np.int32)
        rank[order] = np.arange(len(names), dtype=np.int32)
        sizes, chunk, times = np.concatenate(self.sizes), rank[at], np.concatenate(self.times).astype(np.int32)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        by = np.lexsort((chunk, owner))
        chunk, times = chunk[by], times[by]
        step = np.diff(chunk, prepend=np.int32(0))
        begin = np.flatnonzero(np.diff(owner, prepend=np.int32(-1)))
        step[begin] = chunk[begin]
        groups, mine = _numbered(pa.concat_arrays(self.langs), pa.concat_arrays(self.sources))
        text, docs = text.take(pa.array(order)), docs[order]
        for i in range(0, len(text), 65536):
            part = text.slice(i, 65536)
            m = len(part)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, number)), pa.array(np.arange(i, i + m), pa.int32()), part.cast(pa.string()),
                                              pa.array(docs[i:i + m], pa.int32()), pa.nulls(m, _GROUPS), pa.nulls(m, pa.list_(pa.binary()))], schema=_CHUNK_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.array([groups], _GROUPS),
                                          pa.array([[_pack(mine), _pack(sizes), _pack(step), _pack(times)]], pa.list_(pa.binary()))], schema=_CHUNK_ARROW)


def _places(text: pa.Array) -> np.ndarray:
    """The place of every string in the order of all."""
    out = np.empty(len(text), np.int32)
    out[pc.sort_indices(text).to_numpy()] = np.arange(len(text), dtype=np.int32)
    return out


def _numbered(langs: pa.Array, sources: pa.Array) -> tuple[list[dict], np.ndarray]:
    """The different (lang, source) and the number of each row's."""
    known: dict = {}
    mine = np.array([known.setdefault(x, len(known)) for x in zip(langs.to_pylist(), sources.to_pylist())], np.int32)
    return [{"lang": a, "source": b} for a, b in known], mine


_GROUPS = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string())]))
_CHUNK_ARROW = pa.schema([("batch", pa.int64()), ("number", pa.int32()), ("chunk", pa.string()), ("docs", pa.int32()), ("groups", _GROUPS), ("packed", pa.list_(pa.binary()))])
_CHUNKS = "batch long, number int, chunk string, docs int, groups array<struct<lang:string,source:string>>, packed array<binary>"


def _count_chunks(batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        now = _Batch()
        for batch in batches:
            _, bounds = column_bytes(batch.column(2))
            for i, j in chunks(bounds, min(SLICE_BYTES, batch_bytes)):
                now.add(batch.slice(i, j - i))
                if now.bytes >= batch_bytes:
                    yield from now.rows(number)
                    now, number = _Batch(), number + 1
        if now.langs:
            yield from now.rows(number)

    return run


# ------------------------------------------------------------------- 2 terms
def terms_of(chunk: pa.Array) -> pa.Array:
    """The terms of every chunk, each followed by a space."""
    raw, bounds = column_bytes(chunk)
    raw = np.append(LOWER[raw], np.uint8(0x20))
    starts, ends, first = words(raw[:-1], bounds, LETTERS)
    # a word and the space that stands at the end of ``raw``
    two = np.empty(2 * len(starts), np.int64)
    stop = np.empty_like(two)
    two[::2], stop[::2], two[1::2], stop[1::2] = starts, ends, len(raw) - 1, len(raw)
    spelled, at = _gather(raw, two, stop)
    return _strings(spelled, at[2 * first])


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of chunk: each run of equal chunks is tokenized once."""
    for batch in batches:
        if batch.num_rows:
            runs = pc.run_end_encode(batch.column(2))
            ends = runs.run_ends.to_numpy()
            terms = terms_of(runs.values).take(pa.array(np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms.cast(pa.string()), batch.column(3)], names=["batch", "number", "terms", "docs"])
            yield out.filter(pc.greater(pc.binary_length(terms), 0))


# -------------------------------------------------------------------- 3 back
def _batch_counts(buckets: int):
    def run(own: pa.Table, back: pa.Table) -> pa.Table:
        none = pa.table({"bucket": pa.array([], pa.int32()), "counts": pa.array([], pa.binary())})
        if not own.num_rows or not back.num_rows:
            return none
        groups = own.column("groups")[0].as_py()
        mine, sizes, step, times = (_unpack(x) for x in own.column("packed")[0].as_py())
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)           # place of the document's first chunk
        run_sum = np.cumsum(step)
        chunk = (run_sum - np.where(begin > 0, run_sum[begin - 1], 0)).astype(np.int32)
        del begin, run_sum, step
        back = back.sort_by("number")
        coded = back.column("term").combine_chunks().dictionary_encode()
        code, spelled = coded.indices.to_numpy(), coded.dictionary
        first = np.searchsorted(back.column("number").to_numpy(), np.arange(int(chunk.max()) + 2))
        # one row per (document, chunk, term), then per (document, term), then per (group, term)
        n = np.diff(first)[chunk]
        which = np.repeat(np.arange(len(chunk), dtype=np.int32), n)
        term = code[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[chunk[which]]]
        key, weight = doc[which].astype(np.int64) * len(spelled) + term, times[which]
        del which, term, n, chunk, doc
        key, weight, _ = _summed(key, weight)
        key, weight, docs = _summed(key % len(spelled) * len(groups) + mine[key // len(spelled)], weight)
        term, group = key // len(groups), key % len(groups)
        raw, bounds = column_bytes(spelled)
        bucket = (word_hashes(raw, bounds[:-1], bounds[1:]) % np.uint64(buckets)).astype(np.int64)[term]
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        langs, sources = (pa.array([g[c] for g in groups], pa.string()) for c in ("lang", "source"))
        coded = lambda at, names: pa.DictionaryArray.from_arrays(pa.array(at, pa.int32()), names)
        packs, where = [], []
        for b in np.flatnonzero(np.diff(cut)):
            o = order[cut[b]:cut[b + 1]]
            own_terms, t = np.unique(term[o], return_inverse=True)
            columns = [coded(group[o], langs), coded(group[o], sources), coded(t, spelled.take(pa.array(own_terms))), pa.array(docs[o], pa.int32()), pa.array(weight[o], pa.int64())]
            packs.append(_to_bytes(pa.table(dict(zip(_COUNTS.names, columns)))))
            where.append(b)
        return pa.table({"bucket": pa.array(where, pa.int32()), "counts": pa.array(packs, pa.binary())})

    return run


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, the sum of their weights and their number."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[new], np.add.reduceat(weight[order], new, dtype=np.int64), np.diff(np.append(new, len(key)))


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


# ------------------------------------------------------------------ 4 totals
def _merged(tables: list[pa.Table]) -> pa.Table:
    added = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("docs", "sum"), ("times", "sum")])
    return added.select(["lang", "source", "term", "docs_sum", "times_sum"]).rename_columns(_COUNTS.names)


def _total(min_docs: int):
    def kept(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        counts = _merged(tables)
        docs = counts.group_by(["lang", "term"]).aggregate([("docs", "sum")])
        enough = docs.filter(pc.greater_equal(docs["docs_sum"], min_docs)).select(["lang", "term"])
        yield from counts.join(enough, ["lang", "term"], join_type="inner").select(["lang", "source", "term", "times"]).combine_chunks().to_batches(max_chunksize=65536)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, now = [], 0, None
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if held and bucket != now:
                    yield from kept(held)
                    held, rows = [], 0
                now = bucket
                held.append(pa.ipc.open_stream(data.as_buffer()).read_all().cast(_COUNTS))
                rows += held[-1].num_rows
                if rows > MERGE_ROWS and len(held) > 1:
                    held = [_merged(held)]
                    rows = held[0].num_rows // 2          # merge again when as much has come
        if held:
            yield from kept(held)

    return run


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
                batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, source) of all groups, and (lang, source, term, times) of the
    terms in at least ``min_docs`` documents of the language."""
    slim = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    spark = docs.sparkSession
    small_batches(spark)
    counted, path = settle(slim.mapInArrow(_count_chunks(batch_bytes), _CHUNKS), "audit-chunks", "zstd")
    batches = counted.where("number IS NULL").select("batch", "groups", "packed")
    buckets = int(min(MAX_BUCKETS, max(PACK_BATCHES, batches.count() // PACK_BATCHES)))
    alike = counted.where("number IS NOT NULL").select("batch", "number", "chunk", "docs").repartition("chunk").sortWithinPartitions("chunk")
    spelled, spelled_path = settle(alike.mapInArrow(_tokenize, "batch long, number int, terms string, docs int"), "audit-spelled", "zstd")
    each = spelled.select("batch", "number", F.explode(F.split(F.rtrim("terms"), " ")).alias("term"), "docs")
    often, often_path = settle(each.groupBy("term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("term"), "audit-often")
    few = (often.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0) <= BROADCAST_BYTES
    back = each.drop("docs").join(F.broadcast(often) if few else often, "term", "left_semi")
    packs = batches.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(_batch_counts(buckets), "bucket int, counts binary")
    totals = packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_total(min_docs), "lang string, source string, term string, times long")
    groups, _ = settle(batches.select(F.explode("groups").alias("g")).select("g.lang", "g.source").distinct(), "audit-groups")
    totals, _ = settle(totals, "audit-terms")
    for old in (path, spelled_path, often_path):
        discard(spark, old)
    return groups, totals


# ----------------------------------------------------------------- the audit
def _share(times: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (times + 5) / (total + 5 terms)), exactly."""
    top = (times + 5).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return (F.lit(1) + F.call_function("div", top, (total + 5 * terms).cast("decimal(20,0)"))).cast("long")


def _distances(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over the bucket's terms of the differences of every two sources."""
    sources = groups.column("source").to_pylist()
    if len(sources) < 2:
        return pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()), "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    share = np.zeros((len(sources), 0), np.int64)
    if cells.num_rows:
        place = {s: k for k, s in enumerate(sources)}
        coded = cells.column("term").combine_chunks().dictionary_encode()
        share = np.repeat(groups.column("none").to_numpy()[:, None], len(coded.dictionary), axis=1)
        share[[place[s] for s in cells.column("source").to_pylist()], coded.indices.to_numpy()] = cells.column("share").to_numpy()
    far = np.stack([np.abs(share - share[k]).sum(axis=1) for k in range(len(sources))])
    a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
    names = groups.column("source").combine_chunks()
    lang = groups.column("lang").combine_chunks().take(pa.array(np.zeros(len(a), np.int64)))
    return pa.table({"lang": lang, "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(far[a, b], pa.int64())})


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, best: int = BEST,
          batch_bytes: int = BATCH_BYTES, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value and rank: in part ``pair`` the distance
    to every other source of the language, in part ``term`` the ``best`` terms
    that the source uses more than its language."""
    groups, totals = count_terms(docs, lang, source, text, min_docs, batch_bytes)
    of_lang = totals.groupBy("lang", "term").agg(F.sum("times").alias("lang_times"))
    kept = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_times").alias("lang_total"))
    sized = totals.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    groups, _ = settle(groups.join(kept, "lang", "left").join(sized, ["lang", "source"], "left").na.fill(0, ["terms", "lang_total", "total"]), "audit-sizes")
    shares = (totals.join(groups, ["lang", "source"]).withColumn("share", _share(F.col("times"), F.col("total"), F.col("terms"))))

    over = (shares.join(of_lang, ["lang", "term"]).withColumn("value", F.col("share") - _share(F.col("lang_times"), F.col("lang_total"), F.col("terms")))
            .where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)

    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("terms").alias("v")).agg(F.max(F.col("s") * F.col("v")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-most // cells))
    dealt = shares.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "source", "term", "share")
    every = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), "source",
                          F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(0).alias("none"))
    part = (dealt.groupBy("lang", "bucket").cogroup(every.groupBy("lang", "bucket"))
            .applyInArrow(_distances, "lang string, source string, item string, value long"))
    pairs = part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(over)
