"""Shards of equal bytes by Karmarkar-Karp differencing.

Rows of equal text form a group that is never split. A document's size is its
UTF-8 bytes plus one. Every group is at first a partial partition with all its
bytes in one of the shards; the two partial partitions of largest spread
(largest shard minus smallest) are combined oppositely ordered, the fullest
shard of one with the emptiest of the other, until one is left.

Scale. Differencing is sequential, so it sees units instead of rows: a group of
at least 1 / ``UNITS`` of all bytes is a unit of its own (at most ``UNITS``
are), smaller groups are bundled into ``UNITS`` units by the hash of their text.
So one task combines at most 2 * ``UNITS`` numbers, whatever the input, and
units are small enough (1/1024 of one of 16 shards) for their differences to
cancel. Groups are summed before they are shuffled, and only hashes and sizes
are. A group larger than a shard's share makes that shard as large as itself and
leaves it alone there.

Slots number a shard's rows from 0 without gaps: rows are dealt to blocks of
about ``BLOCK_ROWS`` by a hash of their row, blocks get offsets from their
counts, and rows are numbered inside a block; no task sees a whole shard.

Defined results: a null text has no bytes (size 1, CRC-32 0) and is in one group
with empty texts; repeated rows get slots of their own in one shard; an empty
table gives no rows. Groups are told apart by 64 bits of hash: texts that
collide share a shard, no more. Columns of the input are kept; result columns
replace columns of the same name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._store import settle

SHARDS = 16
UNITS = 16384
BLOCK_ROWS = 100_000

_KEY, _ROW = "__key", "__row"


def differencing(sizes: list[int], shards: int = SHARDS) -> list[int]:
    """The shard of every size."""
    if not sizes:
        return []
    n = len(sizes)
    sums: list = [(s,) + (0,) * (shards - 1) for s in sizes]
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = []                                   # (left, right, order) of node n, n + 1, ...
    last = shards - 1
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        x, y = sums[a], sums[b]
        both = [x[p] + y[last - p] for p in range(shards)]
        order = sorted(range(shards), key=both.__getitem__, reverse=True)
        sums[a] = sums[b] = None
        sums.append(tuple(both[p] for p in order))
        made.append((a, b, order))
        heapq.heappush(heap, (both[order[-1]] - both[order[0]], n + len(made) - 1))
    # a node's place p lies in shard where[node][p]; leaves have their size at place 0
    where: list = [None] * (n + len(made))
    where[-1] = list(range(shards))
    for k in range(len(made) - 1, -1, -1):
        a, b, order = made[k]
        here, left, right = where[n + k], [0] * shards, [0] * shards
        for p, o in enumerate(order):
            left[o] = right[last - o] = here[p]
        where[a], where[b], where[n + k] = left, right, None
    return [w[0] for w in where[:n]]


def _difference(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = pa.Table.from_batches(list(batches), pa.schema([("large", pa.bool_()), ("unit", pa.int64()), ("bytes", pa.int64())]))
        units = units.sort_by([("bytes", "descending"), ("unit", "ascending"), ("large", "ascending")])
        shard = differencing(units["bytes"].to_pylist(), shards)
        yield from units.append_column("shard", pa.array(shard, pa.int32())).to_batches()

    return run


def measured(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with size, text_crc32 and the group's key; without the text if
    that is not to be moved."""
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    fresh = [c for c in docs.columns if c not in ("size", "text_crc32", _KEY, _ROW) and (keep_text or c != text)]
    return docs.select(*[F.col(f"`{c}`") for c in fresh], (F.octet_length(own).cast("long") + 1).alias("size"),
                       F.crc32(own.cast("binary")).alias("text_crc32"), F.xxhash64(own).alias(_KEY))


def place_units(rows: DataFrame, shards: int = SHARDS, units: int = UNITS) -> DataFrame:
    """The shard of every unit (large, unit, bytes, shard), of measured rows."""
    total = rows.agg(F.sum("size").alias("t")).first()["t"] or 0
    groups = rows.groupBy(_KEY).agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") * units >= F.lit(total)
    dealt = groups.select(large.alias("large"), F.when(large, F.col(_KEY)).otherwise(_unit(units)).alias("unit"), "bytes")
    summed = dealt.groupBy("large", "unit").agg(F.sum("bytes").alias("bytes"))
    return summed.repartition(1).mapInArrow(_difference(shards), "large boolean, unit long, bytes long, shard int")


def _unit(units: int) -> Column:
    return F.pmod(F.col(_KEY), F.lit(units)).cast("long")


def assign_shards(rows: DataFrame, shards: int = SHARDS, units: int = UNITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Measured rows with law, shard and slot. The rows are settled once so
    that all of them keep their numbers if an executor is lost."""
    rows = rows.drop("law", "shard", "slot")
    kept = rows.columns
    rows, _ = settle(rows.withColumn(_ROW, F.monotonically_increasing_id()), "shard-rows")
    placed, _ = settle(place_units(rows, shards, units), "shard-units")
    alone = placed.where("large").select(F.col("unit").alias(_KEY), F.col("shard").alias("__alone"))
    bundle = placed.where("NOT large").select(F.col("unit").alias("__unit"), F.col("shard").alias("__bundle"))
    # at most ``units`` rows each, by arithmetic
    rows = (rows.withColumn("__unit", _unit(units)).join(F.broadcast(alone), _KEY, "left").join(F.broadcast(bundle), "__unit", "left")
            .withColumn("shard", F.coalesce("__alone", "__bundle")))
    most = rows.groupBy("shard").count().agg(F.max("count").alias("n")).first()["n"] or 0
    blocks = max(1, -(-most // block_rows))
    rows = rows.withColumn("__block", F.pmod(F.xxhash64(_ROW), F.lit(blocks)))
    counts = rows.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__block").orderBy(_ROW)
    return (rows.withColumn("__place", F.row_number().over(inside) - 1).join(offsets, ["shard", "__block"])
            .select(*[F.col(f"`{c}`") for c in kept], F.lit("bytes").alias("law"), "shard",
                    (F.col("__before") + F.col("__place")).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard and slot."""
    return assign_shards(measured(docs, text), shards).drop(_KEY)


def write_shards(docs: DataFrame, path: str, text: str = "text", shards: int = SHARDS, file_rows: int = BLOCK_ROWS) -> None:
    """Write every shard as a folder shard=N of Parquet files of at most
    ``file_rows`` slots, in order of slot."""
    cut = (F.col("slot") / file_rows).cast("long")
    out = shard_documents(docs, text, shards).withColumn("__file", cut)
    (out.repartition("shard", "__file").sortWithinPartitions("shard", "slot").drop("__file")
     .write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path))
