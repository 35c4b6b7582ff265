"""Keyed store sink (K3): last write wins per key.

A Parquet table partitioned by a hash bucket of the key. An upsert reads only
the buckets its changes hash to, merges them with the changes
(``operators.changes.upsert``) and overwrites those buckets through a staged
copy (``lake.overwrite_staged``, which also mends a run that broke off). At most
``buckets`` small integers come to the driver. The number of buckets and the
keys are noted when the table is made; an upsert that disagrees is refused. A
batch of many keys touches all buckets and rewrites the table: a bucket should
be some 100 MB. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.changes import upsert
from . import lake

BUCKET = "_bucket"
BUCKETS = 64
#: rows of a bucket, on average, up to which one task writes it to one file;
#: larger ones are written from where they were merged, without another shuffle
BUCKET_ROWS = 200_000
_ABOUT = "_keyed"            # hidden from Spark's listing of the table


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(int(buckets))).cast("int")


def _about(spark: SparkSession, path: str):
    where = f"{path}/{_ABOUT}"
    return spark.read.schema("buckets INT, keys ARRAY<STRING>").json(where).first() if lake.exists(spark, f"{where}/_SUCCESS") else None


def _read(spark: SparkSession, path: str, schema: StructType | None, buckets: Sequence[int] | None = None) -> DataFrame:
    where = [path] if buckets is None else [f"{path}/{BUCKET}={b}" for b in buckets]
    r = spark.read.option("basePath", path)
    return (r if schema is None else r.schema(schema)).parquet(*where)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table; None before the first upsert."""
    if _about(spark, path) is None:
        return None
    lake.finish_pending(spark, path)
    return _read(spark, path, None).drop(BUCKET)


def upsert_into(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str],
                seq: str | Sequence[str] | None = None, buckets: int | None = None) -> int:
    """Apply ``changes`` to the keyed table at ``path``; returns the number of
    buckets rewritten. ``buckets`` (64 unless given) is fixed when the table
    is made; columns are those of the first batch."""
    keys, about = list(keys), _about(spark, path)
    if about is not None and (buckets not in (None, about["buckets"]) or keys != about["keys"]):
        raise ValueError(f"{path} has {about['buckets']} buckets by {about['keys']}, not {buckets} by {keys}")
    n = about["buckets"] if about else (buckets or BUCKETS)
    lake.finish_pending(spark, path)
    ch = changes.withColumn(BUCKET, bucket_of(keys, n)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r[0]: r[1] for r in ch.groupBy(BUCKET).agg(F.count(F.lit(1))).collect()}
        touched = sorted(counts)
        if not touched:
            return 0
        if about is None:
            spark.createDataFrame([(n, keys)], "buckets INT, keys ARRAY<STRING>").coalesce(1).write.json(f"{path}/{_ABOUT}")
        there = [b for b in touched if lake.exists(spark, f"{path}/{BUCKET}={b}")]
        base = _read(spark, path, ch.schema, there) if there else ch.limit(0)
        merged = upsert(base.select(*ch.columns), ch, [BUCKET, *keys], seq)
        if sum(counts.values()) + (base.count() if there else 0) <= BUCKET_ROWS * len(touched):
            merged = merged.repartition(len(touched), BUCKET)
        lake.overwrite_staged(merged, path, [BUCKET])
        return len(touched)
    finally:
        ch.unpersist()


def upsert_batch_writer(path: str, keys: Sequence[str], seq: str | Sequence[str] | None = None,
                        buckets: int | None = None):
    """``foreachBatch`` function for a streaming upsert."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_into(batch.sparkSession, path, batch, keys, seq, buckets)
    return write
