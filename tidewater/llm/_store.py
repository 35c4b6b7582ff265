"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import scratch_path


def settle(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    lineage ends there and the loss of an executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a settled table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


ARROW_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of ``ARROW_ROWS`` rows, as they may
    be long, unless the cluster sets another number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(ARROW_ROWS))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of finished steps now: it does
    so when the driver's garbage collector has seen that a plan is gone."""
    gc.collect()
    spark._jvm.System.gc()
