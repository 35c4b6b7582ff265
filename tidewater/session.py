"""Session construction and shared-storage helpers.

Every job reads its settings from the active session. The only place we set
configuration ourselves is when it is absent (local runs and tests).
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not for speed).
REQUIRED_CONF = {
    # All time arithmetic (windows, date parts, "today") is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition values such as month='01' must stay strings when read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings for the execution model, used where the cluster sets none.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Settings that only a session's start can set; a cluster sets its own.
STATIC_CONF = {
    "spark.ui.enabled": "false",
    # Remove checkpoint files (model training) once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for the ~100 TB target on a large cluster (``profile="cluster"``).
# AQE starts every shuffle wide and coalesces to ~256 MB partitions, so the
# same plan fits both a 600k-row test and a multi-terabyte shuffle; skewed
# partitions over 512 MB and 5x the median are split.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "65536",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # honour the advisory size instead of maximising task count (busy cluster)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater", extra: dict | None = None,
                  profile: str = "default") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if master:                      # a session of our own: nobody else set the static ones
        for k, v in STATIC_CONF.items():
            if k not in (extra or {}):
                builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}.items():
        if not given.contains(k) and k not in (extra or {}) and not (shuffle_partitions and k == "spark.sql.shuffle.partitions"):
            spark.conf.set(k, v)
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Falls back to a fresh local folder only when the setting is absent *and*
    the master is local (unit tests, ad-hoc runs), and records it on the
    session so later calls agree. On a cluster a machine-local folder would
    not survive the loss of an executor, so a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str, key: str | None = None) -> str:
    """A location under the shared folder: unique per call, or, with
    ``key``, stable for that key so re-runs overwrite instead of piling up."""
    tag = hashlib.sha1(key.encode()).hexdigest()[:12] if key is not None else uuid.uuid4().hex[:12]
    return f"{shared_dir(spark)}/tidewater/{name}-{tag}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
