"""Queue-like processing of arriving files with a retry per file (ST5).

Every new file is a message. What has become of it is kept in an outcome table:
one row per file and event (``new``, ``done``, ``failed``, ``parked``) with the
number of attempts and the last error. A run first notes the files that have
arrived since the last one (a listing stream whose checkpoint remembers what it
has seen), then handles all files that are new or failed, and then writes what
came of them, which drives the next run: failed files are tried again until
``max_attempts``, then parked.

Files are handled together, one Spark job for all. If that fails, the group is
halved until the files at fault stand alone, so one poison file among n costs
about 2 log2(n) more jobs and the others land in the same run. The handler must
be able to see a file twice (the loads of ``sinks.lake`` replace themselves).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.lake import exists
from .jobs import file_arrivals

OUTCOMES = "path STRING, status STRING, attempts INT, error STRING, run STRING, at TIMESTAMP"
ERROR_CHARS = 2000

Handler = Callable[[SparkSession, list[str]], None]


def outcomes(spark: SparkSession, table: str) -> DataFrame:
    """The last known state of every file."""
    if not exists(spark, table):
        return spark.createDataFrame([], OUTCOMES)
    log = spark.read.schema(OUTCOMES).parquet(table)
    rest = [c for c in log.columns if c != "path"]
    # a note that a file is new never outlives what came of it
    last = F.max_by(F.struct(*rest), F.struct(F.col("status") != "new", "attempts", "at"))
    return log.groupBy("path").agg(last.alias("o")).select("path", "o.*")


def _note(spark: SparkSession, table: str, rows: Sequence[tuple], run: str) -> None:
    if rows:
        df = spark.createDataFrame([(*r, run) for r in rows], "path STRING, status STRING, attempts INT, error STRING, run STRING")
        df.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(table)


def _handle(spark: SparkSession, paths: list[str], handler: Handler) -> dict[str, str]:
    """Errors of the files that cannot be handled."""
    if not paths:
        return {}
    try:
        handler(spark, paths)
        return {}
    except Exception as e:  # noqa: BLE001  whatever it was, it is the file's outcome
        if len(paths) == 1:
            return {paths[0]: f"{type(e).__name__}: {e}"[:ERROR_CHARS]}
    half = len(paths) // 2
    return _handle(spark, paths[:half], handler) | _handle(spark, paths[half:], handler)


def process_arrivals(spark: SparkSession, landing: str, table: str, checkpoint: str, handler: Handler, suffix: str = ".csv",
                     case_sensitive: bool = False, max_attempts: int = 3, max_files: int = 1000) -> dict[str, int]:
    """One run: the number of files done, failed (to be tried again) and parked.
    At most ``max_files`` files are handled together; the driver sees their
    names only."""
    run = uuid.uuid4().hex

    def note(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select("path", F.lit("new").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"),
                             F.lit(run).alias("run"), F.current_timestamp().alias("at"))
        fresh.coalesce(1).write.mode("append").parquet(table)

    q = (file_arrivals(spark, landing, suffix, case_sensitive).writeStream.foreachBatch(note)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    due = outcomes(spark, table).where(F.col("status").isin("new", "failed")).orderBy("path")
    todo = [(r["path"], r["attempts"]) for r in due.select("path", "attempts").collect()]
    counts = {"done": 0, "failed": 0, "parked": 0}
    for i in range(0, len(todo), max_files):
        part = dict(todo[i:i + max_files])
        errors = _handle(spark, list(part), handler)
        rows = []
        for path, attempts in part.items():
            status = "done" if path not in errors else ("parked" if attempts + 1 >= max_attempts else "failed")
            counts[status] += 1
            rows.append((path, status, attempts + 1, errors.get(path)))
        _note(spark, table, rows, run)
    return counts
