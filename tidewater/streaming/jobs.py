"""Structured Streaming jobs (S5, S6, ST1-ST6, K2, K4, D3, W1 on streams).

Every query checkpoints to the cluster-shared folder, so a restarted driver
resumes from the last committed offsets/files, and sinks are idempotent per
batch, so replays do not duplicate output.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import clean as C
from ..sinks.fanout import fan_out, folder_writer
from ..sources.envelope import decode_envelope, record_fields
from ..sources.files import CORRUPT, _with_corrupt, suffix_glob

ENVELOPE_SCHEMA = "sequence_number STRING, partition_key STRING, data STRING"


# ---------------------------------------------------------------- S5 / ST5
def csv_arrivals(spark: SparkSession, folder: str, schema: StructType | str, suffix: str = ".csv",
                 case_sensitive: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """New CSV objects under ``folder`` (the prefix); the suffix test happens
    at listing time, and the checkpoint remembers files already seen."""
    r = (spark.readStream.schema(_with_corrupt(schema)).option("header", True)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("pathGlobFilter", suffix_glob(suffix, case_sensitive)))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(folder).withColumn("source_file", F.col("_metadata.file_name"))


def file_arrivals(spark: SparkSession, folder: str, suffix: str = ".csv", case_sensitive: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """(path, length) of new objects under ``folder``. Only the listing is
    streamed, the content column is pruned: what a batch does with its files
    (binding columns by each file's header, say) is a batch read."""
    r = (spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY")
         .option("pathGlobFilter", suffix_glob(suffix, case_sensitive)))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).select("path", "length")


# ---------------------------------------------------------------- S6
def envelope_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 10, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Envelope records (sequence number, key, base64 data) landed as NDJSON
    files; in production the same shape comes from a Kafka source with
    ``startingOffsets=earliest`` and ``maxOffsetsPerTrigger``. A batch is so many
    files, or files of so many bytes."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA)
    r = r.option("maxBytesPerTrigger", max_bytes_per_trigger) if max_bytes_per_trigger else r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(folder)


def kafka_envelopes(spark: SparkSession, servers: str, topic: str, max_offsets: int = 10) -> DataFrame:
    """Kafka variant of S6 (needs the Kafka connector on the classpath)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest")
           .option("maxOffsetsPerTrigger", max_offsets).load())
    return raw.select(F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")).alias("sequence_number"),
                      F.col("key").cast("string").alias("partition_key"),
                      F.base64(F.col("value")).alias("data"))


# ---------------------------------------------------------------- ST1
def enrich(envelopes: DataFrame, schema: str, clock=None) -> DataFrame:
    """decode -> category slug -> processed_at stamp; ``failed`` rows keep
    their sequence number for the dead letter (ST4 / F7)."""
    dec = decode_envelope(envelopes, schema)
    rec = dec.select("sequence_number", "failed", "data", *record_fields(dec))
    # A missing or null category becomes '' and is flagged, not failed
    return rec.withColumns({"category_missing": F.col("category").isNull() & ~F.col("failed"),
                            "category": C.slug("category"), "processed_at": C.iso_stamp(clock)})


# ---------------------------------------------------------------- K2 / ST3 / ST4
def land_raw(df: DataFrame, path: str, errors_path: str, checkpoint: str, trigger_s: int = 60,
             available_now: bool = False, arrival: _dt.datetime | None = None) -> StreamingQuery:
    """Raw landing: good records as JSON in arrival-time year/month/day/hour
    folders, failed ones under a separate error prefix. One foreachBatch so
    both outputs commit with the same batch id; the batch is decoded once and
    a replay replaces both of its folders (``arrival``: a fixed clock)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.lit(arrival or _dt.datetime.now(_dt.timezone.utc)).cast("timestamp")     # one stamp for both outputs
        stamped = C.with_date_partitions(batch.withColumn("_arrival", now), "_arrival", hour=True)
        good = stamped.where(~F.col("failed")).drop("failed", "data", "_arrival")
        bad = stamped.where(F.col("failed")).select("sequence_number", "data", "year", "month", "day", "hour")
        parts = ("year", "month", "day", "hour")
        fan_out({"raw": lambda b, i: folder_writer(path, partition_cols=parts)(good, i),
                 "errors": lambda b, i: folder_writer(errors_path, partition_cols=parts)(bad, i)})(batch, batch_id)
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_s} seconds")
    return w.start()


# What flushes a landing buffer.
FLUSH_BYTES, FLUSH_S = 5 << 20, 60


def land_rounds(start: Callable[[], StreamingQuery], every_s: float = FLUSH_S, rounds: int | None = None,
                wait: Callable[[float], None] = time.sleep) -> int:
    """Landing by size or time: ``start`` begins an ``available_now`` landing
    whose source is bounded by ``max_bytes_per_trigger=FLUSH_BYTES``. Each round
    lands all that has arrived, in batches near that size one behind the other,
    and the next begins ``every_s`` after its start, or at once if it took
    longer. So a flood is flushed by size, and a trickle after that time. (A
    processing-time trigger would land one batch per interval, and fall behind.)
    Returns the number of rounds; without ``rounds`` it goes on for ever."""
    done = 0
    while rounds is None or done < rounds:
        began = time.monotonic()
        start().awaitTermination()
        done += 1
        if rounds is None or done < rounds:
            wait(max(0.0, every_s - (time.monotonic() - began)))
    return done


# ---------------------------------------------------------------- K4 / ST2
def start_fanout(df: DataFrame, writers: dict, checkpoint: str, available_now: bool = True,
                 trigger_s: int = 60) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fan_out(writers)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_s} seconds")
    return w.start()


# ---------------------------------------------------------------- D3
def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """Drop re-sent records (at-least-once delivery) by key within the
    watermark delay; state older than the watermark is evicted."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


# ---------------------------------------------------------------- ST6
def run_available_now(df: DataFrame, sink_fn, checkpoint: str) -> None:
    """Scheduled batch over everything landed since the last run: only new
    files are read, then the query stops."""
    q = df.writeStream.foreachBatch(sink_fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


# ---------------------------------------------------------------- W1 on a stream
def window_stats_stream(df: DataFrame, ts: str, value: str, period_s: int, keys: Sequence[str] = (),
                        stats: Sequence[str] = ("sum", "avg", "max", "count"), delay: str = "10 minutes") -> DataFrame:
    """Tumbling-window statistics on a stream. With the watermark, append mode
    emits each (key, window) once, after the window closes, and drops its
    state; late points beyond ``delay`` are not counted."""
    from ..operators.alarms import window_stats
    return window_stats(df.withWatermark(ts, delay), ts, value, period_s, keys, stats)


# ---------------------------------------------------------------- W3-W5 on a stream
def start_alarm_stream(df: DataFrame, ts: str, value: str, stat: str, period_s: int, eval_periods: int,
                       threshold: float, cmp: str, keys: Sequence[str], state_path: str, out_path: str,
                       checkpoint: str, delay: str = "10 minutes", available_now: bool = True,
                       trigger_s: int = 60) -> StreamingQuery:
    """Alarm evaluation on a metric stream, with carried state.

    Each micro-batch emits the windows the watermark has closed. None that
    comes later starts before the latest end among them, the frontier, so all
    states up to it are final. A batch evaluates the new periods together with
    the breaching ones among the last ``eval_periods`` before the old frontier
    (all that a state or an edge can depend on) and appends the edges between
    the two frontiers to ``out_path``. The boundary table in ``state_path`` is
    those periods: a batch costs what its new periods and the keys that
    breached lately cost, whatever the history.

    Both outputs have a folder per batch; a batch that is replayed after a
    restart starts from its predecessor's state and replaces its own folders.
    Edges of a key without data appear when others move the frontier."""
    from ..operators.alarms import COMPARATORS, alarm_transitions
    keys = list(keys)
    closed = window_stats_stream(df, ts, value, period_s, keys, (stat,), delay)
    step = F.expr(f"INTERVAL {int(period_s)} SECONDS")
    carried = F.expr(f"INTERVAL {int(period_s) * int(eval_periods)} SECONDS")

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            latest = batch.agg(F.max(F.col("period_start") + step).alias("e")).first()["e"]
            if latest is None:
                return
            before = max((n for n in _batches(spark, state_path) if n < batch_id), default=None)
            frontier, periods = None, batch
            if before is not None:
                state = spark.read.schema(_state_schema(batch.schema)).parquet(f"{state_path}/batch={before}")
                frontier = state.agg(F.max("frontier").alias("e")).first()["e"]
                periods = state.where(F.col("period_start").isNotNull()).select(*batch.columns).unionByName(batch)
            edges = alarm_transitions(periods, stat, threshold, cmp, eval_periods, period_s, keys, end=F.lit(latest))
            if frontier is not None:
                edges = edges.where(F.col("period_start") >= F.lit(frontier))
            edges.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
            breach = F.coalesce(COMPARATORS[cmp](F.col(stat), F.lit(threshold)), F.lit(False))
            late = periods.where(breach & (F.col("period_start") >= F.lit(latest) - carried)).withColumn("frontier", F.lit(latest))
            mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema], F.lit(latest).alias("frontier"))
            late.unionByName(mark).write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
            for old in _batches(spark, state_path):
                if before is not None and old < before:
                    _drop(spark, f"{state_path}/batch={old}")
        finally:
            batch.unpersist()

    w = (closed.writeStream.outputMode("append").foreachBatch(evaluate)
               .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_s} seconds")
    return w.start()


def _state_schema(batch: StructType) -> StructType:
    return StructType(list(batch.fields)).add("frontier", batch["period_start"].dataType)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """The batches whose folder in ``path`` was written to its end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")) or []
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in found]


def _drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
