"""Lake sinks.

Writes go through ``rebalance`` on the partition columns: AQE then splits a
hot partition value (a day holding a third of all rows) across several
tasks and files, and packs small ones together, instead of one task per
value (``repartition``) or one file per task per value (no shuffle).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

LOAD = "load"


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "append",
                      fmt: str = "parquet", spread: bool = True, compression: str | None = None) -> None:
    """K1. ``append`` adds files; ``overwrite`` rewrites only the partitions
    present in ``df`` (dynamic partition overwrite); ``replace`` makes ``df``
    the whole table, so that no partition of an earlier run stays. For one run
    per upload use ``write_load``. ``spread=False``: the rows are dealt already."""
    cols = list(partition_cols)
    out = df.hint("rebalance", *cols) if cols and spread else df
    w = out.write.mode("append" if mode == "append" else "overwrite").format(fmt)
    if mode != "append":
        w = w.option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
    if compression:
        w = w.option("compression", compression)
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)


def load_id(source: Column) -> Column:
    """Names a load by the file (or batch) it came from, so that the same
    upload always is the same load."""
    return F.substring(F.sha2(source, 256), 1, 16)


#: rows that one task writes, more or less: a run has as many tasks as that takes,
#: and one with larger partition values is rebalanced by bytes, which splits them
TASK_ROWS = 1_000_000
#: so many loads (16 characters each) are broadcast to rows, no more
BROADCAST_LOADS = 200_000
_REGISTRY = "_loads"         # hidden from Spark's listing of the table


def loads_of(df: DataFrame) -> DataFrame:
    """The loads of a run, also those without a good row."""
    return df.select(LOAD).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _folder(path: str, cols: Sequence[str], values: Sequence) -> str:
    escape = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else str(v)
    return "/".join([path.rstrip("/"), *(f"{c}={escape(v)}" for c, v in zip(cols, values))])


def write_load(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet", loads: DataFrame | None = None) -> None:
    """Append loads: ``df`` carries a ``load`` column, a column of the files. A
    load that comes again (a retried or repeated upload) replaces its rows, and
    other loads of the same partitions stay. ``loads`` names loads that may have
    no row left.

    A registry beside the table, written before the data, says which partitions
    a load may have rows in. New loads are only appended: one file per partition
    value and run if it is small, whatever the number of loads. For loads that
    the registry knows, their partitions are read (no others), merged without
    them, staged beside the table and moved into place; a run that breaks off is
    mended by the next one, as the registry has its partitions. Without
    partition columns every load has a folder of its own. What reaches the
    driver is the partitions of repeated loads."""
    spark, cols = df.sparkSession, list(partition_cols)
    if not cols:
        return _write_load_folders(df, path, fmt, loads)
    finish_pending(spark, path)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        registry = f"{path.rstrip('/')}/{_REGISTRY}"
        run = df.groupBy(*cols, LOAD).agg(F.count(F.lit(1)).alias("n"))
        mine = loads if loads is not None else loads_of(df)
        known = spark.read.schema(run.schema).parquet(registry) if exists(spark, registry) else None
        again = [tuple(r) for r in known.join(mine, LOAD, "left_semi").select(*cols).distinct().collect()] if known is not None else []
        if again:
            # rows of new loads are appended, also to those partitions
            back = _few(known.join(mine, LOAD, "left_semi").select(LOAD).distinct())
            mark = F.col("_back")
            df_back = df.join(back.withColumn("_back", F.lit(True)), LOAD, "left").select(*df.columns, mark)
            old_rows, new_rows = df_back.where(mark).drop("_back"), df_back.where(mark.isNull()).drop("_back")
        run.coalesce(1).write.mode("append").parquet(registry)
        rest = df
        if again:
            _replace(old_rows, path, cols, fmt, back, again)
            rest = new_rows.unionByName(_of(old_rows, cols, again, "left_anti"))
        write_partitioned(_spread(rest, run, cols), path, cols, mode="append", fmt=fmt, spread=False)
    finally:
        df.unpersist()


def _few(loads: DataFrame) -> DataFrame:
    """Loads, broadcast to the rows they are joined to if they are few: these
    are not shuffled for them."""
    return F.broadcast(loads) if loads.limit(BROADCAST_LOADS + 1).count() <= BROADCAST_LOADS else loads


def _of(df: DataFrame, cols: list[str], keys: list[tuple], how: str) -> DataFrame:
    """The rows of (or, with left_anti, not of) the given partitions."""
    names = StructType([StructField(f"_key_{c}", df.schema[c].dataType) for c in cols])
    same = functools.reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"_key_{c}")) for c in cols])
    return df.join(F.broadcast(df.sparkSession.createDataFrame(keys, names)), same, how)


def _spread(df: DataFrame, run: DataFrame, cols: list[str]) -> DataFrame:
    """Rows by partition value: one task for several values, unless one is
    larger than a task's share; as many tasks as the rows take."""
    s = run.groupBy(*cols).agg(F.sum("n").alias("n")).agg(F.count(F.lit(1)).alias("values"), F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if (s["most"] or 0) > TASK_ROWS:
        return df.hint("rebalance", *cols)
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-(s["rows"] or 0) // TASK_ROWS))
    return df.repartition(max(1, min(s["values"], tasks)), *cols)


def _replace(df: DataFrame, path: str, cols: list[str], fmt: str, loads: DataFrame, touched: list[tuple]) -> None:
    """Write the ``touched`` partitions anew: their rows of other loads, and
    those of ``df``."""
    spark = df.sparkSession
    folders = {key: _folder(path, cols, key) for key in touched}
    there = [f for f in folders.values() if exists(spark, f)]
    new = _of(df, cols, touched, "left_semi")
    if there:
        old = spark.read.format(fmt).schema(df.schema).option("basePath", path).load(there)
        new = old.join(loads, LOAD, "left_anti").unionByName(new)
    overwrite_staged(new.hint("rebalance", *cols), path, cols, fmt, folders)


_PENDING = "_pending"
_PENDING_SCHEMA = "stage STRING, gone ARRAY<STRING>"


def overwrite_staged(df: DataFrame, path: str, cols: Sequence[str], fmt: str = "parquet", folders: dict[tuple, str] | None = None) -> None:
    """Replace the partitions that ``df`` has, where ``df`` may read them: it is
    written beside the table first (hidden from Spark's listing), noted, and its
    folders are then moved over the old ones, so that rows are written once. A
    run that breaks off in between, perhaps with a partition already taken away,
    is finished from the staged folders by the next one (``finish_pending``).
    ``folders`` are partitions that go if ``df`` has no row for them. The rows
    of ``df`` are dealt already. One writer at a time. What reaches the driver
    is the names of folders."""
    spark, path = df.sparkSession, path.rstrip("/")
    stage = f"{path}/_staged-{uuid.uuid4().hex[:12]}"
    write_partitioned(df, stage, cols, fmt=fmt, spread=False)
    left = {f"{path}{unquote(f[len(stage):])}" for f in _leaves(spark, stage, len(cols))}
    gone = [f for f in (folders or {}).values() if f not in left]
    note = spark.createDataFrame([(stage, gone)], _PENDING_SCHEMA)
    note.coalesce(1).write.mode("overwrite").json(f"{path}/{_PENDING}")
    finish_pending(spark, path)


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below ``path``."""
    if depth == 0:
        return [path]
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where) if f.isDirectory()]
    return [leaf for n in names if "=" in n for leaf in _leaves(spark, f"{path}/{n}", depth - 1)]


def finish_pending(spark: SparkSession, path: str) -> None:
    """Finish an overwrite that was noted and not ended."""
    path = path.rstrip("/")
    note = f"{path}/{_PENDING}"
    if not exists(spark, f"{note}/_SUCCESS"):
        return
    row = spark.read.schema(_PENDING_SCHEMA).json(note).first()
    if exists(spark, row["stage"]):
        _move(spark, row["stage"], path)
    for folder in row["gone"] or []:
        _delete(spark, folder)
    _delete(spark, note)
    _delete(spark, row["stage"])


def _move(spark: SparkSession, stage: str, path: str) -> None:
    """Move all staged partition folders over those of the table; what is moved
    is no longer staged."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def walk(at: str) -> None:
        below = [f.getPath().getName() for f in fs.listStatus(hadoop.Path(f"{stage}{at}")) if f.isDirectory()]
        below = [n for n in below if "=" in n]
        for n in below:
            walk(f"{at}/{n}")
        if at and not below and any(f.isFile() for f in fs.listStatus(hadoop.Path(f"{stage}{at}"))):
            new, parent = hadoop.Path(f"{path}{at}"), hadoop.Path(f"{path}{at}").getParent()
            fs.delete(new, True)
            fs.mkdirs(parent)
            if not fs.rename(hadoop.Path(f"{stage}{at}"), new):
                raise OSError(f"{stage}{at} could not be moved to {path}{at}")

    walk("")


def _write_load_folders(df: DataFrame, path: str, fmt: str, loads: DataFrame | None, spread: bool = True,
                        compression: str | None = None) -> None:
    spark = df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_partitioned(df, path, [LOAD], mode="overwrite", fmt=fmt, spread=spread, compression=compression)
        if loads is not None:
            for r in loads.join(df.select(LOAD).distinct(), LOAD, "left_anti").collect():
                _delete(spark, _folder(path, [LOAD], [r[LOAD]]))
    finally:
        df.unpersist()


def read_loads(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table of ``write_load`` with its load column. Partition values come
    back as strings (month='01'), trap T3: the session must not infer their
    types (``session.configure`` sees to it)."""
    if spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") != "false":
        raise ValueError("partition values would be read as numbers; call session.configure first")
    return spark.read.format(fmt).option("basePath", path).load(path)


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A partitioned table; the load column of ``write_load`` is left out."""
    return read_loads(spark, path, fmt).drop(LOAD)


# ---------------------------------------------------------------- F7 / T4
def dead_letter(bad: DataFrame, path: str, job: str, loads: DataFrame | None = None, as_read: bool = False) -> None:
    """Rejected records (text, reason, source file and load) as JSON lines (gzip)
    with the job's name and the time, under ``path``. A repeated upload replaces its
    own rejects. ``as_read``: the rows lie as they were read, a load in few
    tasks, and are written from there."""
    _write_load_folders(bad.withColumns({"job": F.lit(job), "rejected_at": F.current_timestamp()}), path, "json", loads, spread=not as_read, compression="gzip")


# ---------------------------------------------------------------- K7
def write_json_by_date(df: DataFrame, path: str, ts_col: str, date_col: str = "date", mode: str = "append") -> None:
    """One folder per date, many records per file (not one object per row)."""
    out = df.withColumn(date_col, F.date_format(F.col(ts_col), "yyyy-MM-dd"))
    write_partitioned(out, path, [date_col], mode=mode, fmt="json")


# ---------------------------------------------------------------- K8, K11
def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_feature_csv(features: DataFrame, path: str, source_col: str = "source_file", ids_path: str | None = None) -> None:
    """One folder per source file, features only; the ids go to a side table
    (source file, id, features) at ``ids_path``. A source file that comes again
    replaces its own folder, others stay."""
    body = features.drop("transaction_id") if "transaction_id" in features.columns else features
    for df, target, fmt in ((body, path, "csv"), (features if ids_path else None, ids_path, "parquet")):
        if df is not None:
            (df.write.mode("overwrite").option("header", True).option("partitionOverwriteMode", "dynamic")
             .partitionBy(source_col).format(fmt).save(target))


# ---------------------------------------------------------------- K12
def write_label_first_csv(df: DataFrame, path: str, label: str, features: Sequence[str], mode: str = "overwrite") -> None:
    """Training export: label first, no header (position is meaning)."""
    df.select(label, *features).write.mode(mode).option("header", False).csv(path)
