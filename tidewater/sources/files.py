"""File and table sources.

Explicit schemas replace a second inference pass; PERMISSIVE parsing keeps a
malformed line as a row with a ``_corrupt_record`` text instead of failing
the job (routed to a dead letter by the caller).
"""

from __future__ import annotations

import csv
import functools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.clean import snake_name
# one corrupt-record column name and schema helper for every text source
from .envelope import CORRUPT, _with_corrupt  # noqa: E402,F401


# ---------------------------------------------------------------- S1
HEADER_BYTES = 1 << 16       # a header line is no longer than this
_READERS = 16                # headers read at a time


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The header names of every file, normalised; an empty file has none.
    Like a listing, this opens each file once on the driver and reads its first
    line, no data."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(path: str) -> list[str]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = where.getFileSystem(conf).open(where)
        try:
            codec = codecs.getCodec(where)
            source = codec.createInputStream(stream) if codec is not None else stream
            line = bytes(source.readNBytes(HEADER_BYTES)).split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r")
        finally:
            stream.close()
        return [snake_name(c) for c in next(csv.reader([line.lstrip("\ufeff")]), [])] if line.strip() else []

    with ThreadPoolExecutor(_READERS) as pool:
        return list(pool.map(first_line, paths))


def _bound(spark: SparkSession, names: tuple[str, ...], paths: list[str], fields: StructType, place: list[Column]) -> DataFrame:
    """Files of one header: its columns by name, the others null. A header with
    a name twice or with none of the names tells nothing about its lines, which
    are then all kept as unreadable (blank lines are none)."""
    known = {f.name for f in fields}
    mine = [n for n in names if n in known]
    if not mine or len(set(mine)) < len(mine):
        lines = spark.read.text(paths).where(F.trim("value") != "")
        return lines.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], F.col("value").alias(CORRUPT), *place)
    own = StructType()
    for k, n in enumerate(names):
        own = own.add(n, fields[n].dataType) if n in known else own.add(f"_other_{k}", "string")
    r = spark.read.schema(own.add(CORRUPT, "string")).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = r.csv(paths)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields], CORRUPT, *place)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, path_col: str | None = None, block_col: str | None = None) -> DataFrame:
    """CSV with header. With ``schema`` no inference pass is made, and columns
    go by *name*: each file's header line is read and normalised (P1), files of
    equal headers are scanned together under their own column order, and the
    scans are united. So reordered and renamed (`` Sale-Date ``) columns land in
    their place, missing ones are null, others are left out. Bad lines keep
    their text in ``_corrupt_record``, as do all lines of a file whose header
    names no column or one of them twice. ``path_col`` adds the file's path,
    ``block_col`` where the row's split starts in it. Without ``schema`` types
    are inferred (one extra pass, as the reference does)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    place = [F.col(f"_metadata.{m}").alias(c) for m, c in (("file_path", path_col), ("file_block_start", block_col)) if c]
    if not header:
        return r.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT).csv(path).select("*", *place)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    paths = [x["path"] for x in spark.read.format("binaryFile").load(path).where("length > 0").select("path").collect()]
    groups: dict[tuple[str, ...], list[str]] = {}
    for where, names in zip(paths, csv_headers(spark, paths)):
        groups.setdefault(tuple(names), []).append(where)
    scans = [_bound(spark, names, own, fields, place) for names, own in sorted(groups.items())]
    if not scans:
        empty = _with_corrupt(fields)
        for c, kind in ((path_col, "string"), (block_col, "long")):
            empty = empty.add(c, kind) if c else empty
        return spark.createDataFrame([], empty)
    return functools.reduce(DataFrame.unionByName, scans)


# ---------------------------------------------------------------- S2
def read_ndjson(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        r = r.schema(_with_corrupt(schema))
    return r.json(path)


# ---------------------------------------------------------------- S3
def read_label_first_csv(spark: SparkSession, path: str, label: str, features: Sequence[str],
                         label_type: str = "int", feature_type: str = "double") -> DataFrame:
    """Headerless training CSV: position is meaning (label first)."""
    ddl = ", ".join([f"{label} {label_type}"] + [f"{f} {feature_type}" for f in features])
    return spark.read.option("header", False).schema(ddl).csv(path)


# ---------------------------------------------------------------- S4
def read_json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON document per file (pretty-printed objects)."""
    r = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        r = r.schema(_with_corrupt(schema))
    return r.json(path)


def with_source_file(df: DataFrame) -> DataFrame:
    """Adds the source path and basename from the file metadata column."""
    return df.withColumns({"source_path": F.col("_metadata.file_path"),
                           "source_file": F.col("_metadata.file_name")})


# ---------------------------------------------------------------- S5
def arrival_filter(path_col: str, prefix: str = "", suffix: str = ".csv", case_sensitive: bool = False, root: str = ""):
    """Predicate on an object key: it starts with ``prefix`` and ends in
    ``suffix`` (the sales trigger lower-cases the key, the ML one does not). For
    full paths give ``root``, the part before the keys."""
    p = F.col(path_col)
    key = p if case_sensitive else F.lower(p)
    sfx = suffix if case_sensitive else suffix.lower()
    cond = key.endswith(sfx)
    if prefix:
        cond = cond & F.col(path_col).startswith(root.rstrip("/") + "/" + prefix if root else prefix)
    return cond


def suffix_glob(suffix: str, case_sensitive: bool = False) -> str:
    """A listing-time glob for the suffix, so non-matching files are never
    opened (``*.[cC][sS][vV]`` for a case-insensitive '.csv')."""
    if case_sensitive:
        return "*" + suffix
    return "*" + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)


# ---------------------------------------------------------------- S9
def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(name, size, path) of every file; directories are skipped and the
    content column is pruned, so no file body is read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.col("length").alias("size"), F.col("path").alias("url"))


# ---------------------------------------------------------------- S10
def latest_object(spark: SparkSession, path: str, by: str = "key") -> str | None:
    """The last object in key order (the reference's rule), or the newest by
    modification time with ``by='mtime'``. Only one path string reaches the
    driver."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    if by == "mtime":
        row = df.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    else:
        row = df.agg(F.max("path").alias("p")).first()
    return row["p"] if row else None


# ---------------------------------------------------------------- S8
def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
              properties: dict | None = None) -> DataFrame:
    """Relational table scan, split into ``num_partitions`` range reads on a
    numeric column so executors read in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()
