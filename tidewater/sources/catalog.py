"""Lake table registration and partition listing."""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def partition_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct partition tuples as a DataFrame (S12 on data, not metadata)."""
    return df.select(*cols).distinct()


# ---------------------------------------------------------------- S11: schemas that widen
_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_READERS = 16                # footers read at a time
_SPARK_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"


def wider(a: str, b: str) -> str | None:
    """The least type that holds the values of both, exactly; None if none of
    the table's types does. Whole numbers widen up to bigint, those of 32 bits
    and float to double, every scalar to string."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} <= {"tinyint", "smallint", "int", "float", "double"} and ({a, b} & {"double"} or {a, b} <= {"tinyint", "smallint", "float"}):
        return "double" if "double" in (a, b) else "float"
    if {a, b} <= {"int", "float"}:
        return "double"
    scalar = {*_WHOLE, "float", "double", "string", "date", "boolean", "timestamp", "timestamp_ntz"}
    return "string" if "string" in (a, b) and {a, b} <= scalar else None


def file_schemas(spark: SparkSession, paths: Sequence[str]) -> list[StructType]:
    """The schema of every Parquet file, from its footer. Like a listing, this
    opens each file once on the driver and reads no data."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def one(path: str) -> StructType:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            said = reader.getFooter().getFileMetaData().getKeyValueMetaData().get(_SPARK_SCHEMA)
        finally:
            reader.close()
        return StructType.fromJson(json.loads(said)) if said else spark.read.parquet(path).schema

    with ThreadPoolExecutor(_READERS) as pool:
        return list(pool.map(one, paths))


def widened(schemas: Sequence[tuple[StructType, int]]) -> tuple[dict[str, str], dict[int, str]]:
    """Types by column of a table of files with these schemas (and how many
    files have each), and what is wrong with the schemas that do not fit. The
    schema that most files go with comes first, the others join it one by one."""
    types: dict[str, str] = {}
    wrong: dict[int, str] = {}
    kinds = [{f.name: f.dataType.simpleString() for f in schema.fields} for schema, _ in schemas]
    going = [sum(n for other, (_, n) in zip(kinds, schemas) if all(wider(own.get(c, t), t) for c, t in other.items())) for own in kinds]
    for k in sorted(range(len(schemas)), key=lambda k: (-going[k], -schemas[k][1], schemas[k][0].simpleString())):
        own = {f.name: f.dataType.simpleString() for f in schemas[k][0].fields}
        joined = {c: wider(types.get(c, t), t) for c, t in own.items()}
        bad = [f"{c}: {own[c]} is not {types[c]}" for c, t in joined.items() if t is None]
        if bad:
            wrong[k] = ", ".join(bad)
        else:
            types.update(joined)
    return types, wrong


def read_widened(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A partitioned folder of Parquet files as one table whose columns are as
    wide as its files need (new columns included), and (path, reason) of files
    that are set aside because a column fits no common type. Files of one schema
    are scanned together; where all have one, that is the plain scan."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    paths = [r["path"] for r in listed.collect()]
    groups: dict[str, list[str]] = {}
    for where, schema in zip(paths, file_schemas(spark, paths)):
        groups.setdefault(schema.json(), []).append(where)
    kinds = [(StructType.fromJson(json.loads(s)), own) for s, own in groups.items()]
    types, wrong = widened([(schema, len(own)) for schema, own in kinds])
    scans = []
    for k, (schema, own) in enumerate(kinds):
        if k not in wrong:
            df = spark.read.option("basePath", path).schema(schema).parquet(*own) if len(kinds) > 1 else spark.read.option("basePath", path).parquet(path)
            more = [c for c in df.columns if c not in types]                      # partition columns
            scans.append(df.select(*[(F.col(f"`{c}`") if c in schema.names else F.lit(None)).cast(t).alias(c) for c, t in types.items()], *more))
    table = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans) if scans else spark.createDataFrame([], "path STRING").drop("path")
    aside = [(p, wrong[k]) for k, (_, own) in enumerate(kinds) if k in wrong for p in own]
    return table, spark.createDataFrame(aside, "path STRING, reason STRING")


def register_table(spark: SparkSession, name: str, path: str, schema_ddl: str | None = None,
                   partition_cols: Sequence[str] = ()) -> DataFrame:
    """An external Parquet table over ``path``; partitions discovered
    from the folder layout (MSCK REPAIR). Re-running adds new partitions, and
    columns that newer files have and the table does not. Where newer files need
    a wider number (int, then bigint), the table is defined anew over the same
    files, which Spark reads as the wider type. Files that fit no common type,
    or only as text, are named in a ValueError here instead of failing a query
    later; ``read_widened`` reads such folders."""
    paths = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]
    groups: dict[str, list[str]] = {}
    for where, schema in zip(paths, file_schemas(spark, paths)):
        groups.setdefault(schema.json(), []).append(where)
    kinds = [(StructType.fromJson(json.loads(s)), own) for s, own in groups.items()]
    types, wrong = widened([(schema, len(own)) for schema, own in kinds])
    for k, (schema, own) in enumerate(kinds):
        told = wrong.get(k) or ", ".join(f"{f.name}: {f.dataType.simpleString()} as string" for f in schema.fields
                                         if types[f.name] == "string" != f.dataType.simpleString())
        if told:
            raise ValueError(f"{own[0]} and {len(own) - 1} more do not fit {name}: {told}")
    if spark.catalog.tableExists(name):
        had = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields}
        grown = {c: wider(had[c], t) for c, t in types.items() if c in had and wider(had[c], t) not in (None, had[c])}
        if grown:
            keep = [(c, grown.get(c, t)) for c, t in had.items()]
            spark.sql(f"DROP TABLE {name}")                                       # external: its files stay
            schema_ddl = ", ".join(f"`{c}` {t}" for c, t in keep)
    cols = f"({schema_ddl})" if schema_ddl else "(" + ", ".join([*(f"`{c}` {t}" for c, t in types.items()), *(f"`{c}` STRING" for c in partition_cols)]) + ")"
    parts = f"PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {cols} USING parquet {parts} LOCATION '{path}'")
    known = {c.lower() for c in spark.table(name).columns}
    new = [f"`{c}` {t}" for c, t in types.items() if c.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
    return spark.table(name)


def listed_partitions(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """S12 from the listing of a partitioned folder: names only, no file is
    opened. Values are text."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
             .select("path"))
    return files.select(*[F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)).alias(c) for c in cols]).distinct()


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")
