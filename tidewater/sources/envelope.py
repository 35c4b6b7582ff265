"""Stream envelopes and JSON payloads.

A record arrives as ``(sequence_number, data)`` where ``data`` is base64 of a
UTF-8 JSON line. Decoding never raises: bad base64, bytes that are not UTF-8 or
bad JSON give a null payload and a ``failed`` flag, so the batch goes on
(per-record isolation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def encode_envelope(df: DataFrame, seq: str, payload: str, extra: Sequence[str] = ()) -> DataFrame:
    """What a producer puts on the log: sequence number + base64(JSON)."""
    return df.select(F.col(seq).cast("string").alias("sequence_number"),
                     F.base64(F.encode(F.col(payload), "UTF-8")).alias("data"), *extra)


def _parse_once(df: DataFrame, text, schema: str | StructType) -> DataFrame:
    """Adds ``record``: the parsed struct, with a ``_corrupt_record`` field
    holding the text of a malformed line (null record: no text at all).

    The parse happens inside a Generate (``explode`` of a one-element array):
    filters on the parsed fields cannot be pushed below a Generate, so the
    optimizer cannot copy the decode + parse into each predicate and the
    JSON is parsed exactly once per row.
    """
    st = _with_corrupt(schema)
    parsed = F.from_json(text, st, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(*df.columns, F.explode(F.array(parsed)).alias("record"))


def decode_envelope(env: DataFrame, schema: str | StructType, data: str = "data") -> DataFrame:
    """base64 -> UTF-8 -> JSON struct in ``record``; ``failed`` marks records
    whose bytes or JSON could not be read (the original ``data`` stays for the
    dead letter) (trap T4: a corrupt line parses to
    a struct of nulls, so failure is read from the corrupt-record field)."""
    text = F.try_validate_utf8(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"))
    out = _parse_once(env, text, schema)
    return out.withColumn("failed", F.col("record").isNull() | F.col("record")[CORRUPT].isNotNull())


def parse_json_isolated(df: DataFrame, text: str, schema: str | StructType,
                        required: Sequence[str] | None = None) -> DataFrame:
    """Parse a JSON text column into ``parsed``; ``failed`` is true when the
    text is not JSON or a required field (default: all fields) is null."""
    fields = list(required) if required is not None else _fields(schema)
    out = _parse_once(df, F.col(text), schema).withColumnRenamed("record", "parsed")
    bad = F.col("parsed").isNull() | F.col("parsed")[CORRUPT].isNotNull()
    for f in fields:
        bad = bad | F.col("parsed")[f].isNull()
    return out.withColumn("failed", bad)


def record_fields(df: DataFrame, col: str = "record") -> list:
    """The parsed fields without the corrupt-record text, for ``select``."""
    return [F.col(col)[f].alias(f) for f in df.schema[col].dataType.fieldNames() if f != CORRUPT]


def _fields(schema: str | StructType) -> list[str]:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return st.fieldNames()


def _with_corrupt(schema: str | StructType) -> StructType:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if CORRUPT not in st.fieldNames():
        st = StructType(st.fields + [StructField(CORRUPT, StringType(), True)])
    return st
