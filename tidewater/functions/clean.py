"""Column cleaning expressions.

Everything here is a Catalyst expression or a single projection, so it fuses
into the scan's whole-stage-codegen span and costs no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- P1
def snake_name(name: str) -> str:
    """strip, lower, then space and '-' become '_'."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column in one projection; fail if two names collide."""
    new = [snake_name(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalising: {dupes}")
    return df.toDF(*new)


# ---------------------------------------------------------------- P2
def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop rows with a null in any required column."""
    return df.na.drop(how="any", subset=list(required))


# ---------------------------------------------------------------- P3 / T1
def enforce(col, spark_type: str, fmt: str | None = None) -> Column:
    """Cast without failing the job: values that do not parse become null.

    ``spark_type`` is a SQL type name ("double", "int", "date", "timestamp").
    Under ANSI mode a plain cast raises on bad input, hence ``try_*``.
    """
    c = _c(col)
    t = spark_type.lower()
    if t == "date":
        s = c.cast("string")
        return F.try_to_date(s, fmt) if fmt else F.try_to_date(s)
    if t == "timestamp":
        s = c.cast("string")
        return F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return c.try_cast(t)


def enforce_types(df: DataFrame, types: dict[str, str], formats: dict[str, str] | None = None) -> DataFrame:
    formats = formats or {}
    return df.withColumns({name: enforce(name, t, formats.get(name)) for name, t in types.items()})


# ---------------------------------------------------------------- P4
def trimmed(col) -> Column:
    return F.trim(_c(col))


def lower_trimmed(col) -> Column:
    return F.lower(F.trim(_c(col)))


# ---------------------------------------------------------------- P5
def date_part_strings(col) -> dict[str, Column]:
    """Hive partition values as zero-padded strings: year, month, day."""
    c = _c(col)
    return {
        "year": F.year(c).cast("string"),
        "month": F.lpad(F.month(c).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(c).cast("string"), 2, "0"),
    }


def with_date_partitions(df: DataFrame, col, hour: bool = False) -> DataFrame:
    parts = date_part_strings(col)
    if hour:
        parts["hour"] = F.lpad(F.hour(_c(col)).cast("string"), 2, "0")
    return df.withColumns(parts)


# ---------------------------------------------------------------- P6
def ingest_partitions(run_date: _dt.date) -> dict[str, Column]:
    """Partition columns from the run date (a job parameter, not event time)."""
    return {
        "year": F.lit(f"{run_date.year}"),
        "month": F.lit(f"{run_date.month:02d}"),
        "day": F.lit(f"{run_date.day:02d}"),
    }


# ---------------------------------------------------------------- P7
def slug(col) -> Column:
    """lower-case; ' & ' becomes '_', then every space becomes '_'; null -> ''."""
    lowered = F.lower(F.coalesce(_c(col), F.lit("")))
    return F.replace(F.replace(lowered, F.lit(" & "), F.lit("_")), F.lit(" "), F.lit("_"))


# ---------------------------------------------------------------- P8
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def iso_stamp(ts: Column | None = None) -> Column:
    """ISO-8601 UTC text for a timestamp; ``None`` means the query's now()."""
    ts = F.current_timestamp() if ts is None else ts
    return F.date_format(ts, ISO_UTC_FORMAT)


# ---------------------------------------------------------------- P9
def parse_iso_timestamp(col) -> Column:
    """ISO-8601 text ('2024-01-15T08:30:00Z', offsets, fractions) to timestamp; bad text -> null."""
    return F.try_to_timestamp(_c(col))


# ---------------------------------------------------------------- P20
#: every character that counts as white space at the ends of a text (fixed value)
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_white(col) -> Column:
    """The text without white space (of any kind) at its ends."""
    return F.trim(_c(col), F.lit(WHITE))


def non_blank(col) -> Column:
    """True when the text has a character that is not white space."""
    return F.coalesce(strip_white(col) != F.lit(""), F.lit(False))

