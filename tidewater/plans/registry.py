"""Registry of named queries over the driver tables, each with its SQL twin.

``@query(name, sql=...)`` registers a builder ``(spark, sf_dir) -> DataFrame``
and the equivalent DuckDB SQL. ``sql=None`` marks a query that SQL cannot
express (model training, engine-specific text output): it is checked on rows
only and by pytest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(name: str, sql: str | None, covers: str = ""):
    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        OPERATORS[name] = covers
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap
