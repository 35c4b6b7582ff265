"""Keyed table changes (M1-M4; the sink form of M1 is K3 in ``sinks.keyed``).

All four are set-based: union + per-key survivor aggregate, or an anti / outer
join. None of them loops on the driver or materialises a key's rows in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import strip_white
from .dedup import keep_one


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | Sequence[str] | None = None) -> DataFrame:
    """M1: the table after applying ``changes``; last write wins.

    Without ``seq`` a change always beats the stored row (arrival order);
    within one batch, equal-key changes are ordered by ``seq`` then by all
    columns so the outcome does not depend on partitioning.
    """
    keys = list(keys)
    seqs = [] if seq is None else ([seq] if isinstance(seq, str) else list(seq))
    cols = base.columns
    both = (base.select(*cols).withColumn("_src", F.lit(0))
            .unionByName(changes.select(*cols).withColumn("_src", F.lit(1))))
    order = ["_src", *seqs] if seq is None else [*seqs, "_src"]
    return keep_one(both, keys, order=order, latest=True).drop("_src")


def delete_keys(df: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M2: remove every row whose key appears in ``deletes``.

    A left-anti join: Spark broadcasts the delete set only when its runtime
    size is under ``autoBroadcastJoinThreshold``; otherwise it shuffles both
    sides on the key (skewed partitions split by AQE).
    """
    keys = list(keys)
    return df.join(deletes.select(*keys).distinct(), on=keys, how="left_anti")


def partial_update(base: DataFrame, updates: DataFrame, key: str, name: str = "name",
                   description: str = "description", has_description: str = "has_description") -> DataFrame:
    """M3: apply partial updates.

    * ``name``: a null or empty new value keeps the old one; the result is
      stripped of all white space at its ends (a whitespace-only new name therefore becomes '').
    * ``description``: replaced only when ``has_description`` is true, even
      by null.
    Keys absent from ``base`` are ignored (an update, not an insert).
    ``updates`` must hold at most one row per key (use ``latest_by`` first).
    """
    u = updates.select(F.col(key), F.col(name).alias("_new_name"),
                       F.col(description).alias("_new_desc"),
                       F.col(has_description).alias("_has_desc"), F.lit(True).alias("_hit"))
    j = base.join(u, on=key, how="left")
    new_name = strip_white(F.coalesce(F.nullif(F.col("_new_name"), F.lit("")), F.col(name)))
    new_desc = F.when(F.coalesce(F.col("_has_desc"), F.lit(False)), F.col("_new_desc")).otherwise(F.col(description))
    return (j.withColumn(name, F.when(F.col("_hit"), new_name).otherwise(F.col(name)))
             .withColumn(description, new_desc)
             .select(*base.columns))


def fold_changelog(changes: DataFrame, keys: Sequence[str], seq: Sequence[str] | str,
                   op: str = "op", delete_value: str = "delete") -> DataFrame:
    """M4: insert / update / delete log to the current snapshot: the latest
    change per key wins and keys whose latest change is a delete vanish."""
    seq = [seq] if isinstance(seq, str) else list(seq)
    latest = keep_one(changes, keys, order=seq, latest=True)
    return latest.where(F.col(op).isNull() | (F.col(op) != F.lit(delete_value)))
