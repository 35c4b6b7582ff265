"""Routing and record-level failure isolation.

Routing is a derived column, not a branch in driver code: one scan feeds
every route, and each writer filters on the route (see ``sinks.fanout``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import violations
from ..functions.rules import incident_alert_text, incident_log_key


# ---------------------------------------------------------------- F5
def route_by_severity(incidents: DataFrame, severity: str = "severity", id_col: str = "id",
                      high: str = "HIGH", keep: tuple[str, ...] = ()) -> DataFrame:
    """HIGH (exact, case-sensitive) goes to the alert branch; everything
    else, including a missing severity, goes to the log branch. Both
    branches are then saved, so every incident keeps one row. The alert says
    the whole incident, as JSON, without the columns in ``keep`` (the load it
    came with, say), which only pass through."""
    is_high = F.coalesce(F.col(severity) == F.lit(high), F.lit(False))
    event = F.to_json(F.struct(*[F.col(f"`{c}`") for c in incidents.columns if c not in keep]))
    return incidents.withColumns({
        "route": F.when(is_high, F.lit("alert")).otherwise(F.lit("log")),
        "alert_text": F.when(is_high, incident_alert_text(event)),
        "log_key": F.when(~is_high, incident_log_key(F.col(id_col))),
    })


# ---------------------------------------------------------------- F6
def with_errors(df: DataFrame, rules: dict[str, Column], errors: str = "errors", valid: str = "valid") -> DataFrame:
    """Attach the list of broken rules and a validity flag."""
    out = df.withColumn(errors, violations(rules))
    return out.withColumn(valid, F.size(F.col(errors)) == 0)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reasons). Persist ``df``
    first if both sides are written, so the input is read once."""
    checked = with_errors(df, rules)
    return (checked.where(F.col("valid")).drop("errors", "valid"),
            checked.where(~F.col("valid")).drop("valid"))
