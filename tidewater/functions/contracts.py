"""Record contracts (P17-P19): rules produce an array of error names.

A row is valid when the array is empty. Rules never raise, so one bad record
cannot fail a batch (F7); callers split on ``size(errors) = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def violations(rules: dict[str, Column]) -> Column:
    """``rules`` maps an error name to the condition a valid row satisfies.

    A null condition (missing input) counts as a violation.
    """
    flags = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def between(col, lo=None, hi=None) -> Column:
    c = _c(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= lo)
    if hi is not None:
        cond = cond & (c <= hi)
    return cond & c.isNotNull()


# The transaction request contract.
def transaction_rules() -> dict[str, Column]:
    return {
        "amount_not_positive": F.col("amount") > 0,
        "hour_out_of_range": between("hour_of_day", 0, 23),
        "weekday_out_of_range": between("day_of_week", 0, 6),
        "account_age_negative": between("user_account_age_days", 0),
        "fraud_count_negative": between("previous_fraud_count", 0),
        "distance_negative": between("distance_from_home_km", 0),
        "foreign_flag_not_0_1": between("is_foreign_transaction", 0, 1),
        "frequency_below_1": between("transaction_frequency_24h", 1),
        "transaction_id_missing": F.col("transaction_id").isNotNull(),
        "merchant_category_missing": F.col("merchant_category").isNotNull(),
    }


# ---------------------------------------------------------------- P18 / U2
def missing_keys(json_text, required: list[str]) -> Column:
    """Required top-level keys absent from a JSON object (all of them when the
    text is not a JSON object)."""
    present = F.coalesce(F.json_object_keys(_c(json_text)), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(k) for k in required]), present)


def missing_fields(struct_or_map, required: list[str]) -> Column:
    """Same for a map column: keys absent or mapped to null."""
    m = _c(struct_or_map)
    return F.filter(F.array(*[F.lit(k) for k in required]),
                    lambda k: F.try_element_at(m, k).isNull())


# ---------------------------------------------------------------- P19
def non_empty_json_array(json_text, path: str = "$.data") -> Column:
    """True only when the value at ``path`` is a JSON array with an element; a
    string that reads like one is a string."""
    value = F.try_variant_get(F.try_parse_json(_c(json_text)), path, "variant")
    is_array = F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
    n = F.json_array_length(F.get_json_object(_c(json_text), path))
    return F.coalesce(is_array & (n > 0), F.lit(False))


def non_empty_array(col) -> Column:
    return F.coalesce(F.size(_c(col)) > 0, F.lit(False))
