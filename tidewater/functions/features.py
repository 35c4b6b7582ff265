"""Feature expressions.

The dictionary encode is a literal map lookup (``create_map``), evaluated in
codegen with no join and no broadcast of anything that grows with data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Merchant category codes and the code for anything else.
MERCHANT_ENCODING = {
    "grocery": 0,
    "electronics": 1,
    "restaurant": 2,
    "gas": 3,
    "travel": 4,
    "online": 5,
}
MERCHANT_DEFAULT = 5

# Fraud feature order, as the model consumes them.
FRAUD_FEATURES = [
    "amount_log", "merchant_cat_encoded", "hour_of_day", "day_of_week",
    "account_age_days", "prev_fraud_count", "distance_km_log", "is_foreign",
    "tx_freq_24h",
]

# Loan feature order (label column comes first in training files).
LOAN_FEATURES = [
    "age", "annual_income", "loan_amount", "loan_term_months", "credit_score",
    "employment_years", "debt_to_income_ratio", "has_mortgage",
    "num_credit_lines", "num_late_payments",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- P10
def dict_encode(col, mapping: dict[str, int], default: int) -> Column:
    """Lower-cased lookup in a fixed dictionary; missing or unknown -> default."""
    lut = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(lut, F.lower(_c(col))), F.lit(default)).cast("int")


# ---------------------------------------------------------------- P11
def log1p_scaled(col) -> Column:
    return F.log1p(_c(col).cast("double"))


def fraud_features(tx: DataFrame, keep: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """Transactions (FIXTURES 'transactions') to the nine model features.

    The id is kept (unlike the reference's feature file) so later
    deduplication cannot merge two equal transactions.
    """
    return tx.select(
        *keep,
        log1p_scaled("amount").alias("amount_log"),
        dict_encode(F.coalesce(F.col("merchant_category"), F.lit("online")),
                    MERCHANT_ENCODING, MERCHANT_DEFAULT).alias("merchant_cat_encoded"),
        F.col("hour_of_day").cast("int").alias("hour_of_day"),
        F.col("day_of_week").cast("int").alias("day_of_week"),
        F.col("user_account_age_days").cast("int").alias("account_age_days"),
        F.col("previous_fraud_count").cast("int").alias("prev_fraud_count"),
        log1p_scaled("distance_from_home_km").alias("distance_km_log"),
        F.col("is_foreign_transaction").cast("int").alias("is_foreign"),
        F.col("transaction_frequency_24h").cast("int").alias("tx_freq_24h"),
    )


# ---------------------------------------------------------------- P12
def feature_csv(cols: list[str]) -> Column:
    """Fixed-order features as one comma-separated text field."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in cols])


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
