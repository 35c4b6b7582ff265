"""Boosted-tree training and batch scoring (ML1-ML6) on Spark ML.

Training is distributed by Spark ML (per-iteration aggregation over all
partitions); scoring is ``model.transform``, a narrow map over the input, so
it scales with executors and never funnels rows through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as RU
from ..session import scratch_path, shared_dir

# The reference's boosted-tree settings. (XGBoost's L2
# regularisation and exact weighting differ from Spark's GBT, so scores are
# not expected to match; rules on top of scores are.)
GBT_PARAMS = {"maxIter": 150, "maxDepth": 5, "stepSize": 0.2, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8"}
FRAUD_POSITIVE_WEIGHT = 4.0
LOAN_POSITIVE_WEIGHT = 3.0


# ---------------------------------------------------------------- ML2
def class_weight(label: str, positive_weight: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))


# ---------------------------------------------------------------- ML4
def split_flag(id_col: str, train_pct: int = 80, method: str = "hash") -> Column:
    """Deterministic train/validation assignment per row. ``hash`` spreads
    any id pattern evenly; ``mod`` (last digit of an integer id) is the
    portable form SQL engines can reproduce."""
    if method == "mod":
        bucket = F.pmod(F.col(id_col), F.lit(10)) * 10
    else:
        bucket = F.pmod(F.xxhash64(F.col(id_col)), F.lit(100))
    return F.when(bucket < train_pct, F.lit("train")).otherwise(F.lit("validation"))


# ---------------------------------------------------------------- ML1
def train_gbt(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None,
              seed: int = 42, **overrides) -> PipelineModel:
    params = {**GBT_PARAMS, **overrides}
    # Spark ML checkpoints the boosting state every ``checkpointInterval``
    # rounds into the shared folder, so a lost executor does not replay all
    # rounds and the lineage stays short.
    shared_dir(train.sparkSession)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **params)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return Pipeline(stages=[asm, gbt]).fit(train)


# ---------------------------------------------------------------- ML5
def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of the positive class, as a plain double column."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction",
                                                                        "probability", "prediction")


def fraud_labels(scored: DataFrame, score_col: str = "score") -> DataFrame:
    """P14 + P16 on model output (reference response shape)."""
    return scored.withColumns({
        "fraud_score": RU.round_half_up(score_col, 4),
        "label": RU.fraud_label(score_col),
        "confidence": RU.fraud_confidence(score_col),
    })


def loan_labels(scored: DataFrame, score_col: str = "score") -> DataFrame:
    """P15 + P16 on model output."""
    return scored.withColumns({
        "probability": RU.percent_1dp(score_col),
        "risk_level": RU.loan_risk_level(score_col),
        "recommendation": RU.loan_recommendation(score_col),
    })


# ---------------------------------------------------------------- ML3
def rank_sum_auc(df: DataFrame, score: str, label: str, positive: int = 1) -> DataFrame:
    """The exact area under the ROC curve, one row (positives, negatives, auc):
    the share of (positive, negative) pairs that the score puts in order, ties
    counting half. Rows without a score or a label are left out; without a
    positive or a negative the area is null.

    Ranks are a prefix sum in two levels: rows are first reduced to counts per
    different score, those are cut into score ranges and settled, every range
    gets the negatives before it (one row per range), and the running sum goes
    on inside a range. No task sees more than its range."""
    spark = df.sparkSession
    good = F.col(label) == positive
    per = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("_s")).agg(
        F.count_if(good).alias("_p"), F.count_if(~good).alias("_n"))
    ranged = per.repartitionByRange("_s").withColumn("_range", F.spark_partition_id())
    path = scratch_path(spark, "auc")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    up_to = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(F.sum("_n").alias("_in"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_in").over(up_to.orderBy("_range")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("_n").over(up_to.partitionBy("_range").orderBy("_s")), F.lit(0))
    ranked = ranged.withColumn("_inside", inside).join(ranges, "_range")
    # twice the pairs in order, as integers: negatives below count two, equal ones one
    twice = F.col("_p").cast("decimal(19,0)") * (2 * (F.col("_before") + F.col("_inside")) + F.col("_n")).cast("decimal(19,0)")
    total = ranked.agg(F.coalesce(F.sum("_p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("_n"), F.lit(0)).alias("negatives"), F.sum(twice).alias("_twice"))
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return total.select("positives", "negatives", F.when(pairs > 0, F.col("_twice").cast("double") / pairs).alias("auc"))


def auc(model: PipelineModel, df: DataFrame, label: str) -> float:
    """The exact validation AUC of a model."""
    return rank_sum_auc(score(model, df, "_auc_score"), "_auc_score", label).first()["auc"]


# ---------------------------------------------------------------- ML6
def scored_audit(scored: DataFrame, scored_at: Column | None = None) -> DataFrame:
    """Inputs + outputs + scoring time + date partition, for an append-only
    audit table (``sinks.lake.write_partitioned(..., ['date'])``)."""
    ts = F.current_timestamp() if scored_at is None else scored_at
    return scored.withColumn("scored_at", ts).withColumn("date", F.date_format(ts, "yyyy-MM-dd"))
