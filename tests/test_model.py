"""Boosted trees: train, AUC on a held-out split, labels on scores."""

from pyspark.sql import functions as F

from tidewater.operators import model as ML


def test_train_score_label(spark):
    rows = [(i, float(i % 17), float((i * 7) % 11), 1 if (i % 17) > 10 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    df = df.withColumns({"split": ML.split_flag("id", 80), "w": ML.class_weight("y", 3)})
    train, val = df.where(F.col("split") == "train"), df.where(F.col("split") == "validation")
    assert 0.7 < train.count() / 400 < 0.9
    model = ML.train_gbt(train, ["a", "b"], "y", weight="w", maxIter=10)
    assert ML.auc(model, val, "y") > 0.95
    scored = ML.loan_labels(ML.fraud_labels(ML.score(model, val)))
    r = scored.select("score", "label", "risk_level").collect()
    assert all(0.0 <= x.score <= 1.0 for x in r)
    assert {x.label for x in r} <= {"FRAUD", "NORMAL"} and {x.risk_level for x in r} <= {"LOW", "MEDIUM", "HIGH"}
