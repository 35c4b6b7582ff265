"""Scalar rules, features and contracts."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.functions import clean as C
from tidewater.functions import contracts as K
from tidewater.functions import features as X
from tidewater.functions import rules as RU


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_fraud_label_boundaries(spark):
    scores = [(0.1499,), (0.15,), (0.2999,), (0.3,), (0.6999,), (0.7,)]
    got = spark.createDataFrame(scores, "s double").select(RU.fraud_label("s"), RU.fraud_confidence("s")).collect()
    assert [tuple(r) for r in got] == [("NORMAL", "HIGH"), ("NORMAL", "LOW"), ("NORMAL", "LOW"),
                                       ("FRAUD", "MEDIUM"), ("FRAUD", "MEDIUM"), ("FRAUD", "HIGH")]


def test_loan_band_boundaries(spark):
    got = _one(spark, RU.loan_risk_level("p"), [(0.2999,), (0.30,), (0.5499,), (0.55,)], "p double")
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]
    rec = _one(spark, RU.loan_recommendation("p"), [(0.1,)], "p double")
    assert rec == [RU.LOAN_RECOMMENDATION["LOW"]]
    assert _one(spark, RU.percent_1dp("p"), [(0.12345,)], "p double") == [12.3]


def test_pass_fail(spark):
    assert _one(spark, RU.pass_fail("s"), [(74,), (75,), (80,), (60,), (90,), (None,)], "s int") == \
        ["FAIL", "PASS", "PASS", "FAIL", "PASS", None]


def test_slug(spark):
    vals = [("Food & Beverage",), ("Home Appliance",), ("Electronics",), (None,), ("4-NOT SPECIFIED",)]
    assert _one(spark, C.slug("c"), vals, "c string") == \
        ["food_beverage", "home_appliance", "electronics", "", "4-not_specified"]


def test_status_badges(spark):
    vals = [("completed",), ("SUCCESS",), ("failed",), ("error",), ("processing",), ("processed",), (None,)]
    assert _one(spark, RU.status_badge("s"), vals, "s string") == \
        ["success", "success", "error", "error", "info", "warning", "warning"]


def test_fraud_feature_golden(spark):
    payload = {"transaction_id": "txn-test-001", "amount": 4500000.0, "merchant_category": "electronics",
               "hour_of_day": 2, "day_of_week": 0, "user_account_age_days": 45, "previous_fraud_count": 1,
               "distance_from_home_km": 1200.0, "is_foreign_transaction": 1, "transaction_frequency_24h": 18}
    df = spark.createDataFrame([payload])
    feats = X.fraud_features(df)
    text = feats.select(F.concat_ws(",", *[F.format_string("%.2f", c) if c.endswith("_log") else F.col(c).cast("string")
                                          for c in X.FRAUD_FEATURES])).first()[0]
    assert text == "15.32,1,2,0,45,1,7.09,1,18"


def test_dict_encode_unknown_and_case(spark):
    vals = [("Travel",), ("unknown",), (None,), ("GAS",)]
    assert _one(spark, X.dict_encode("m", X.MERCHANT_ENCODING, 5), vals, "m string") == [4, 5, 5, 3]


def test_transaction_contract(spark):
    good = {"transaction_id": "a", "amount": 1.0, "merchant_category": "gas", "hour_of_day": 23, "day_of_week": 6,
            "user_account_age_days": 0, "previous_fraud_count": 0, "distance_from_home_km": 0.0,
            "is_foreign_transaction": 1, "transaction_frequency_24h": 1}
    bad = dict(good, amount=0.0, hour_of_day=24, transaction_frequency_24h=0)
    df = spark.createDataFrame([good, bad])
    errs = [r[0] for r in df.select(K.violations(K.transaction_rules())).collect()]
    assert errs[0] == []
    assert set(errs[1]) == {"amount_not_positive", "hour_out_of_range", "frequency_below_1"}


def test_required_keys_and_non_empty(spark):
    docs = [(json.dumps({"filename": "a.json", "data": [1]}),), (json.dumps({"data": []}),),
            ("[1,2]",), ("not json",), (json.dumps({"filename": "b", "data": "x"}),)]
    df = spark.createDataFrame(docs, "j string")
    got = df.select(K.missing_keys("j", ["filename", "data"]), K.non_empty_json_array("j")).collect()
    assert [tuple(r) for r in got] == [([], True), (["filename"], False), (["filename", "data"], False),
                                       (["filename", "data"], False), ([], False)]


def test_basename_and_keys(spark):
    df = spark.createDataFrame([("data/sales/2024/file.csv", "evt-001", "2024-01-15T08:30:00+00:00")], "p string, i string, t string")
    r = df.select(RU.basename("p"), RU.incident_log_key("i"), RU.date_prefix("t")).first()
    assert tuple(r) == ("file.csv", "log-evt-001.json", "2024-01-15")


@pytest.mark.parametrize("text", ["2024-01-15T08:30:00Z", "2024-01-15T08:30:00+00:00", "2024-01-15 08:30:00"])
def test_iso_parse(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(C.parse_iso_timestamp("t").cast("timestamp_ntz")).first()[0]
    assert r.isoformat() == "2024-01-15T08:30:00"


def test_bad_cast_is_null_not_error(spark):
    df = spark.createDataFrame([("abc", "2024-13-45"), ("1.5", "2024-01-02")], "a string, d string")
    r = df.select(C.enforce("a", "double"), C.enforce("d", "date", "yyyy-MM-dd")).collect()
    assert r[0][0] is None and r[0][1] is None and r[1][0] == 1.5


def test_column_name_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int")
    with pytest.raises(ValueError):
        C.normalize_column_names(df)
