"""Record-level operators on the driver tables: cleaning (P*), rules, contracts
and routing (F5-F7), dedup (D1, D2), keyed changes (M1-M4, K3) and the
stream envelope (S7, S12).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import contracts as K
from ..functions import features as X
from ..functions import rules as RU
from ..operators import changes as M
from ..operators.dedup import dedup_by_key, dedup_rows
from ..session import read_table
from .jobs import sales_etl
from .registry import query
from .tables import transactions_from_events

LINEITEM_REST = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                 "l_returnflag, l_linestatus, l_shipdate")


# ---------------------------------------------------------------- P2-P5
# The raw file has what a landing has: text everywhere, odd header names, a
# missing id, amounts, quantities and dates that do not parse, padded text.
# The same CASEs make them in the twin.
_RAW_SALES = """
SELECT CASE WHEN l_linenumber <> 6 THEN concat_ws('-', l_orderkey, l_linenumber) END AS transaction_id,
       CAST(l_suppkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN l_orderkey % 5 = 0 THEN '  Part ' || l_partkey || ' ' ELSE 'Part' END AS product_name,
       CASE WHEN l_orderkey % 10 = 1 THEN 'two' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN l_orderkey % 10 = 2 THEN NULL WHEN l_orderkey % 20 = 3 THEN 'oops' ELSE '1' END AS amount_kind, l_extendedprice,
       CASE WHEN l_orderkey % 20 = 4 THEN '2024-13-45' WHEN l_orderkey % 20 = 5 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS sale_date,
       CASE WHEN l_orderkey % 3 = 0 THEN '  ' || l_returnflag || ' ' ELSE l_returnflag END AS category, l_linestatus AS payment_method
FROM lineitem"""


def raw_sales(spark, sf):
    li = read_table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    text = lambda c: F.col(c).cast("string")
    return li.select(
        F.when(F.col("l_linenumber") != 6, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias(" Transaction-ID "),
        text("l_suppkey").alias("Store ID"), text("l_partkey").alias("product-id"),
        F.when(k % 5 == 0, F.concat(F.lit("  Part "), text("l_partkey"), F.lit(" "))).otherwise("Part").alias("Product Name"),
        F.when(k % 10 == 1, "two").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Quantity"),
        text("l_extendedprice").alias("unit_price"),
        F.when(k % 10 == 2, F.lit(None).cast("string")).when(k % 20 == 3, "oops").otherwise(text("l_extendedprice")).alias("amount"),
        F.when(k % 20 == 4, "2024-13-45").when(k % 20 == 5, F.lit(None).cast("string")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias(" Sale-Date "),
        F.when(k % 3 == 0, F.concat(F.lit("  "), "l_returnflag", F.lit(" "))).otherwise(F.col("l_returnflag")).alias("CATEGORY"),
        F.col("l_linestatus").alias("payment_method"))


_SALES = f"""
SELECT transaction_id, store_id, product_id, trim(product_name) AS product_name, TRY_CAST(quantity AS INTEGER) AS quantity,
       l_extendedprice AS unit_price, l_extendedprice AS amount, TRY_CAST(sale_date AS DATE) AS sale_date, lower(trim(category)) AS category,
       payment_method, strftime(TRY_CAST(sale_date AS DATE), '%Y') AS year, strftime(TRY_CAST(sale_date AS DATE), '%m') AS month,
       strftime(TRY_CAST(sale_date AS DATE), '%d') AS day
FROM ({_RAW_SALES})
WHERE transaction_id IS NOT NULL AND amount_kind = '1' AND TRY_CAST(sale_date AS DATE) IS NOT NULL"""


@query("sales_clean", _SALES, covers="P1 P2 P3 P4 P5")
def sales_clean(spark, sf):
    return sales_etl(raw_sales(spark, sf))


# ---------------------------------------------------------------- K1: one run per upload
# Two uploads with rows of the same days (line numbers 1-3 and 3-7: line 3 is in
# both), the second one twice. The lake keeps both uploads, each once.
@query("sales_two_uploads", f"""
WITH s AS (SELECT *, CAST(split_part(transaction_id, '-', 2) AS INTEGER) AS line FROM ({_SALES}))
SELECT year, month, count(*) AS tx_count, round(sum(amount), 2) AS total_revenue
FROM (SELECT * FROM s WHERE line <= 3 UNION ALL SELECT * FROM s WHERE line >= 3) GROUP BY 1, 2
""", covers="K1 T5")
def sales_two_uploads(spark, sf):
    from ..operators.reports import totals_by
    from ..session import scratch_path
    from ..sinks.lake import LOAD, load_id, read_partitioned, write_load
    path, raw = scratch_path(spark, "sales-uploads"), raw_sales(spark, sf)
    line = F.substring_index(F.col(" Transaction-ID "), "-", -1).cast("int")
    for name, part in (("a.csv", line <= 3), ("b.csv", line >= 3), ("b.csv", line >= 3)):
        write_load(sales_etl(raw.where(part)).withColumn(LOAD, load_id(F.lit(name))), path, ["year", "month", "day"])
    return totals_by(read_partitioned(spark, path), ["year", "month"], "amount", count_name="tx_count")


# ---------------------------------------------------------------- P7
_CATEGORY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Food & Beverage' WHEN '2-HIGH' THEN 'Home Appliance' WHEN '5-LOW' THEN NULL ELSE o_orderpriority END"


@query("orders_by_priority_slug", f"""
SELECT replace(replace(lower(coalesce({_CATEGORY}, '')), ' & ', '_'), ' ', '_') AS category,
       count(*) AS order_count, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1
""", covers="P7")
def orders_by_priority_slug(spark, sf):
    from ..operators.reports import totals_by
    o = read_table(spark, sf, "orders")
    return totals_by(o, [C.slug(F.expr(_CATEGORY)).alias("category")], "o_totalprice",
                     total_name="total", count_name="order_count")


# ---------------------------------------------------------------- P8, P9
@query("event_iso_roundtrip", """
WITH s AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'yesterday' WHEN event_id % 7 = 1 THEN '2024-13-01T00:00:00Z' WHEN event_id % 7 = 2 THEN ''
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS processed_at FROM events)
SELECT event_id, processed_at, CAST(TRY_CAST(processed_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_ts FROM s
""", covers="P8 P9")
def event_iso_roundtrip(spark, sf):
    ev = read_table(spark, sf, "events")
    k = F.col("event_id") % 7
    stamped = ev.select("event_id", F.when(k == 0, "yesterday").when(k == 1, "2024-13-01T00:00:00Z").when(k == 2, "")
                        .otherwise(C.iso_stamp(F.col("ts"))).alias("processed_at"))
    return stamped.withColumn("event_ts", C.parse_iso_timestamp("processed_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------- P10-P12, P17
_TX_SQL = """
WITH d AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_day,
         count(*) FILTER (WHERE event_type = 'error') AS err_day
  FROM events GROUP BY 1, 2),
u AS (
  SELECT user_id, day, n_day,
         coalesce(sum(err_day) OVER (PARTITION BY user_id ORDER BY day
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_err,
         min(day) OVER (PARTITION BY user_id) AS first_day
  FROM d),
tx AS (
  SELECT CASE WHEN e.event_id % 40 = 9 THEN NULL ELSE CAST(e.event_id AS VARCHAR) END AS transaction_id, e.event_id,
         CASE WHEN e.event_id % 40 = 1 THEN 0 ELSE e.value END AS amount,
         CASE WHEN e.event_id % 40 = 10 THEN NULL ELSE
           (['grocery', 'Electronics', 'RESTAURANT', 'gas', 'travel', 'online', e.event_type])[1 + CAST(e.event_id % 7 AS INTEGER)] END AS merchant_category,
         CASE WHEN e.event_id % 40 = 2 THEN 24 ELSE hour(e.ts) END AS hour_of_day,
         CASE WHEN e.event_id % 40 = 3 THEN -1 ELSE isodow(e.ts) - 1 END AS day_of_week,
         CASE WHEN e.event_id % 40 = 4 THEN -1 ELSE CAST(date_diff('day', u.first_day, CAST(e.ts AS DATE)) AS INTEGER) END AS user_account_age_days,
         CASE WHEN e.event_id % 40 = 5 THEN NULL ELSE CAST(u.prior_err AS INTEGER) END AS previous_fraud_count,
         CASE WHEN e.event_id % 40 = 6 THEN -0.5 ELSE CAST(json_extract_string(e.props, '$.k') AS DOUBLE) END AS distance_from_home_km,
         CASE WHEN e.event_id % 40 = 7 THEN 2 WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) >= 90 THEN 1 ELSE 0 END AS is_foreign_transaction,
         CASE WHEN e.event_id % 40 = 8 THEN 0 ELSE CAST(u.n_day AS INTEGER) END AS transaction_frequency_24h
  FROM events e JOIN u ON e.user_id = u.user_id AND CAST(e.ts AS DATE) = u.day),
f AS (
  SELECT event_id, transaction_id,
         round(ln(1 + amount), 9) AS amount_log,
         CAST(coalesce(CASE lower(coalesce(merchant_category, 'online'))
            WHEN 'grocery' THEN 0 WHEN 'electronics' THEN 1 WHEN 'restaurant' THEN 2
            WHEN 'gas' THEN 3 WHEN 'travel' THEN 4 WHEN 'online' THEN 5 END, 5) AS INTEGER) AS merchant_cat_encoded,
         CAST(hour_of_day AS INTEGER) AS hour_of_day, CAST(day_of_week AS INTEGER) AS day_of_week,
         user_account_age_days AS account_age_days, previous_fraud_count AS prev_fraud_count,
         round(ln(1 + distance_from_home_km), 9) AS distance_km_log,
         is_foreign_transaction AS is_foreign, transaction_frequency_24h AS tx_freq_24h,
         array_to_string(list_filter([
            CASE WHEN NOT coalesce(amount > 0, false) THEN 'amount_not_positive' END,
            CASE WHEN NOT coalesce(hour_of_day BETWEEN 0 AND 23, false) THEN 'hour_out_of_range' END,
            CASE WHEN NOT coalesce(day_of_week BETWEEN 0 AND 6, false) THEN 'weekday_out_of_range' END,
            CASE WHEN NOT coalesce(user_account_age_days >= 0, false) THEN 'account_age_negative' END,
            CASE WHEN NOT coalesce(previous_fraud_count >= 0, false) THEN 'fraud_count_negative' END,
            CASE WHEN NOT coalesce(distance_from_home_km >= 0, false) THEN 'distance_negative' END,
            CASE WHEN NOT coalesce(is_foreign_transaction BETWEEN 0 AND 1, false) THEN 'foreign_flag_not_0_1' END,
            CASE WHEN NOT coalesce(transaction_frequency_24h >= 1, false) THEN 'frequency_below_1' END,
            CASE WHEN transaction_id IS NULL THEN 'transaction_id_missing' END,
            CASE WHEN merchant_category IS NULL THEN 'merchant_category_missing' END],
            lambda x: x IS NOT NULL), ',') AS errors
  FROM tx)
SELECT * FROM f
"""


@query("transaction_features", _TX_SQL, covers="P10 P11 P12 P17 ML-features")
def transaction_features(spark, sf):
    tx = transactions_from_events(spark, sf)
    k = F.col("transaction_id").cast("long")
    at = k % 40
    case = lambda n, bad, c: F.when(at == n, F.lit(bad)).otherwise(F.col(c)).alias(c)
    kinds = F.array(*[F.lit(m) for m in ("grocery", "Electronics", "RESTAURANT", "gas", "travel", "online")], F.col("merchant_category"))
    tx = tx.select(
        k.alias("event_id"), case(9, None, "transaction_id"), case(1, 0, "amount"),
        F.when(at != 10, F.get(kinds, (k % 7).cast("int"))).alias("merchant_category"),
        case(2, 24, "hour_of_day"), case(3, -1, "day_of_week"), case(4, -1, "user_account_age_days"), case(5, None, "previous_fraud_count"),
        case(6, -0.5, "distance_from_home_km"), case(7, 2, "is_foreign_transaction"), case(8, 0, "transaction_frequency_24h"))
    checked = tx.withColumn("_errors", K.violations(K.transaction_rules()))
    feats = X.fraud_features(checked, keep=("event_id", "transaction_id", "_errors"))
    feats = feats.withColumns({"amount_log": F.round("amount_log", 9), "distance_km_log": F.round("distance_km_log", 9)})
    return feats.select("event_id", "transaction_id", *X.FRAUD_FEATURES, F.array_join("_errors", ",").alias("errors"))


# ---------------------------------------------------------------- P13
@query("score_pass_fail", """
SELECT event_id AS id, CAST(floor(value) AS INTEGER) AS score,
       CASE WHEN CAST(floor(value) AS INTEGER) >= 75 THEN 'PASS' ELSE 'FAIL' END AS status
FROM events
""", covers="P13")
def score_pass_fail(spark, sf):
    ev = read_table(spark, sf, "events")
    s = ev.select(F.col("event_id").alias("id"), F.floor("value").cast("int").alias("score"))
    return s.withColumn("status", RU.pass_fail("score"))


# ---------------------------------------------------------------- P14, P16
@query("fraud_score_labels", """
SELECT round(l_discount * 10, 4) AS fraud_score,
       CASE WHEN l_discount * 10 >= 0.3 THEN 'FRAUD' ELSE 'NORMAL' END AS label,
       CASE WHEN l_discount * 10 >= 0.7 THEN 'HIGH' WHEN l_discount * 10 >= 0.3 THEN 'MEDIUM'
            WHEN l_discount * 10 >= 0.15 THEN 'LOW' ELSE 'HIGH' END AS confidence,
       count(*) AS n
FROM lineitem GROUP BY ALL
""", covers="P14 P16")
def fraud_score_labels(spark, sf):
    li = read_table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("s"))
    out = li.select(RU.round_half_up("s", 4).alias("fraud_score"), RU.fraud_label("s").alias("label"),
                    RU.fraud_confidence("s").alias("confidence"))
    return out.groupBy("fraud_score", "label", "confidence").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P15, P16
@query("loan_risk_bands", """
SELECT round((l_discount + l_tax) * 5 * 100, 1) AS probability,
       CASE WHEN (l_discount + l_tax) * 5 < 0.30 THEN 'LOW' WHEN (l_discount + l_tax) * 5 < 0.55 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
       CASE WHEN (l_discount + l_tax) * 5 < 0.30 THEN 'Approved — Standard loan terms apply'
            WHEN (l_discount + l_tax) * 5 < 0.55 THEN 'Conditional Approval — Additional review required'
            ELSE 'Rejected — Default risk exceeds acceptance threshold' END AS recommendation,
       count(*) AS n
FROM lineitem GROUP BY ALL
""", covers="P15 P16")
def loan_risk_bands(spark, sf):
    p = read_table(spark, sf, "lineitem").select(((F.col("l_discount") + F.col("l_tax")) * 5).alias("p"))
    out = p.select(RU.percent_1dp("p").alias("probability"), RU.loan_risk_level("p").alias("risk_level"),
                   RU.loan_recommendation("p").alias("recommendation"))
    return out.groupBy("probability", "risk_level", "recommendation").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P23
@query("page_url_keys", """
SELECT page_id, string_split(url, '/')[-1] AS basename,
       'log-' || CAST(page_id AS VARCHAR) || '.json' AS log_key,
       substring(url, 1, 10) AS prefix10
FROM pages
""", covers="P23")
def page_url_keys(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", RU.basename("url").alias("basename"), RU.incident_log_key("page_id").alias("log_key"),
                    RU.date_prefix("url").alias("prefix10"))


# ---------------------------------------------------------------- P24 (the text is the engine's own; what it says is not)
@query("event_json_lines", """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS value, event_id % 5 = 0 AS value_left_out FROM events
""", covers="P24")
def event_json_lines(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    lines = ev.select(RU.to_json_line("event_id", "user_id", "event_type", "value").alias("json"))
    back = F.from_json("json", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE").alias("r")
    return lines.select(back, (~F.col("json").contains('"value"')).alias("value_left_out")).select("r.*", "value_left_out")


# ---------------------------------------------------------------- F5 (+P22 alert text, P23 log key)
def _incidents(spark, sf):
    ev = read_table(spark, sf, "events")
    sev = (F.when(F.col("event_type") == "error", F.lit("HIGH"))
           .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
           .when(F.col("event_type") == "purchase", F.lit("high"))
           .otherwise(F.lit("LOW")))
    return ev.select(F.col("event_id").alias("id"), F.col("props").alias("message"), sev.alias("severity"))


@query("incident_routing", """
WITH i AS (
  SELECT event_id AS id, props AS message,
         CASE WHEN event_type = 'error' THEN 'HIGH' WHEN event_type = 'signup' THEN NULL
              WHEN event_type = 'purchase' THEN 'high' ELSE 'LOW' END AS severity
  FROM events)
SELECT id, severity,
       CASE WHEN coalesce(severity = 'HIGH', false) THEN 'alert' ELSE 'log' END AS route,
       CASE WHEN coalesce(severity = 'HIGH', false) THEN 'High severity incident: {"id":' || id || ',"message":' || to_json(message) || ',"severity":"HIGH"}' END AS alert_text,
       CASE WHEN NOT coalesce(severity = 'HIGH', false) THEN 'log-' || CAST(id AS VARCHAR) || '.json' END AS log_key
FROM i
""", covers="F5 P22 P23")
def incident_routing(spark, sf):
    from ..operators.routing import route_by_severity
    return route_by_severity(_incidents(spark, sf)).select("id", "severity", "route", "alert_text", "log_key")


# ---------------------------------------------------------------- F6 (+P17, P20)
@query("event_contract_split", """
SELECT event_id,
       array_to_string(list_filter([
         CASE WHEN NOT coalesce(value > 0, false) THEN 'value_not_positive' END,
         CASE WHEN NOT coalesce(value <= 300, false) THEN 'value_above_300' END,
         CASE WHEN NOT coalesce(event_type IN ('view', 'click', 'purchase', 'signup'), false) THEN 'unknown_event_type' END,
         CASE WHEN NOT coalesce(trim(props, chr(9) || chr(10) || chr(13) || ' ') <> '', false) THEN 'props_blank' END], lambda x: x IS NOT NULL), ',') AS errors,
       len(list_filter([
         CASE WHEN NOT coalesce(value > 0, false) THEN 'value_not_positive' END,
         CASE WHEN NOT coalesce(value <= 300, false) THEN 'value_above_300' END,
         CASE WHEN NOT coalesce(event_type IN ('view', 'click', 'purchase', 'signup'), false) THEN 'unknown_event_type' END,
         CASE WHEN NOT coalesce(trim(props, chr(9) || chr(10) || chr(13) || ' ') <> '', false) THEN 'props_blank' END], lambda x: x IS NOT NULL)) = 0 AS valid
FROM (SELECT * REPLACE (CASE WHEN event_id % 9 = 0 THEN chr(9) || chr(10) || ' ' WHEN event_id % 9 = 1 THEN NULL WHEN event_id % 9 = 2 THEN '' ELSE props END AS props) FROM events)
""", covers="F6 P17 P20")
def event_contract_split(spark, sf):
    from ..operators.routing import with_errors
    ev = read_table(spark, sf, "events")
    k = F.col("event_id") % 9
    ev = ev.withColumn("props", F.when(k == 0, "\t\n ").when(k == 1, F.lit(None).cast("string")).when(k == 2, "").otherwise(F.col("props")))
    rules = {
        "value_not_positive": F.col("value") > 0,
        "value_above_300": F.col("value") <= 300,
        "unknown_event_type": F.col("event_type").isin("view", "click", "purchase", "signup"),
        "props_blank": C.non_blank("props"),
    }
    checked = with_errors(ev, rules)
    return checked.select("event_id", F.array_join("errors", ",").alias("errors"), F.col("valid"))


# ---------------------------------------------------------------- F7 / T4
_BAD_PROPS = """CASE event_id % 11 WHEN 0 THEN '{broken' WHEN 1 THEN '{"k": "x"}' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '{"source": 1}' WHEN 5 THEN '[1]' ELSE props END"""


@query("event_props_parse", f"""
WITH e AS (SELECT event_id, {_BAD_PROPS} AS props FROM events),
j AS (SELECT event_id, CASE WHEN json_valid(props) THEN props END AS props FROM e)
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL AS failed
FROM j
""", covers="F7")
def event_props_parse(spark, sf):
    from ..sources.envelope import parse_json_isolated
    ev = read_table(spark, sf, "events").select("event_id", F.expr(_BAD_PROPS).alias("props"))
    parsed = parse_json_isolated(ev, "props", "k INT")
    return parsed.select("event_id", F.col("parsed.k").alias("k"), F.col("failed"))


# ---------------------------------------------------------------- S7
# Of eleven records one is not base64, one not UTF-8, one not JSON, one has a
# value of the wrong type and one is null; none of them stops the others.
@query("envelope_decode", """
SELECT CAST(event_id AS VARCHAR) AS sequence_number,
       CASE WHEN event_id % 11 > 4 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       event_type AS category, event_id % 11 <= 4 AS failed
FROM events
""", covers="S7 F7 ST4")
def envelope_decode(spark, sf):
    from ..sources.envelope import decode_envelope, encode_envelope
    ev = read_table(spark, sf, "events")
    env = encode_envelope(ev, seq="event_id", payload="props", extra=("event_type",))
    k = F.col("sequence_number").cast("long") % 11
    env = env.withColumn("data", F.when(k == 0, "%%%").when(k == 1, F.base64(F.unhex(F.lit("7B226BC328")))).when(k == 2, F.base64(F.lit("{broken").cast("binary")))
                         .when(k == 3, F.base64(F.lit('{"k": "x"}').cast("binary"))).when(k == 4, F.lit(None).cast("string")).otherwise(F.col("data")))
    dec = decode_envelope(env, "k INT")
    return dec.select("sequence_number", F.col("record.k").alias("k"), F.col("event_type").alias("category"), "failed")


# ---------------------------------------------------------------- S12
@query("sales_partitions", f"""
SELECT DISTINCT year, month, day FROM ({_SALES})
""", covers="S12")
def sales_partitions(spark, sf):
    """The partitions of the sales lake, from its listing: no file is read."""
    from ..sources.catalog import listed_partitions
    return listed_partitions(spark, _sales_lake(spark, sf), ["year", "month", "day"])


# ---------------------------------------------------------------- D1
@query("lineitem_dedup_by_key", f"""
SELECT l_orderkey, l_linenumber, {LINEITEM_REST} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_REST}) AS rn
  FROM lineitem) WHERE rn = 1
""", covers="D1")
def lineitem_dedup_by_key(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return dedup_by_key(li, ["l_orderkey", "l_linenumber"], required=["l_orderkey", "l_linenumber", "l_extendedprice"])


# ---------------------------------------------------------------- D2
@query("user_day_activity", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
""", covers="D2")
def user_day_activity(spark, sf):
    ev = read_table(spark, sf, "events")
    return dedup_rows(ev.select("user_id", "event_type", F.to_date("ts").alias("day")))


# ---------------------------------------------------------------- M1 / K3
_DESC = ", ".join(c.strip() + " DESC" for c in LINEITEM_REST.split(","))


@query("lineitem_upsert", f"""
SELECT l_orderkey, l_linenumber, {LINEITEM_REST} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY src DESC, {_DESC}) AS rn
  FROM (SELECT *, 0 AS src FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
        UNION ALL
        SELECT *, 1 AS src FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'))
WHERE rn = 1
""", covers="M1")
def lineitem_upsert(spark, sf, cutover: str = "1998-01-01"):
    li = read_table(spark, sf, "lineitem")
    cut = F.lit(cutover).cast("timestamp_ntz")
    base, changes = li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)
    return M.upsert(base, changes, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- M2
@query("lineitem_delete_finished", """
SELECT l.* FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
""", covers="M2")
def lineitem_delete_finished(spark, sf):
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders")
    deletes = o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return M.delete_keys(li, deletes, ["l_orderkey"])


# ---------------------------------------------------------------- M3
@query("part_partial_update", """
WITH u AS (
  SELECT p_partkey AS id,
         CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN '' WHEN p_size % 4 = 2 THEN ' ' || chr(9) || ' '
              ELSE chr(9) || ' ' || upper(p_name) || chr(10) END AS name,
         p_brand AS description, p_size % 3 = 0 AS has_description
  FROM part WHERE p_size > 40)
SELECT p.p_partkey AS id,
       CASE WHEN u.id IS NOT NULL THEN trim(coalesce(nullif(u.name, ''), p.p_name), chr(9) || chr(10) || chr(13) || ' ') ELSE p.p_name END AS name,
       CASE WHEN coalesce(u.has_description, false) THEN u.description ELSE p.p_type END AS description
FROM part p LEFT JOIN u ON p.p_partkey = u.id
""", covers="M3")
def part_partial_update(spark, sf):
    part = read_table(spark, sf, "part")
    base = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"))
    m = F.col("p_size") % 4
    updates = part.where(F.col("p_size") > 40).select(
        F.col("p_partkey").alias("id"),
        F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("")).when(m == 2, F.lit(" \t "))
         .otherwise(F.concat(F.lit("\t "), F.upper("p_name"), F.lit("\n"))).alias("name"),
        F.col("p_brand").alias("description"), (F.col("p_size") % 3 == 0).alias("has_description"))
    return M.partial_update(base, updates, "id")


# ---------------------------------------------------------------- M4
@query("user_snapshot", """
SELECT user_id, ts, event_id, event_type, value, props, op FROM (
  SELECT *, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1 AND op <> 'delete'
""", covers="M4")
def user_snapshot(spark, sf):
    ev = read_table(spark, sf, "events")
    log = ev.withColumn("op", F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert")))
    return M.fold_changelog(log, ["user_id"], seq=["ts", "event_id"])


# ---------------------------------------------------------------- K3: the keyed store itself
@query("lineitem_keyed_store", f"""
SELECT l_orderkey, l_linenumber, {LINEITEM_REST} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_DESC}) AS rn FROM lineitem) WHERE rn = 1
""", covers="K3 M1")
def lineitem_keyed_store(spark, sf):
    """Two overlapping batches, the later one twice, upserted into a store."""
    from ..session import scratch_path
    from ..sinks.keyed import read_current, upsert_into
    path, li = scratch_path(spark, "lineitem-store"), read_table(spark, sf, "lineitem")
    cut = lambda d: F.lit(d).cast("timestamp_ntz")
    late = li.where(F.col("l_shipdate") >= cut("1997-01-01"))
    for batch in (li.where(F.col("l_shipdate") < cut("1998-01-01")), late, late):
        upsert_into(spark, path, batch, ["l_orderkey", "l_linenumber"], seq="l_shipdate", buckets=16)
    return read_current(spark, path)


# ---------------------------------------------------------------- K1 (read-back, T3, F1)
def _sales_lake(spark, sf):
    """The clean sales as Parquet partitioned year/month/day in the shared folder."""
    from ..session import scratch_path
    from ..sinks.lake import write_partitioned
    path = scratch_path(spark, "sales-lake")
    write_partitioned(sales_clean(spark, sf), path, ["year", "month", "day"], mode="replace")
    return path


@query("sales_lake_roundtrip", f"""
SELECT year, month, count(*) AS tx_count, round(sum(amount), 2) AS total_revenue FROM ({_SALES}) GROUP BY 1, 2
""", covers="K1 T3")
def sales_lake_roundtrip(spark, sf):
    """Clean sales -> partitioned lake -> read back (partition values stay
    strings) -> monthly totals."""
    from ..operators.reports import totals_by
    from ..sinks.lake import read_partitioned
    return totals_by(read_partitioned(spark, _sales_lake(spark, sf)), ["year", "month"], "amount", count_name="tx_count")


@query("sales_partition_filter", f"""
SELECT day, count(*) AS tx_count, round(sum(amount), 2) AS total_revenue FROM ({_SALES}) WHERE year = '1998' AND month = '01' GROUP BY 1
""", covers="F1")
def sales_partition_filter(spark, sf, year: str = "1998", month: str = "01"):
    """One month of the lake: the filters choose folders, no other is read."""
    from ..operators.reports import totals_by
    from ..sinks.lake import read_partitioned
    lake = read_partitioned(spark, _sales_lake(spark, sf))
    return totals_by(lake.where((F.col("year") == year) & (F.col("month") == month)), ["day"], "amount", count_name="tx_count")


# ---------------------------------------------------------------- P18 / U2
REQUIRED_PROP_KEYS = ["k", "source"]


@query("event_missing_fields", """
SELECT event_id,
       array_to_string(list_filter(['k', 'source'], lambda x: NOT list_contains(coalesce(json_keys(props), []), x)), ',') AS missing,
       CAST(len(list_filter(['k', 'source'], lambda x: NOT list_contains(coalesce(json_keys(props), []), x))) AS INTEGER) AS n_missing
FROM events
""", covers="P18 U2")
def event_missing_fields(spark, sf):
    ev = read_table(spark, sf, "events")
    missing = K.missing_keys("props", REQUIRED_PROP_KEYS)
    return ev.select("event_id", F.array_join(missing, ",").alias("missing"), F.size(missing).alias("n_missing"))
