"""Batch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.oracle_parts import (
    ALERT_PARTS, ALERT_PROFILE, ENRICHED, LABELLED, MERCH_PARTS, SEVERITY_RANK,
    TXN_PARTS, TXN_PROFILE, history, latest,
)
from crosscheck.registry import query
from crosscheck.views import Views, duckdb_with
from riskloom.functions import privacy, risk, text
from riskloom.operators import audit, contract, history as hist, joins, profiles, rules
from riskloom.schemas import CONTRACTS, struct
from riskloom.plans import silver
from riskloom.sources.events import parse_events
from riskloom.sources.registry import SEVERITIES, SOURCES

NTZ = "timestamp_ntz"
# splits the customer feed into what a history already holds and what arrives next
CUT = "1999-01-01"
TRACKED = ["customer_risk_tier", "kyc_status"]
SALT = "pepper-7"


# shared frames

def typed_alerts(v: Views) -> DataFrame:
    return v.alerts_raw.withColumn(
        "alert_timestamp", text.parse_timestamp("alert_timestamp", zoned=False))


def alerts(v: Views) -> DataFrame:
    return hist.dedup_any(
        rules.split_fraud_alerts(typed_alerts(v)).clean, ["alert_id"]).drop("silver_processed_at")


def merchants(v: Views) -> DataFrame:
    clean = rules.split_merchants(v.merch_raw).clean.drop("silver_processed_at")
    return hist.dedup_latest(clean, ["merchant_id"], ["ver"]).drop("ver")


def enriched(v: Views) -> DataFrame:
    return joins.fx_enrich(v.txn, v.fx)


def customer_history(feed: DataFrame) -> DataFrame:
    return hist.scd2_from_feed(feed, ["customer_id"], TRACKED, "effective_date", ["seq"])


def clean_transactions(v: Views) -> DataFrame:
    return rules.split_transactions(v.txn_raw, timestamp_type=NTZ).clean


# events and scalar functions

@query("parse_json_events", """
SELECT props ->> '$.k' AS k, props AS raw_payload, event_id AS event_offset FROM events""")
def _(v):
    bus = v.table("events").select(F.col("props").cast("binary").alias("value"),
                                   F.col("event_id").alias("offset"))
    return parse_events(bus, struct("k string"), stamp=False)


@query("table_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(v):
    return v.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("standardise_text", duckdb_with("txn_raw") + """
SELECT transaction_id, upper(trim(currency)) AS currency, upper(trim(channel)) AS channel,
  upper(trim(transaction_status)) AS transaction_status FROM txn_raw""")
def _(v):
    return text.standardise_columns(
        v.txn_raw.select("transaction_id", "currency", "channel", "transaction_status"),
        "currency", "channel", "transaction_status")


@query("parse_timestamp", duckdb_with("txn_raw") + """
SELECT transaction_id, transaction_timestamp AS given,
  TRY_CAST(transaction_timestamp AS TIMESTAMP) AS parsed FROM txn_raw""")
def _(v):
    return v.txn_raw.select(
        "transaction_id", F.col("transaction_timestamp").alias("given"),
        text.parse_timestamp("transaction_timestamp", zoned=False).alias("parsed"))


@query("typed_casts", duckdb_with("txn_raw") + """
SELECT transaction_id, TRY_CAST(amount AS DOUBLE) AS amount,
  CAST(CAST(ingestion_timestamp AS DATE) AS VARCHAR) AS ingestion_date,
  CAST(ingestion_timestamp AS VARCHAR) AS ingestion_text,
  CASE currency WHEN 'CAD' THEN TRUE WHEN 'USD' THEN FALSE END AS flag FROM txn_raw""")
def _(v):
    flag = F.when(F.col("currency") == "CAD", "true").when(F.col("currency") == "USD", "false")
    return v.txn_raw.select(
        "transaction_id", text.typed("amount", "double").alias("amount"),
        text.typed("ingestion_timestamp", "date").alias("ingestion_date"),
        text.typed("ingestion_timestamp", "string").alias("ingestion_text"),
        text.typed(flag, "boolean").alias("flag"))


@query("drop_bronze_metadata", duckdb_with("merch_raw") + "SELECT * EXCLUDE (ver) FROM merch_raw")
def _(v):
    landed = v.merch_raw.withColumn("source_file", F.lit("merchants.csv"))
    return text.drop_columns(landed, "source_file", "load_id", "raw_payload", "ver")


@query("require_not_null", duckdb_with("txn_raw") + """
SELECT * FROM txn_raw WHERE transaction_id IS NOT NULL AND merchant_id IS NOT NULL
  AND currency IS NOT NULL""")
def _(v):
    return text.require_not_null(v.txn_raw, ["transaction_id", "merchant_id", "currency"])


@query("amount_cad", duckdb_with("txn", "fx", enriched=ENRICHED)
       + "SELECT transaction_id, amount_cad FROM enriched")
def _(v):
    return enriched(v).select("transaction_id", "amount_cad")


@query("amount_risk_label", duckdb_with("txn_raw") + """
SELECT transaction_id, amount, CASE WHEN TRY_CAST(amount AS DOUBLE) >= 5000 THEN 'HIGH'
  WHEN TRY_CAST(amount AS DOUBLE) >= 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM txn_raw""")
def _(v):
    return v.txn_raw.select("transaction_id", "amount", risk.amount_risk_label(
        text.typed("amount", "double")).alias("risk_level"))


@query("severity_rank", duckdb_with(**ALERT_PARTS) + f"""
SELECT alert_id, alert_severity, {SEVERITY_RANK} AS severity_rank FROM (
  SELECT alert_id, upper(trim(alert_severity)) AS alert_severity FROM alerts_raw)""")
def _(v):
    return text.standardise_columns(
        v.alerts_raw.select("alert_id", "alert_severity"), "alert_severity"
    ).withColumn("severity_rank", risk.severity_rank())


@query("customer_risk_flag", duckdb_with("cust_feed", latest=latest("cust_feed"),
                                         **ALERT_PARTS, raised=ALERT_PROFILE) + """
SELECT c.customer_id, customer_risk_tier, a.alert_count,
  CASE WHEN customer_risk_tier = 'HIGH' OR a.alert_count > 0 THEN 'HIGH'
       WHEN customer_risk_tier = 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk_flag
FROM latest c LEFT JOIN raised a ON c.customer_id = a.customer_id""")
def _(v):
    current = hist.dedup_latest(v.cust_feed, ["customer_id"], ["effective_date", "seq"])
    return profiles.profile_left_joins(
        current.select("customer_id", "customer_risk_tier"), "customer_id",
        profiles.alert_profile(alerts(v)).select("customer_id", "alert_count"),
    ).withColumn("overall_risk_flag", risk.customer_risk_flag())


@query("zero_fill", duckdb_with(txn_profile=TXN_PROFILE) + """
SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS customer_id,
  coalesce(transaction_count, 0) AS transaction_count, coalesce(total_amount, 0) AS total_amount
FROM customer LEFT JOIN txn_profile ON customer_id = concat('C', CAST(c_custkey AS VARCHAR))""")
def _(v):
    spine = v.table("customer").select(F.concat(F.lit("C"), "c_custkey").alias("customer_id"))
    joined = profiles.profile_left_joins(
        spine, "customer_id",
        v.txn.groupBy("customer_id").agg(F.count("*").alias("transaction_count"),
                                         F.sum("amount").alias("total_amount")))
    return text.zero_fill(joined, "transaction_count", "total_amount")


@query("hash_identifier", duckdb_with("pii") + f"""
SELECT customer_id, CASE WHEN customer_id IS NOT NULL
  THEN sha256(concat(customer_id, ':{SALT}')) END AS customer_id_hash FROM pii""")
def _(v):
    return v.pii.select("customer_id", privacy.hash_identifier("customer_id", SALT)
                        .alias("customer_id_hash"))


@query("mask_email", duckdb_with("pii")
       + "SELECT customer_id, regexp_replace(email, '^[^@]+', '***') AS email FROM pii")
def _(v):
    return v.pii.select("customer_id", privacy.mask_email("email").alias("email"))


@query("mask_phone", duckdb_with("pii")
       + "SELECT customer_id, regexp_replace(phone, '[0-9]', '*', 'g') AS phone FROM pii")
def _(v):
    return v.pii.select("customer_id", privacy.mask_digits("phone").alias("phone"))


@query("mask_customer_pii", duckdb_with("pii") + f"""
SELECT customer_id, regexp_replace(email, '^[^@]+', '***') AS email,
  regexp_replace(phone, '[0-9]', '*', 'g') AS phone,
  CASE WHEN customer_id IS NOT NULL THEN sha256(concat(customer_id, ':{SALT}')) END
    AS customer_id_hash FROM pii""")
def _(v):
    return privacy.mask_customer_pii(v.pii, SALT)


@query("batch_metadata_columns",
       "SELECT 'orders.parquet' AS source_file, 'run-1' AS load_id, count(*) AS row_count FROM orders")
def _(v):
    loaded = text.with_load_metadata(v.table("orders"), "run-1")
    # a table may be one file or a folder of part files
    name = F.regexp_extract("source_file", r"([^/]+\.parquet)", 1)
    return loaded.groupBy(name.alias("source_file"), "load_id").agg(
        F.count("*").alias("row_count"))


@query("column_project", duckdb_with("txn")
       + "SELECT transaction_id, amount, currency FROM txn")
def _(v):
    return v.txn.select("transaction_id", "amount", "currency")


# contracts and rules

@query("contract_report", duckdb_with("txn") + """
SELECT i.*, n.batch_rows FROM (VALUES
  ('MISSING', 'card_id', 'string', NULL), ('MISSING', 'channel', 'string', NULL),
  ('MISSING', 'ingestion_timestamp', 'timestamp', NULL),
  ('MISSING', 'location_country', 'string', NULL),
  ('MISSING', 'transaction_status', 'string', NULL),
  ('UNEXPECTED', 'seq', NULL, 'int'),
  ('WRONG_TYPE', 'amount', 'string', 'double'),
  ('WRONG_TYPE', 'transaction_timestamp', 'string', 'timestamp_ntz')
) i("kind", "column", expected, actual), (SELECT count(*) AS batch_rows FROM txn) n""")
def _(v):
    batch = v.txn.withColumn("seq", F.lit(1))
    return contract.contract_report(batch, struct(CONTRACTS["transactions"]))


REQUIRED = ["customer_id", "customer_name", "kyc_status"]


@query("split_required", duckdb_with("cust_feed") + """
SELECT * FROM cust_feed WHERE customer_id IS NOT NULL AND customer_name IS NOT NULL
  AND kyc_status IS NOT NULL""".replace("SELECT *", "SELECT * REPLACE (CAST(effective_date AS VARCHAR) AS effective_date)"))
def _(v):
    return rules.split_required(v.cust_feed, REQUIRED).clean


@query("split_required_rejected", duckdb_with("txn_raw") + """
SELECT transaction_id, customer_id, merchant_id, amount, concat_ws(', ',
  CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' END,
  CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END) AS error_reason
FROM txn_raw WHERE transaction_id IS NULL OR customer_id IS NULL OR merchant_id IS NULL""")
def _(v):
    return rules.split_required(
        v.txn_raw.select("transaction_id", "customer_id", "merchant_id", "amount"),
        ["transaction_id", "customer_id", "merchant_id"]).rejected


DOMAIN_RULES = [
    {"column": "alert_severity", "op": "isin", "values": SEVERITIES,
     "error": "INVALID_ALERT_SEVERITY"},
    {"column": "alert_severity", "op": "not_null", "error": "MISSING_ALERT_SEVERITY"},
    {"column": "alert_timestamp", "op": "not_null", "error": "INVALID_ALERT_TIMESTAMP"},
]
DOMAIN_SQL = """
  CASE WHEN upper(trim(alert_severity)) NOT IN ('LOW','MEDIUM','HIGH','CRITICAL') THEN 'INVALID_ALERT_SEVERITY' END,
  CASE WHEN alert_severity IS NULL THEN 'MISSING_ALERT_SEVERITY' END,
  CASE WHEN TRY_CAST(alert_timestamp AS TIMESTAMP) IS NULL THEN 'INVALID_ALERT_TIMESTAMP' END"""


def tagged_alerts(v: Views) -> DataFrame:
    return rules.domain_errors(
        typed_alerts(v), rules.rules_from_config(DOMAIN_RULES, normalise=True))


@query("domain_errors", duckdb_with("alerts_raw") + f"""
SELECT alert_id, alert_severity, concat_ws('|', {DOMAIN_SQL}) AS quality_errors,
  CAST(len(list_filter([{DOMAIN_SQL}], lambda x: x IS NOT NULL)) AS INTEGER) AS faults
FROM alerts_raw""")
def _(v):
    return tagged_alerts(v).select(
        "alert_id", "alert_severity", F.concat_ws("|", "quality_errors").alias("quality_errors"),
        F.size("quality_errors").alias("faults"))


@query("split_domain", duckdb_with("alerts_raw") + f"""
SELECT * REPLACE (TRY_CAST(alert_timestamp AS TIMESTAMP) AS alert_timestamp) FROM alerts_raw
WHERE concat_ws(', ', {DOMAIN_SQL}) = ''""")
def _(v):
    return rules.split_tagged(tagged_alerts(v)).clean


@query("split_domain_rejected", duckdb_with("alerts_raw") + f"""
SELECT * REPLACE (TRY_CAST(alert_timestamp AS TIMESTAMP) AS alert_timestamp),
  concat_ws(', ', {DOMAIN_SQL}) AS error_reason FROM alerts_raw
WHERE concat_ws(', ', {DOMAIN_SQL}) <> ''""")
def _(v):
    return rules.split_tagged(tagged_alerts(v)).rejected


@query("rules_from_config", duckdb_with("txn_raw") + """
SELECT transaction_id, amount, currency, concat_ws(', ',
  CASE WHEN TRY_CAST(amount AS DOUBLE) <= 0 THEN 'INVALID_AMOUNT' END,
  CASE WHEN currency NOT IN ('CAD','USD','EUR','GBP') THEN 'INVALID_CURRENCY' END,
  CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT' END) AS error_reason FROM txn_raw
WHERE TRY_CAST(amount AS DOUBLE) <= 0 OR currency NOT IN ('CAD','USD','EUR','GBP')
  OR merchant_id IS NULL""")
def _(v):
    config = [*SOURCES["transactions"].domain_rules,
              {"column": "merchant_id", "op": "not_null", "error": "MISSING_MERCHANT"}]
    return rules.split(v.txn_raw, rules.rules_from_config(config)).rejected.select(
        "transaction_id", "amount", "currency", "error_reason")


@query("split_transactions", duckdb_with(**TXN_PARTS) + "SELECT * FROM txn_clean")
def _(v):
    return clean_transactions(v)


@query("split_transactions_rejected", duckdb_with(**TXN_PARTS)
       + "SELECT * FROM txn_tagged WHERE error_reason <> ''")
def _(v):
    return rules.split_transactions(v.txn_raw, timestamp_type=NTZ).rejected


@query("split_merchants", duckdb_with(**MERCH_PARTS) + "SELECT * FROM merch_clean")
def _(v):
    return rules.split_merchants(v.merch_raw).clean


@query("split_merchants_rejected", duckdb_with(**MERCH_PARTS)
       + "SELECT * FROM merch_tagged WHERE error_reason <> ''")
def _(v):
    return rules.split_merchants(v.merch_raw).rejected


@query("split_fraud_alerts", duckdb_with(**ALERT_PARTS) + "SELECT * FROM alerts")
def _(v):
    return rules.split_fraud_alerts(typed_alerts(v)).clean


@query("split_fraud_alerts_rejected", duckdb_with(**ALERT_PARTS)
       + "SELECT * FROM alert_tagged WHERE error_reason <> ''")
def _(v):
    return rules.split_fraud_alerts(typed_alerts(v)).rejected


@query("quarantine_transactions_v1", duckdb_with("txn_raw") + """
SELECT * FROM (SELECT transaction_id, customer_id, card_id, merchant_id, amount,
  upper(trim(currency)) AS currency, TRY_CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
  upper(trim(channel)) AS channel, location_country,
  upper(trim(transaction_status)) AS transaction_status, ingestion_timestamp, concat_ws(', ',
    CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' END,
    CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
    CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END,
    CASE WHEN amount IS NOT NULL AND coalesce(TRY_CAST(amount AS DOUBLE) <= 0, TRUE) THEN 'INVALID_AMOUNT' END,
    CASE WHEN coalesce(upper(trim(currency)) NOT IN ('CAD','USD','EUR','GBP'), TRUE) THEN 'INVALID_CURRENCY' END,
    CASE WHEN TRY_CAST(transaction_timestamp AS TIMESTAMP) IS NULL THEN 'INVALID_TRANSACTION_TIMESTAMP' END
  ) AS error_reason FROM txn_raw) WHERE error_reason <> ''""")
def _(v):
    return rules.quarantine_transactions_v1(v.txn_raw, timestamp_type=NTZ)


@query("union_by_name_fill", duckdb_with(**ALERT_PARTS, **MERCH_PARTS) + """
SELECT merchant_id, customer_id, error_reason FROM alert_tagged WHERE error_reason <> ''
UNION ALL BY NAME
SELECT merchant_id, merchant_name, error_reason FROM merch_tagged WHERE error_reason <> ''""")
def _(v):
    return rules.union_rejects(
        rules.split_fraud_alerts(typed_alerts(v)).rejected.select(
            "merchant_id", "customer_id", "error_reason"),
        rules.split_merchants(v.merch_raw).rejected.select(
            "merchant_id", "merchant_name", "error_reason"))


@query("quarantine_reason_profile", duckdb_with(**TXN_PARTS) + """
SELECT reason, count(*) AS rejected_rows FROM (
  SELECT unnest(string_split(error_reason, ', ')) AS reason FROM txn_tagged WHERE error_reason <> '')
GROUP BY reason""")
def _(v):
    return rules.reason_profile(rules.split_transactions(v.txn_raw, timestamp_type=NTZ).rejected)


# joins

@query("fx_enrich", duckdb_with("txn", "fx", enriched=ENRICHED) + "SELECT * FROM enriched")
def _(v):
    return enriched(v)


@query("fx_enrich_asof", duckdb_with("txn", "fx") + """
SELECT t.*, f.rate_to_cad, t.amount * f.rate_to_cad AS amount_cad
FROM txn t ASOF LEFT JOIN fx f
  ON t.currency = f.currency AND CAST(t.transaction_timestamp AS DATE) >= f.rate_date""")
def _(v):
    return joins.fx_enrich(v.txn, v.fx, asof=True)


@query("profile_left_joins", duckdb_with(**ALERT_PARTS, txn_profile=TXN_PROFILE,
                                         raised=ALERT_PROFILE) + """
SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS customer_id, c_name AS customer_name,
  transaction_count, total_amount, distinct_merchants, alert_count, max_alert_severity_rank
FROM customer
LEFT JOIN txn_profile t ON t.customer_id = concat('C', CAST(c_custkey AS VARCHAR))
LEFT JOIN raised a ON a.customer_id = concat('C', CAST(c_custkey AS VARCHAR))""")
def _(v):
    spine = v.table("customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return profiles.profile_left_joins(
        spine, "customer_id", profiles.customer_txn_profile(v.txn),
        profiles.alert_profile(alerts(v)))


def purchases_and_errors(v: Views) -> tuple[DataFrame, DataFrame]:
    events = v.table("events")
    left = events.filter("event_type = 'purchase'").select(
        "event_id", "user_id", F.col("ts").alias("purchase_ts"), "value")
    right = events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_ts"))
    return left, right


INTERVAL_SQL = """
SELECT p.event_id, p.user_id, p.ts AS purchase_ts, p.value, e.event_id AS error_id, e.ts AS error_ts
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
{kind} JOIN (SELECT * FROM events WHERE event_type = 'error') e
  ON p.user_id = e.user_id AND e.ts >= p.ts AND e.ts <= p.ts + INTERVAL {width}"""


@query("interval_join_batch", INTERVAL_SQL.format(kind="LEFT", width="30 MINUTE"))
def _(v):
    return joins.interval_join(*purchases_and_errors(v), "user_id", "purchase_ts", "error_ts")


@query("interval_join_day", INTERVAL_SQL.format(kind="LEFT", width="1 DAY"))
def _(v):
    return joins.interval_join(
        *purchases_and_errors(v), "user_id", "purchase_ts", "error_ts", seconds=86400)


@query("interval_matches", INTERVAL_SQL.format(kind="", width="1 DAY"))
def _(v):
    return joins.interval_matches(
        *purchases_and_errors(v), "user_id", "purchase_ts", "error_ts", seconds=86400)


def feed_parts(v: Views) -> tuple[DataFrame, DataFrame]:
    feed = v.cust_feed
    return (feed.filter(F.col("effective_date") < CUT), feed.filter(F.col("effective_date") >= CUT))


FEED_PARTS = {
    "before": f"SELECT * FROM {{cust_feed}} WHERE effective_date < DATE '{CUT}'",
    "after": f"SELECT * FROM {{cust_feed}} WHERE effective_date >= DATE '{CUT}'",
}
DATE_TEXT = "REPLACE (CAST(effective_date AS VARCHAR) AS effective_date)"
VALIDITY_TEXT = ("REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, "
                 "CAST(valid_to AS VARCHAR) AS valid_to)")


@query("anti_join_new_keys", duckdb_with(**FEED_PARTS) + f"""
SELECT * {DATE_TEXT} FROM before b WHERE NOT EXISTS (
  SELECT 1 FROM after a WHERE a.customer_id = b.customer_id AND a.customer_risk_tier = 'HIGH')""")
def _(v):
    before, after = feed_parts(v)
    return hist.anti_join_new_keys(
        before, after.filter("customer_risk_tier = 'HIGH'"), ["customer_id"])


# aggregations

@query("daily_transaction_summary", duckdb_with("txn", "fx", enriched=ENRICHED) + """
SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS transaction_date, currency,
  count(*) AS transaction_count, sum(amount) AS total_amount, sum(amount_cad) AS total_amount_cad
FROM enriched GROUP BY 1, 2""")
def _(v):
    return profiles.daily_transaction_summary(enriched(v))


@query("fraud_risk_summary", duckdb_with("txn", "fx", enriched=ENRICHED, labelled=LABELLED) + """
SELECT transaction_date, risk_level, count(*) AS transaction_count,
  sum(amount_cad) AS total_amount_cad FROM labelled GROUP BY 1, 2""")
def _(v):
    return profiles.fraud_risk_summary(enriched(v))


@query("customer_txn_profile", duckdb_with(txn_profile=TXN_PROFILE) + "SELECT * FROM txn_profile")
def _(v):
    return profiles.customer_txn_profile(v.txn)


@query("alert_profile", duckdb_with(**ALERT_PARTS, raised=ALERT_PROFILE) + "SELECT * FROM raised")
def _(v):
    return profiles.alert_profile(alerts(v))


PROFILE_PARTS = dict(ALERT_PARTS, customers=history("{cust_feed}"), txn_profile=TXN_PROFILE,
                     raised=ALERT_PROFILE)
CUSTOMER_360_SQL = """
SELECT c.customer_id, customer_name, customer_country, customer_risk_tier, kyc_status,
  coalesce(transaction_count, 0) AS transaction_count, coalesce(t.total_amount, 0) AS total_amount,
  {extra} coalesce(distinct_merchants, 0) AS distinct_merchants, coalesce(alert_count, 0) AS alert_count,
  coalesce(max_alert_severity_rank, 0) AS max_alert_severity_rank,
  CASE WHEN customer_risk_tier = 'HIGH' OR alert_count > 0 THEN 'HIGH'
       WHEN customer_risk_tier = 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk_flag
FROM customers c LEFT JOIN txn_profile t ON c.customer_id = t.customer_id
LEFT JOIN raised a ON c.customer_id = a.customer_id {joins} WHERE c.is_current"""


@query("customer_risk_360", duckdb_with(**PROFILE_PARTS)
       + CUSTOMER_360_SQL.format(extra="", joins=""))
def customer_360(v):
    return profiles.customer_risk_360(customer_history(v.cust_feed), v.txn, alerts(v))


@query("customer_risk_360_cad", duckdb_with(
    **PROFILE_PARTS, enriched=ENRICHED,
    cad="SELECT customer_id, sum(amount_cad) AS total_amount_cad FROM enriched GROUP BY 1")
       + CUSTOMER_360_SQL.format(
           extra="coalesce(total_amount_cad, 0) AS total_amount_cad,",
           joins="LEFT JOIN cad ON cad.customer_id = c.customer_id"))
def _(v):
    return profiles.customer_risk_360(
        customer_history(v.cust_feed), enriched(v), alerts(v), with_cad=True)


@query("merchant_risk_summary", duckdb_with("txn", **ALERT_PARTS, **MERCH_PARTS) + """
SELECT m.merchant_id, merchant_name, merchant_category, merchant_country, risk_category,
  is_high_risk_merchant, coalesce(transaction_count, 0) AS transaction_count,
  coalesce(total_amount, 0) AS total_amount, coalesce(distinct_customers, 0) AS distinct_customers,
  coalesce(alert_count, 0) AS alert_count,
  CASE WHEN is_high_risk_merchant OR risk_category = 'HIGH' OR alert_count > 0 THEN 'HIGH'
       WHEN risk_category = 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk_flag
FROM merchants m
LEFT JOIN (SELECT merchant_id, count(*) AS transaction_count, sum(amount) AS total_amount,
             count(DISTINCT customer_id) AS distinct_customers FROM txn GROUP BY 1) t USING (merchant_id)
LEFT JOIN (SELECT merchant_id, count(*) AS alert_count FROM alerts GROUP BY 1) a USING (merchant_id)""")
def _(v):
    return profiles.merchant_risk_summary(merchants(v), v.txn, alerts(v))


@query("group_key_cardinality", duckdb_with("txn_raw") + """
SELECT count(*) AS group_count FROM (
  SELECT DISTINCT currency, transaction_timestamp FROM txn_raw)""")
def _(v):
    return audit.group_key_cardinality(v.txn_raw, "currency", "transaction_timestamp")


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def _(v):
    return audit.row_count(v.table("lineitem"))


# deduplication and history

@query("dedup_any", duckdb_with(**TXN_PARTS) + "SELECT DISTINCT transaction_id FROM txn_clean")
def _(v):
    return hist.dedup_any(clean_transactions(v), ["transaction_id"]).select("transaction_id")


LATEST_TXN = ["ingestion_timestamp", "transaction_timestamp", "amount", "currency", "card_id",
              "merchant_id", "customer_id", "channel", "transaction_status", "location_country"]


@query("dedup_latest", duckdb_with(**TXN_PARTS) + f"""
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
  ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in LATEST_TXN)}) AS rk FROM txn_clean)
WHERE rk = 1""")
def _(v):
    return hist.dedup_latest(clean_transactions(v), ["transaction_id"], LATEST_TXN)


@query("dedup_latest_merchants", duckdb_with(**MERCH_PARTS) + "SELECT * FROM merchants")
def _(v):
    return merchants(v)


@query("merge_type1", duckdb_with(**FEED_PARTS, target=latest("before"), source=latest("after")) + f"""
SELECT * {DATE_TEXT} FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.customer_id = t.customer_id)
UNION ALL SELECT * {DATE_TEXT} FROM source""")
def _(v):
    before, after = feed_parts(v)
    order = ["effective_date", "seq"]
    target = hist.dedup_latest(before, ["customer_id"], order)
    return hist.merge_type1(target, after, ["customer_id"], order)


MERGE2_SQL = f"""
SELECT * {VALIDITY_TEXT} FROM (
SELECT h.* FROM target h WHERE NOT is_current
UNION ALL
SELECT t.customer_id, t.customer_name, t.customer_country, t.customer_risk_tier, t.kyc_status,
  t.valid_from, CASE WHEN s.customer_id IS NOT NULL AND (
      s.customer_risk_tier IS DISTINCT FROM t.customer_risk_tier
      OR s.kyc_status IS DISTINCT FROM t.kyc_status) THEN s.effective_date END,
  NOT (s.customer_id IS NOT NULL AND (
      s.customer_risk_tier IS DISTINCT FROM t.customer_risk_tier
      OR s.kyc_status IS DISTINCT FROM t.kyc_status))
FROM target t LEFT JOIN source s ON s.customer_id = t.customer_id WHERE t.is_current
UNION ALL
SELECT s.customer_id, s.customer_name, s.customer_country, s.customer_risk_tier, s.kyc_status,
  s.effective_date, NULL, TRUE
FROM source s LEFT JOIN target t ON s.customer_id = t.customer_id AND t.is_current
WHERE t.customer_id IS NULL OR s.customer_risk_tier IS DISTINCT FROM t.customer_risk_tier
   OR s.kyc_status IS DISTINCT FROM t.kyc_status)"""


@query("merge_type2", duckdb_with(
    **FEED_PARTS, target=history("before"), source=latest("after")) + MERGE2_SQL)
def _(v):
    before, after = feed_parts(v)
    return hist.merge_type2(customer_history(before), after, ["customer_id"], TRACKED,
                            "effective_date", ["seq"])


@query("merge_type2_backdated", duckdb_with(h=history("{cust_feed}"))
       + f"SELECT * {VALIDITY_TEXT} FROM h")
def _(v):
    """Two batches that interleave in time give the history of the whole feed."""
    late = F.pmod(F.xxhash64("seq"), F.lit(3)) == 0
    merged = customer_history(v.cust_feed).limit(0)
    for batch in (v.cust_feed.where(~late), v.cust_feed.where(late)):
        merged = hist.merge_type2_backdated(
            merged, batch, ["customer_id"], TRACKED, "effective_date", ["seq"], "observed")
    return merged.drop("observed")


@query("scd2_from_feed", duckdb_with(h=history("{cust_feed}"))
       + f"SELECT * {VALIDITY_TEXT} FROM h")
def _(v):
    return customer_history(v.cust_feed)


@query("scd2_current", duckdb_with(h=history("{cust_feed}"))
       + f"SELECT * {VALIDITY_TEXT} FROM h WHERE is_current")
def _(v):
    return hist.scd2_current(customer_history(v.cust_feed))


@query("scd2_integrity", duckdb_with("cust_feed") + """
SELECT customer_id, CAST(count(*) FILTER (valid_to IS NULL) AS BIGINT) AS current_rows,
  CAST(count(*) FILTER (valid_to > nxt OR (valid_to IS NULL AND nxt IS NOT NULL)) AS BIGINT) AS overlapping_rows,
  CAST(count(*) FILTER (valid_to < valid_from) AS BIGINT) AS backward_intervals
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id
        ORDER BY valid_from, valid_to NULLS LAST) AS nxt
  FROM (SELECT customer_id, effective_date AS valid_from,
    CASE WHEN seq % 5 = 0 THEN NULL ELSE effective_date + CAST(seq % 40 - 2 AS INTEGER) END AS valid_to
    FROM cust_feed))
GROUP BY customer_id HAVING current_rows <> 1 OR overlapping_rows > 0 OR backward_intervals > 0""")
def _(v):
    faulty = v.cust_feed.select(
        "customer_id", F.col("effective_date").alias("valid_from"),
        F.when(F.col("seq") % 5 == 0, None)
         .otherwise(F.date_add("effective_date", (F.col("seq") % 40 - 2).cast("int")))
         .alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())
    return hist.scd2_violations(faulty, ["customer_id"])


@query("asof_lookup", duckdb_with("txn", h=history("{cust_feed}")) + """
SELECT t.*, h.customer_risk_tier, h.kyc_status FROM txn t LEFT JOIN h
  ON t.customer_id = h.customer_id AND h.valid_from <= CAST(t.transaction_timestamp AS DATE)
 AND (h.valid_to IS NULL OR CAST(t.transaction_timestamp AS DATE) < h.valid_to)""")
def _(v):
    return joins.asof_lookup(
        v.txn, customer_history(v.cust_feed), ["customer_id"], "transaction_timestamp",
        ["customer_risk_tier", "kyc_status"])


def shifted_alerts(v: Views) -> DataFrame:
    """Alerts moved into the years of the transactions, at 5 minutes past an order's time."""
    return v.table("orders").filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 5 MINUTES")).alias("alert_timestamp"))


@query("high_risk_transactions", duckdb_with("txn", "fx", enriched=ENRICHED) + """
SELECT * FROM enriched e WHERE amount_cad >= 5000 OR EXISTS (
  SELECT 1 FROM orders o WHERE o_orderstatus = 'P'
    AND concat('C', CAST(o_custkey AS VARCHAR)) = e.customer_id
    AND o_orderdate + INTERVAL 5 MINUTE >= e.transaction_timestamp
    AND o_orderdate + INTERVAL 5 MINUTE <= e.transaction_timestamp + INTERVAL 30 MINUTE)""")
def _(v):
    return joins.high_risk_transactions(enriched(v), shifted_alerts(v), risk.HIGH_THRESHOLD_CAD)


# audit

RECON = """'{name}' AS pipeline_name, '{layer}' AS layer, s AS source_count, t AS target_count,
  s - t AS difference, CASE WHEN s = t THEN 'PASSED' ELSE 'FAILED' END AS reconciliation_status"""


def recon_sql(name: str, layer: str, source: str, target: str) -> str:
    return (f"SELECT {RECON.format(name=name, layer=layer)} FROM (SELECT "
            f"(SELECT count(*) FROM {source}) AS s, (SELECT count(*) FROM {target}) AS t)")


@query("reconcile_counts", duckdb_with(**TXN_PARTS)
       + recon_sql("transactions", "bronze_to_silver", "txn_raw", "txn_clean"))
def _(v):
    return audit.reconcile_counts(
        v.txn_raw, clean_transactions(v), "transactions", "bronze_to_silver")


@query("reconcile_all", duckdb_with(
    "fx", **TXN_PARTS, **MERCH_PARTS, customers=history("{cust_feed}"), enriched=ENRICHED)
       + " UNION ALL ".join([
           recon_sql("transactions", "bronze_to_silver", "txn_raw", "txn_clean"),
           recon_sql("customers", "bronze_to_silver", "customer",
                     "(SELECT * FROM customers WHERE is_current)"),
           recon_sql("merchants", "bronze_to_silver", "merch_raw", "merchants"),
           recon_sql("exchange_rates", "bronze_to_silver", "fx", "fx"),
           recon_sql("transactions", "silver_to_gold", "txn", "enriched")]))
def _(v):
    return audit.reconcile_all([
        (v.txn_raw, clean_transactions(v), "transactions", "bronze_to_silver"),
        (v.table("customer"), hist.scd2_current(customer_history(v.cust_feed)),
         "customers", "bronze_to_silver"),
        (v.merch_raw, merchants(v), "merchants", "bronze_to_silver"),
        (v.fx, silver.silver_rates(v.fx), "exchange_rates", "bronze_to_silver"),
        (v.txn, enriched(v), "transactions", "silver_to_gold"),
    ])


BALANCED = """
SELECT 'transactions' AS pipeline_name, 'bronze_to_silver' AS layer, n AS source_count,
  kept AS kept_count, bad AS rejected_count, good - ids AS duplicate_count,
  n - kept - bad - (good - ids) AS difference,
  CASE WHEN n = kept + bad + good - ids THEN 'PASSED' ELSE 'FAILED' END AS reconciliation_status
FROM (SELECT (SELECT count(*) FROM txn_raw) AS n, (SELECT count(*) FROM txn_clean) AS good,
  (SELECT count(DISTINCT transaction_id) FROM txn_clean) AS ids,
  (SELECT count(*) FROM ({kept})) AS kept,
  (SELECT count(*) FROM txn_tagged WHERE error_reason <> '') AS bad)"""


@query("reconcile_balanced", duckdb_with(**TXN_PARTS) + BALANCED.format(kept="SELECT DISTINCT transaction_id FROM txn_clean"))
def _(v):
    clean, rejected = rules.split_transactions(v.txn_raw, timestamp_type=NTZ)
    return audit.reconcile_balanced(
        v.txn_raw, rules.any_broken(rules.transaction_rules(NTZ)), rejected,
        hist.dedup_any(clean, ["transaction_id"]), "transactions", "bronze_to_silver",
        "transaction_id")


@query("reconcile_balanced_lossy", duckdb_with(**TXN_PARTS) + BALANCED.format(
    kept="SELECT DISTINCT transaction_id FROM txn_clean WHERE currency <> 'USD'"))
def _(v):
    """The table that was written lacks clean rows: their number is the difference."""
    clean, rejected = rules.split_transactions(v.txn_raw, timestamp_type=NTZ)
    return audit.reconcile_balanced(
        v.txn_raw, rules.any_broken(rules.transaction_rules(NTZ)), rejected,
        clean.filter("currency <> 'USD'").select("transaction_id").distinct(), "transactions",
        "bronze_to_silver", "transaction_id")


@query("group_table_recon", duckdb_with("txn", "fx", enriched=ENRICHED, labelled=LABELLED) + """,
summary AS (SELECT transaction_date, risk_level, count(*) AS n FROM labelled GROUP BY ALL),
counts AS (SELECT (SELECT count(*) FROM txn) AS s, CAST(sum(n) AS BIGINT) AS t, count(*) AS r,
  count(DISTINCT concat_ws('|', transaction_date, risk_level)) AS g FROM summary)
SELECT 'fraud_risk_summary' AS pipeline_name, 'gold_aggregation' AS layer, s AS source_count,
  t AS target_count, s - t AS difference, r AS group_rows, g AS group_count,
  CASE WHEN s = t AND r = g THEN 'PASSED' ELSE 'FAILED' END AS reconciliation_status FROM counts""")
def _(v):
    source = enriched(v)
    return audit.reconcile_groups(
        v.txn, profiles.fraud_risk_summary(source), ["transaction_date", "risk_level"],
        "transaction_count", "fraud_risk_summary")
