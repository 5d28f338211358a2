"""SQL for derived feeds that several counterpart queries start from."""

TXN_TAGGED = """
SELECT *, concat_ws(', ',
  CASE WHEN transaction_id IS NULL AND customer_id IS NULL AND amount IS NULL THEN 'PARSE_FAILED' END,
  CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' END,
  CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END,
  CASE WHEN coalesce(TRY_CAST(amount AS DOUBLE) <= 0, TRUE) THEN 'INVALID_AMOUNT' END,
  CASE WHEN coalesce(upper(trim(currency)) NOT IN ('CAD','USD','EUR','GBP'), TRUE) THEN 'INVALID_CURRENCY' END,
  CASE WHEN TRY_CAST(transaction_timestamp AS TIMESTAMP) IS NULL THEN 'INVALID_TIMESTAMP' END
) AS error_reason FROM {txn_raw}"""

TXN_CLEAN = """
SELECT transaction_id, customer_id, card_id, merchant_id, CAST(amount AS DOUBLE) AS amount,
  upper(trim(currency)) AS currency, CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
  upper(trim(channel)) AS channel, location_country, upper(trim(transaction_status)) AS transaction_status,
  ingestion_timestamp
FROM txn_tagged WHERE error_reason = ''"""

MERCH_TAGGED = """
SELECT *, concat_ws(', ',
  CASE WHEN merchant_id IS NULL AND merchant_name IS NULL AND merchant_country IS NULL THEN 'PARSE_FAILED' END,
  CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END,
  CASE WHEN merchant_name IS NULL THEN 'MISSING_MERCHANT_NAME' END,
  CASE WHEN merchant_category IS NULL THEN 'MISSING_MERCHANT_CATEGORY' END,
  CASE WHEN merchant_country IS NULL THEN 'MISSING_MERCHANT_COUNTRY' END
) AS error_reason FROM {merch_raw}"""

MERCH_CLEAN = """
SELECT merchant_id, merchant_name, upper(trim(merchant_category)) AS merchant_category,
  upper(trim(merchant_country)) AS merchant_country, upper(trim(risk_category)) AS risk_category,
  CAST(is_high_risk_merchant AS BOOLEAN) AS is_high_risk_merchant, ver
FROM merch_tagged WHERE error_reason = ''"""

MERCHANTS = """
SELECT * EXCLUDE (rk, ver) FROM (
  SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY ver DESC) AS rk FROM merch_clean)
WHERE rk = 1"""

ALERT_TAGGED = """
SELECT * REPLACE (TRY_CAST(alert_timestamp AS TIMESTAMP) AS alert_timestamp), concat_ws(', ',
  CASE WHEN alert_id IS NULL AND customer_id IS NULL AND TRY_CAST(alert_timestamp AS TIMESTAMP) IS NULL THEN 'PARSE_FAILED' END,
  CASE WHEN alert_id IS NULL THEN 'MISSING_ALERT_ID' END,
  CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END,
  CASE WHEN TRY_CAST(alert_timestamp AS TIMESTAMP) IS NULL THEN 'INVALID_ALERT_TIMESTAMP' END,
  CASE WHEN coalesce(upper(trim(alert_severity)) NOT IN ('LOW','MEDIUM','HIGH','CRITICAL'), TRUE) THEN 'INVALID_ALERT_SEVERITY' END
) AS error_reason FROM {alerts_raw}"""

# alert ids are unique among the clean rows, so deduplication by id keeps them all
ALERTS = """
SELECT alert_id, customer_id, merchant_id, upper(trim(alert_type)) AS alert_type,
  upper(trim(alert_severity)) AS alert_severity, alert_timestamp
FROM alert_tagged WHERE error_reason = ''"""

# the loader looks at required columns first and at domains only when none is missing
ALERT_LOADED = """
SELECT *, CASE WHEN missing <> '' THEN missing ELSE domain END AS error_reason FROM (
  SELECT *, concat_ws(', ',
      CASE WHEN alert_id IS NULL THEN 'MISSING_ALERT_ID' END,
      CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
      CASE WHEN merchant_id IS NULL THEN 'MISSING_MERCHANT_ID' END,
      CASE WHEN alert_type IS NULL THEN 'MISSING_ALERT_TYPE' END,
      CASE WHEN alert_severity IS NULL THEN 'MISSING_ALERT_SEVERITY' END,
      CASE WHEN TRY_CAST(alert_timestamp AS TIMESTAMP) IS NULL THEN 'MISSING_ALERT_TIMESTAMP' END) AS missing,
    CASE WHEN upper(trim(alert_severity)) NOT IN ('LOW','MEDIUM','HIGH','CRITICAL')
         THEN 'INVALID_ALERT_SEVERITY' ELSE '' END AS domain
  FROM {alerts_raw})"""

ENRICHED = """
SELECT t.*, f.rate_to_cad, t.amount * f.rate_to_cad AS amount_cad
FROM {txn} t LEFT JOIN {fx} f
  ON t.currency = f.currency AND CAST(t.transaction_timestamp AS DATE) = f.rate_date"""

LABELLED = """
SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR) AS transaction_date, amount_cad,
  CASE WHEN amount_cad >= 5000 THEN 'HIGH' WHEN amount_cad >= 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM enriched"""


def history(feed: str) -> str:
    """Type 2 history of a change feed, tracking tier and KYC status."""
    return f"""
SELECT customer_id, customer_name, customer_country, customer_risk_tier, kyc_status, valid_from,
  lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to,
  lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) IS NULL AS is_current
FROM (
  SELECT *, effective_date AS valid_from,
    lag(customer_risk_tier) OVER w AS tier_before, lag(kyc_status) OVER w AS kyc_before,
    row_number() OVER w AS nth
  FROM (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id, effective_date ORDER BY seq DESC) AS rk
      FROM {feed}) WHERE rk = 1)
  WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date))
WHERE nth = 1 OR customer_risk_tier IS DISTINCT FROM tier_before OR kyc_status IS DISTINCT FROM kyc_before"""


def latest(feed: str) -> str:
    """The last row per customer of a change feed."""
    return f"""
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY effective_date DESC, seq DESC) AS rk
  FROM {feed}) WHERE rk = 1"""


TXN_PROFILE = """
SELECT customer_id, count(*) AS transaction_count, sum(amount) AS total_amount,
  count(DISTINCT merchant_id) AS distinct_merchants
FROM {txn} GROUP BY customer_id"""

SEVERITY_RANK = """CASE alert_severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3
  WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END"""

ALERT_PROFILE = f"""
SELECT customer_id, count(*) AS alert_count, max({SEVERITY_RANK}) AS max_alert_severity_rank
FROM alerts GROUP BY customer_id"""

ALERT_PARTS = {"alert_tagged": ALERT_TAGGED, "alerts": ALERTS}
TXN_PARTS = {"txn_tagged": TXN_TAGGED, "txn_clean": TXN_CLEAN}
MERCH_PARTS = {"merch_tagged": MERCH_TAGGED, "merch_clean": MERCH_CLEAN, "merchants": MERCHANTS}
