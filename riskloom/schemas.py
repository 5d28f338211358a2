"""Declared schemas of every table, and conforming a frame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_EVENT_TEXT = (
    "transaction_id string, customer_id string, card_id string, merchant_id string, "
    "amount string, currency string, transaction_timestamp string, channel string, "
    "location_country string, transaction_status string"
)
_EVENT_TYPED = _EVENT_TEXT.replace("amount string", "amount double").replace(
    "transaction_timestamp string", "transaction_timestamp timestamp")
_CUSTOMER = (
    "customer_id string, customer_name string, customer_country string, "
    "customer_risk_tier string, kyc_status string"
)
_CUSTOMER_TEXT = f"{_CUSTOMER}, effective_date string"
_RATE_TEXT = "currency string, rate_date string, rate_to_cad string"
_ALERT = (
    "alert_id string, customer_id string, merchant_id string, alert_type string, "
    "alert_severity string, alert_timestamp timestamp"
)
_ALERT_TEXT = _ALERT.replace("alert_timestamp timestamp", "alert_timestamp string")
_MERCHANT = (
    "merchant_id string, merchant_name string, merchant_category string, "
    "merchant_country string, risk_category string, is_high_risk_merchant boolean"
)
_MERCHANT_TEXT = _MERCHANT.replace("is_high_risk_merchant boolean", "is_high_risk_merchant string")
_FILE = "source_file string, ingestion_timestamp timestamp"
_LOAD = f"{_FILE}, load_id string"
_REJECT = "error_reason string, quarantined_at timestamp"

# fixed values: table and column names, types and order
DDL = {
    "bronze.transactions_raw":
        f"{_EVENT_TEXT}, ingestion_timestamp timestamp, raw_payload string, event_offset bigint",
    "bronze.customers_raw": f"{_CUSTOMER_TEXT}, {_LOAD}",
    "bronze.exchange_rates_raw": f"{_RATE_TEXT}, {_LOAD}",
    "bronze.fraud_alerts_raw": f"{_ALERT}, {_FILE}",
    "bronze.merchants_raw": f"{_MERCHANT_TEXT}, {_LOAD}",
    "silver.transactions":
        f"{_EVENT_TYPED}, ingestion_timestamp timestamp, silver_processed_at timestamp",
    "silver.customers_scd2":
        f"{_CUSTOMER}, valid_from date, valid_to date, is_current boolean, "
        "created_at timestamp, updated_at timestamp",
    "silver.exchange_rates":
        "currency string, rate_date date, rate_to_cad double, loaded_at timestamp",
    "silver.fraud_alerts":
        f"{_ALERT}, ingestion_timestamp timestamp, silver_processed_at timestamp",
    "silver.merchants":
        f"{_MERCHANT}, ingestion_timestamp timestamp, silver_processed_at timestamp",
    "gold.transactions_enriched":
        f"{_EVENT_TYPED}, ingestion_timestamp timestamp, rate_to_cad double, "
        "amount_cad double, gold_processed_at timestamp",
    "gold.daily_transaction_summary":
        "transaction_date date, currency string, transaction_count bigint, "
        "total_amount double, total_amount_cad double, processed_at timestamp",
    "gold.fraud_risk_summary":
        "transaction_date date, risk_level string, transaction_count bigint, "
        "total_amount_cad double, processed_at timestamp",
    "gold.transactions_with_fraud_alerts":
        "transaction_id string, customer_id string, merchant_id string, amount double, "
        "currency string, transaction_timestamp timestamp, alert_id string, alert_type string, "
        "alert_severity string, alert_timestamp timestamp, processed_at timestamp",
    "gold.customer_risk_360":
        f"{_CUSTOMER}, transaction_count bigint, total_amount double, distinct_merchants bigint, "
        "alert_count bigint, max_alert_severity_rank int, overall_risk_flag string, "
        "processed_at timestamp",
    "gold.merchant_risk_summary":
        f"{_MERCHANT}, transaction_count bigint, total_amount double, distinct_customers bigint, "
        "alert_count bigint, overall_risk_flag string, processed_at timestamp",
    # rejected rows keep the text they arrived with
    "quarantine.invalid_transactions":
        f"{_EVENT_TEXT}, ingestion_timestamp timestamp, {_REJECT}",
    "quarantine.invalid_customers": f"{_CUSTOMER_TEXT}, {_FILE}, {_REJECT}",
    "quarantine.invalid_exchange_rates": f"{_RATE_TEXT}, {_LOAD}, {_REJECT}",
    "quarantine.invalid_fraud_alerts": f"{_ALERT_TEXT}, {_FILE}, {_REJECT}",
    "quarantine.invalid_merchants":
        f"{_MERCHANT_TEXT}, ingestion_timestamp timestamp, load_id string, {_REJECT}",
    "audit.batch_load_history":
        "load_id string, pipeline_name string, source_name string, source_file string, "
        "target_table string, record_count bigint, status string, error_message string, "
        "load_timestamp timestamp",
    "audit.pipeline_health":
        "pipeline_name string, layer string, run_id string, status string, "
        "start_time timestamp, end_time timestamp, duration_seconds double, "
        "records_processed bigint, records_quarantined bigint, error_message string, "
        "created_at timestamp",
    "audit.reconciliation_results":
        "pipeline_name string, layer string, source_count bigint, target_count bigint, "
        "difference bigint, reconciliation_status string, validation_timestamp timestamp",
}
LAYERS = ("bronze", "silver", "gold", "quarantine", "audit")

# the text columns a landed file or event carries
EVENT_DDL = _EVENT_TEXT
FEED_DDL = {
    "customers": _CUSTOMER_TEXT,
    "exchange_rates": _RATE_TEXT,
    "fraud_alerts": _ALERT_TEXT,
    "merchants": _MERCHANT_TEXT,
    "transactions": _EVENT_TEXT,
}

# fixed values: columns and types a batch must have before it may be loaded
CONTRACTS = {
    "transactions": f"{_EVENT_TEXT}, ingestion_timestamp timestamp",
    "customers": f"{_CUSTOMER_TEXT}, {_LOAD}",
    "exchange_rates": f"{_RATE_TEXT}, {_LOAD}",
    "fraud_alerts": _ALERT,
    "merchants": f"{_MERCHANT_TEXT}, {_LOAD}",
}


def column_names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def schema_of(table: str) -> StructType:
    return struct(DDL[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of `table`, in its order and types; a column `df` lacks is NULL.

    Values a type cannot hold become NULL, so callers reject bad text beforehand.
    """
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema_of(table).fields
    ])
