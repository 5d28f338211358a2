"""Daily exposure summaries and risk profiles.

Facts are aggregated to one row per key before they meet a dimension, so no join multiplies
rows and each fact side sends one row per key and task through its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.risk import (
    HIGH_THRESHOLD_CAD, MEDIUM_THRESHOLD_CAD, amount_risk_label, customer_risk_flag,
    merchant_risk_flag, severity_rank,
)
from riskloom.functions.text import zero_fill
from riskloom.operators.history import scd2_current


def daily_transaction_summary(enriched: DataFrame) -> DataFrame:
    """Count and amounts per day and currency."""
    return enriched.groupBy(
        F.to_date("transaction_timestamp").alias("transaction_date"), "currency"
    ).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.sum("amount_cad").alias("total_amount_cad"))


def fraud_risk_summary(
    enriched: DataFrame, high: float = HIGH_THRESHOLD_CAD, medium: float = MEDIUM_THRESHOLD_CAD
) -> DataFrame:
    """Count and CAD exposure per day and risk level."""
    return enriched.groupBy(
        F.to_date("transaction_timestamp").alias("transaction_date"),
        amount_risk_label("amount_cad", high, medium).alias("risk_level"),
    ).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount_cad").alias("total_amount_cad"))


def customer_txn_profile(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.count_distinct("merchant_id").alias("distinct_merchants"))


def alert_profile(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("customer_id").agg(
        F.count("*").alias("alert_count"),
        F.max(severity_rank()).alias("max_alert_severity_rank"))


def profile_left_joins(spine: DataFrame, key: str, *sides: DataFrame) -> DataFrame:
    """Every spine row with the columns of each side, which has one row per key."""
    for side in sides:
        spine = spine.join(side, key, "left")
    return spine


def customer_risk_360(
    customers: DataFrame, transactions: DataFrame, alerts: DataFrame, with_cad: bool = False
) -> DataFrame:
    """One row per current customer. `total_amount` adds amounts of different currencies;
    `with_cad` also gives their CAD total, from enriched transactions.
    """
    activity = customer_txn_profile(transactions)
    extra = []
    if with_cad:
        extra = ["total_amount_cad"]
        activity = transactions.groupBy("customer_id").agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.count_distinct("merchant_id").alias("distinct_merchants"),
            F.sum("amount_cad").alias("total_amount_cad"))
    profile = profile_left_joins(
        scd2_current(customers), "customer_id", activity, alert_profile(alerts))
    return zero_fill(
        profile, "transaction_count", "total_amount", "distinct_merchants", "alert_count",
        "max_alert_severity_rank", *extra,
    ).withColumn("overall_risk_flag", customer_risk_flag()).select(
        "customer_id", "customer_name", "customer_country", "customer_risk_tier", "kyc_status",
        "transaction_count", "total_amount", *extra, "distinct_merchants", "alert_count",
        "max_alert_severity_rank", "overall_risk_flag")


def merchant_risk_summary(
    merchants: DataFrame, transactions: DataFrame, alerts: DataFrame
) -> DataFrame:
    """One row per merchant."""
    activity = transactions.groupBy("merchant_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.count_distinct("customer_id").alias("distinct_customers"))
    raised = alerts.groupBy("merchant_id").agg(F.count("*").alias("alert_count"))
    profile = profile_left_joins(merchants, "merchant_id", activity, raised)
    return zero_fill(
        profile, "transaction_count", "total_amount", "distinct_customers", "alert_count",
    ).withColumn("overall_risk_flag", merchant_risk_flag()).select(
        "merchant_id", "merchant_name", "merchant_category", "merchant_country", "risk_category",
        "is_high_risk_merchant", "transaction_count", "total_amount", "distinct_customers",
        "alert_count", "overall_risk_flag")
