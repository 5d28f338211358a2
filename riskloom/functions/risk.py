"""Money and risk labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
HIGH_THRESHOLD_CAD = 5000
MEDIUM_THRESHOLD_CAD = 1000
SEVERITY_RANKS = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}


def amount_cad(amount: Column | str = "amount", rate: Column | str = "rate_to_cad") -> Column:
    """Amount in CAD; NULL when there is no rate."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    rate = F.col(rate) if isinstance(rate, str) else rate
    return amount * rate


def amount_risk_label(
    amount: Column | str,
    high: float = HIGH_THRESHOLD_CAD,
    medium: float = MEDIUM_THRESHOLD_CAD,
) -> Column:
    """HIGH, MEDIUM or LOW by size; an unknown amount is LOW."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(amount >= high, "HIGH").when(amount >= medium, "MEDIUM").otherwise("LOW")


def severity_rank(severity: Column | str = "alert_severity") -> Column:
    """Numeric rank of an alert severity, 0 for anything unknown."""
    severity = F.col(severity) if isinstance(severity, str) else severity
    rank = None
    for name, value in SEVERITY_RANKS.items():
        rank = F.when(severity == name, value) if rank is None else rank.when(severity == name, value)
    return rank.otherwise(0)


def _flag(high: Column, medium: Column) -> Column:
    return F.when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")


def customer_risk_flag(
    tier: Column | str = "customer_risk_tier", alerts: Column | str = "alert_count"
) -> Column:
    """HIGH for a HIGH tier or any alert, MEDIUM for a MEDIUM tier, else LOW."""
    tier = F.col(tier) if isinstance(tier, str) else tier
    alerts = F.col(alerts) if isinstance(alerts, str) else alerts
    return _flag((tier == "HIGH") | (alerts > 0), tier == "MEDIUM")


def merchant_risk_flag(
    category: Column | str = "risk_category",
    listed: Column | str = "is_high_risk_merchant",
    alerts: Column | str = "alert_count",
) -> Column:
    """As `customer_risk_flag`, and HIGH for a merchant marked high-risk."""
    category = F.col(category) if isinstance(category, str) else category
    listed = F.col(listed) if isinstance(listed, str) else listed
    alerts = F.col(alerts) if isinstance(alerts, str) else alerts
    return _flag(listed | (category == "HIGH") | (alerts > 0), category == "MEDIUM")
