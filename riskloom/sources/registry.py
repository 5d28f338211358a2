"""What is known about each source, so one loader can serve them all."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from riskloom.schemas import CONTRACTS, FEED_DDL, struct

# fixed values
CURRENCIES = ["CAD", "USD", "EUR", "GBP"]
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]


@dataclass(frozen=True)
class SourceSpec:
    """Columns, contract, checks and tables of one source."""

    name: str
    required: tuple[str, ...]
    # each: column, op (gt / isin / not_null), value or values, error
    domain_rules: tuple[Mapping, ...] = field(default=())
    # columns cast before the checks; text that does not parse fails them
    casts: Mapping[str, str] = field(default_factory=dict)

    @property
    def text_schema(self) -> StructType:
        return struct(FEED_DDL[self.name])

    @property
    def contract(self) -> StructType:
        return struct(CONTRACTS[self.name])

    @property
    def target(self) -> str:
        return f"bronze.{self.name}_raw"

    @property
    def quarantine(self) -> str:
        return f"quarantine.invalid_{self.name}"


# fixed values: required columns and domain rules per source
SOURCES = {
    spec.name: spec
    for spec in (
        SourceSpec(
            "customers",
            required=("customer_id", "customer_name", "customer_country", "customer_risk_tier",
                      "kyc_status", "effective_date"),
            casts={"effective_date": "date"},
        ),
        SourceSpec(
            "merchants",
            required=("merchant_id", "merchant_name", "merchant_category", "merchant_country"),
        ),
        SourceSpec(
            "exchange_rates",
            required=("currency", "rate_date", "rate_to_cad"),
            casts={"rate_date": "date", "rate_to_cad": "double"},
        ),
        SourceSpec(
            "fraud_alerts",
            required=("alert_id", "customer_id", "merchant_id", "alert_type", "alert_severity",
                      "alert_timestamp"),
            domain_rules=(
                {"column": "alert_severity", "op": "isin", "values": SEVERITIES,
                 "error": "INVALID_ALERT_SEVERITY"},
                {"column": "alert_timestamp", "op": "not_null",
                 "error": "INVALID_ALERT_TIMESTAMP"},
            ),
            casts={"alert_timestamp": "timestamp"},
        ),
        SourceSpec(
            "transactions",
            required=("transaction_id", "customer_id", "card_id", "merchant_id", "amount",
                      "currency", "transaction_timestamp", "channel", "transaction_status"),
            domain_rules=(
                {"column": "amount", "op": "gt", "value": 0, "error": "INVALID_AMOUNT"},
                {"column": "currency", "op": "isin", "values": CURRENCIES,
                 "error": "INVALID_CURRENCY"},
            ),
        ),
    )
}
