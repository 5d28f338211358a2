"""Row checks: tag every row with the rules it breaks, then split clean from rejected.

A rule is a label and a condition in SQL text that holds when the row is bad. A condition
that comes out NULL has a stated meaning, so each row lands on exactly one side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import (
    drop_columns, parse_timestamp, standardise, standardise_columns, typed,
)
from riskloom.sources.registry import CURRENCIES, SEVERITIES


@dataclass(frozen=True)
class Rule:
    label: str
    broken_when: str
    # what an undecidable (NULL) condition means
    broken_when_null: bool = False

    @property
    def broken(self) -> Column:
        return F.coalesce(F.expr(self.broken_when), F.lit(self.broken_when_null))

    @property
    def reason(self) -> Column:
        return F.when(self.broken, F.lit(self.label))


class Split(NamedTuple):
    clean: DataFrame
    rejected: DataFrame


def any_broken(rules: Iterable[Rule]) -> Column:
    return reduce(lambda a, b: a | b, (r.broken for r in rules), F.lit(False))


def error_reason(rules: Iterable[Rule]) -> Column:
    """Labels of the broken rules in rule order, joined by a comma and a space."""
    return F.concat_ws(", ", *[r.reason for r in rules])


def domain_errors(df: DataFrame, rules: Iterable[Rule], column: str = "quality_errors") -> DataFrame:
    """Add the array of broken-rule labels, empty for a good row."""
    return df.withColumn(column, F.array_compact(F.array(*[r.reason for r in rules])))


def split_tagged(df: DataFrame, column: str = "quality_errors") -> Split:
    """Split a frame that `domain_errors` has tagged."""
    return Split(
        df.filter(F.size(column) == 0).drop(column),
        df.filter(F.size(column) > 0)
          .withColumn("error_reason", F.concat_ws(", ", column)).drop(column),
    )


def split(df: DataFrame, rules: Iterable[Rule]) -> Split:
    """Rows that break no rule, and the rest with `error_reason`."""
    rules = list(rules)
    bad = any_broken(rules)
    return Split(df.filter(~bad), df.filter(bad).withColumn("error_reason", error_reason(rules)))


def required_rules(columns: Iterable[str]) -> list[Rule]:
    return [Rule(f"MISSING_{c.upper()}", f"`{c}` IS NULL") for c in columns]


def split_required(df: DataFrame, columns: Iterable[str]) -> Split:
    """Rows with a value in each required column, and the rest."""
    return split(df, required_rules(columns))


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def _domain(column: str, values: Iterable, normalise: bool) -> str:
    subject = f"upper(trim({column}))" if normalise else column
    return f"{subject} NOT IN ({', '.join(map(_literal, values))})"


def rules_from_config(entries: Iterable[Mapping], normalise: bool = False) -> list[Rule]:
    """Rules from `column / op / value(s) / error` entries.

    `gt` is broken by values not above the bound and `isin` by values outside the list; both
    let NULL pass, which `not_null` catches. With `normalise`, `isin` looks at trimmed
    upper-case text.
    """
    rules = []
    for entry in entries:
        column, op, error = f"`{entry['column']}`", entry["op"], entry["error"]
        if op == "gt":
            broken = f"try_cast({column} AS double) <= {_literal(entry['value'])}"
        elif op == "isin":
            broken = _domain(column, entry["values"], normalise)
        elif op == "not_null":
            broken = f"{column} IS NULL"
        else:
            raise ValueError(f"unknown rule op {op!r} for column {entry['column']!r}")
        rules.append(Rule(error, broken))
    return rules


# fixed values: the labels of these rules and their order
def transaction_rules(timestamp_type: str = "timestamp", normalise: bool = True) -> list[Rule]:
    parsed = ("try_to_timestamp(transaction_timestamp)" if timestamp_type == "timestamp"
              else f"try_cast(transaction_timestamp AS {timestamp_type})")
    return [
        Rule("PARSE_FAILED",
             "transaction_id IS NULL AND customer_id IS NULL AND amount IS NULL"),
        *required_rules(["transaction_id", "customer_id", "merchant_id"]),
        Rule("INVALID_AMOUNT", "try_cast(amount AS double) <= 0", broken_when_null=True),
        Rule("INVALID_CURRENCY", _domain("currency", CURRENCIES, normalise),
             broken_when_null=True),
        Rule("INVALID_TIMESTAMP", f"{parsed} IS NULL"),
    ]


def split_transactions(
    df: DataFrame, timestamp_type: str = "timestamp", normalise: bool = True
) -> Split:
    """Typed clean transactions, and rejected ones as they arrived.

    Currency is checked on its trimmed upper-case form; `normalise=False` checks the raw text.
    """
    good, bad = split(
        drop_columns(df, "raw_payload", "event_offset"),
        transaction_rules(timestamp_type, normalise))
    clean = good.withColumns({
        "amount": typed("amount", "double"),
        "currency": standardise("currency"),
        "channel": standardise("channel"),
        "transaction_status": standardise("transaction_status"),
        "transaction_timestamp":
            parse_timestamp("transaction_timestamp", zoned=timestamp_type == "timestamp"),
        "silver_processed_at": F.current_timestamp(),
    })
    return Split(clean, bad.withColumn("quarantined_at", F.current_timestamp()))


def quarantine_transactions_v1(df: DataFrame, timestamp_type: str = "timestamp") -> DataFrame:
    """Rejected transactions under the older rules: clean first, then check.

    Rejected rows carry the cleaned values, and a missing amount is no fault.
    """
    cleaned = df.withColumns({
        "currency": standardise("currency"),
        "channel": standardise("channel"),
        "transaction_status": standardise("transaction_status"),
        "transaction_timestamp":
            parse_timestamp("transaction_timestamp", zoned=timestamp_type == "timestamp"),
    })
    rules = [
        *required_rules(["transaction_id", "customer_id", "merchant_id"]),
        Rule("INVALID_AMOUNT",
             "amount IS NOT NULL AND coalesce(try_cast(amount AS double) <= 0, true)"),
        Rule("INVALID_CURRENCY", _domain("currency", CURRENCIES, normalise=False),
             broken_when_null=True),
        Rule("INVALID_TRANSACTION_TIMESTAMP", "transaction_timestamp IS NULL"),
    ]
    return split(cleaned, rules).rejected.withColumn("quarantined_at", F.current_timestamp())


# fixed values: the labels of these rules and their order
MERCHANT_RULES = [
    Rule("PARSE_FAILED",
         "merchant_id IS NULL AND merchant_name IS NULL AND merchant_country IS NULL"),
    *required_rules(["merchant_id", "merchant_name", "merchant_category", "merchant_country"]),
]


def split_merchants(df: DataFrame) -> Split:
    """Typed clean merchants, and rejected ones as they arrived."""
    good, bad = split(
        drop_columns(df, "source_file", "raw_payload", "event_offset"), MERCHANT_RULES)
    clean = (
        standardise_columns(good.drop("load_id"),
                            "merchant_category", "merchant_country", "risk_category")
        .withColumns({
            "is_high_risk_merchant": typed("is_high_risk_merchant", "boolean"),
            "silver_processed_at": F.current_timestamp(),
        }))
    return Split(clean, bad.withColumn("quarantined_at", F.current_timestamp()))


# fixed values: the labels of these rules and their order
def alert_rules(normalise: bool = True) -> list[Rule]:
    return [
        Rule("PARSE_FAILED",
             "alert_id IS NULL AND customer_id IS NULL AND alert_timestamp IS NULL"),
        *required_rules(["alert_id", "customer_id", "merchant_id"]),
        Rule("INVALID_ALERT_TIMESTAMP", "alert_timestamp IS NULL"),
        Rule("INVALID_ALERT_SEVERITY", _domain("alert_severity", SEVERITIES, normalise),
             broken_when_null=True),
    ]


def split_fraud_alerts(df: DataFrame) -> Split:
    """Standardised clean alerts, and rejected ones as they arrived.

    `alert_timestamp` is a timestamp already; one that did not parse is NULL and is rejected.
    """
    good, bad = split(drop_columns(df, "source_file", "raw_payload", "event_offset"),
                      alert_rules())
    clean = standardise_columns(good, "alert_type", "alert_severity").withColumn(
        "silver_processed_at", F.current_timestamp())
    return Split(clean, bad.withColumn("quarantined_at", F.current_timestamp()))


def union_rejects(*frames: DataFrame) -> DataFrame:
    """All rejected rows; a column one side lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reason_profile(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason; a row with two reasons counts under both."""
    return (rejected.select(F.explode(F.split("error_reason", ", ")).alias("reason"))
                    .groupBy("reason").agg(F.count("*").alias("rejected_rows")))
