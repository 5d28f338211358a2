"""Hashing and masking of personal data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: column -> what to do with it; `hash` adds `<column>_hash` and leaves the column
CUSTOMER_POLICY = {"customer_id": "hash", "email": "email", "phone": "digits"}


def hash_identifier(column: Column | str, salt: str) -> Column:
    """SHA-256 hex of `value:salt`; NULL stays NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.concat(column.cast("string"), F.lit(f":{salt}")), 256)


def mask_email(column: Column | str) -> Column:
    """Everything before the first `@` becomes `***`."""
    return F.regexp_replace(column, r"^[^@]+", "***")


def mask_digits(column: Column | str) -> Column:
    """Every digit becomes `*`."""
    return F.regexp_replace(column, r"\d", "*")


def apply_policy(df: DataFrame, policy: Mapping[str, str], salt: str) -> DataFrame:
    """Apply one action (`hash`, `email`, `digits` or `drop`) per column in one projection."""
    unknown = set(policy.values()) - {"hash", "email", "digits", "drop"}
    if unknown:
        raise ValueError(f"unknown privacy actions: {sorted(unknown)}")
    columns = {}
    for name, action in policy.items():
        if action == "hash":
            columns[f"{name}_hash"] = hash_identifier(name, salt)
        elif action == "email":
            columns[name] = mask_email(name)
        elif action == "digits":
            columns[name] = mask_digits(name)
    return df.withColumns(columns).drop(*[n for n, a in policy.items() if a == "drop"])


def mask_customer_pii(df: DataFrame, salt: str) -> DataFrame:
    """Standard masking of a customer frame."""
    return apply_policy(df, CUSTOMER_POLICY, salt)
