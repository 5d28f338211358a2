"""Collects the queries and their SQL, and renders results both engines can compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosscheck.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# clock values, which no second engine can reproduce
STAMPS = ["silver_processed_at", "quarantined_at", "gold_processed_at", "loaded_at",
          "created_at", "updated_at", "load_timestamp", "validation_timestamp"]


def portable(df: DataFrame) -> DataFrame:
    """Dates as text, timestamps without zone, no clock columns."""
    df = df.drop(*STAMPS)
    return df.select(*[
        F.col(n).cast("string").alias(n) if t == "date"
        else F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp"
        else F.col(n)
        for n, t in df.dtypes])


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: portable(build(Views(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = sql
        return build
    return register
