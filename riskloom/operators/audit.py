"""Reconciliation, run health and load history."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import schema_of
from riskloom.sources.tables import Lakehouse

log = logging.getLogger(__name__)

HEALTH = "audit.pipeline_health"
RECONCILIATION = "audit.reconciliation_results"
LOADS = "audit.batch_load_history"


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_key_cardinality(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Number of groups a GROUP BY over the keys has, NULL keys included."""
    return df.agg(F.count_distinct(F.struct(*keys)).alias("group_count"))


def _sum_counts(*frames: DataFrame) -> DataFrame:
    """Add up one-row frames of counts, each of which may lack columns of the others."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in rows.columns])


def _judged(counts: DataFrame, name: str, layer: str) -> DataFrame:
    difference = F.col("source_count") - F.col("target_count")
    return counts.select(
        F.lit(name).alias("pipeline_name"), F.lit(layer).alias("layer"),
        "source_count", "target_count", difference.alias("difference"),
        F.when(difference == 0, "PASSED").otherwise("FAILED").alias("reconciliation_status"))


def judged_counts(
    spark: SparkSession, source: int, target: int, name: str, layer: str
) -> DataFrame:
    """The reconciliation of two counts that are known."""
    return _judged(spark.createDataFrame(
        [(source, target)], "source_count bigint, target_count bigint"), name, layer)


def reconcile_counts(source: DataFrame, target: DataFrame, name: str, layer: str) -> DataFrame:
    """One row comparing the row counts of two frames; PASSED when they are equal."""
    return _judged(
        _sum_counts(row_count(source, "source_count"), row_count(target, "target_count")),
        name, layer)


def reconcile_all(checks: list[tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """All checks `(source, target, name, layer)` in one job."""
    return reduce(DataFrame.unionByName, [reconcile_counts(*check) for check in checks])


def reconcile_balanced(
    source: DataFrame, broken: Column, rejected: DataFrame, kept: DataFrame, name: str, layer: str,
    key: str, known: DataFrame | None = None,
) -> DataFrame:
    """Nothing lost: source = kept + rejected + duplicates, each of them counted by itself.

    Duplicates are the good rows of the source (`broken` is the condition its split used) beyond
    one for each `key`, and those whose key was `known` before. `rejected` and `kept` are the
    tables the split wrote, whose counts Spark takes from the file footers.
    """
    keys = source.filter(~broken).select(key).distinct()
    if known is not None:
        keys = keys.join(known, [key], "left_anti")
    counts = _sum_counts(
        source.agg(F.count("*").alias("source_count"), F.count_if(~broken).alias("clean_count")),
        row_count(keys, "key_count"), row_count(rejected, "rejected_count"),
        row_count(kept, "kept_count"))
    counts = counts.withColumn("duplicate_count", F.col("clean_count") - F.col("key_count"))
    balance = (F.col("source_count") - F.col("kept_count") - F.col("rejected_count")
               - F.col("duplicate_count"))
    return counts.select(
        F.lit(name).alias("pipeline_name"), F.lit(layer).alias("layer"),
        "source_count", "kept_count", "rejected_count", "duplicate_count",
        balance.alias("difference"),
        F.when(balance == 0, "PASSED").otherwise("FAILED").alias("reconciliation_status"))


def reconcile_groups(
    source: DataFrame, summary: DataFrame, keys: list[str], count: str, name: str
) -> DataFrame:
    """A grouped table counts every row of its source once and has one row per group.

    The source is only counted, which file footers answer; groups are looked at in the summary.
    """
    counts = _sum_counts(
        row_count(source, "source_count"),
        summary.agg(F.sum(count).alias("target_count"), F.count("*").alias("group_rows"),
                    F.count_distinct(F.struct(*keys)).alias("group_count")))
    difference = F.col("source_count") - F.col("target_count")
    return counts.select(
        F.lit(name).alias("pipeline_name"), F.lit("gold_aggregation").alias("layer"),
        "source_count", "target_count", difference.alias("difference"),
        "group_rows", "group_count",
        F.when((difference == 0) & (F.col("group_rows") == F.col("group_count")), "PASSED")
         .otherwise("FAILED").alias("reconciliation_status"))


def load_history(
    loaded: DataFrame, load_name: str, source_name: str, target_table: str,
    status: str = "SUCCESS",
) -> DataFrame:
    """One row per load and file with the number of rows it brought."""
    return loaded.groupBy("load_id", "source_file").agg(
        F.count("*").alias("record_count")
    ).select(
        "load_id", F.lit(load_name).alias("pipeline_name"),
        F.lit(source_name).alias("source_name"), "source_file",
        F.lit(target_table).alias("target_table"), "record_count",
        F.lit(status).alias("status"), F.lit(None).cast("string").alias("error_message"),
        F.current_timestamp().alias("load_timestamp"))


@dataclass
class Outcome:
    """What a step did, for its health row."""

    processed: int = 0
    quarantined: int = 0
    note: str | None = None


def health_row(
    spark: SparkSession, name: str, layer: str, run_id: str, status: str, start: datetime,
    end: datetime, processed: int = 0, quarantined: int = 0, error: str | None = None,
) -> DataFrame:
    return spark.createDataFrame(
        [(name, layer, run_id, status, start, end, (end - start).total_seconds(), processed,
          quarantined, error, datetime.now(timezone.utc))],
        schema_of(HEALTH))


def run_step(
    lake: Lakehouse, name: str, layer: str, step: Callable[[], Outcome], batch: str | None = None
) -> Outcome:
    """Run a step and append its health row, whether it succeeds or fails.

    The step's own error is raised again. A failure to write the health row of a good step is
    logged and does not turn the step into a failure. With `batch` the row replaces the one of
    an earlier attempt at that batch.
    """
    run_id, start = str(uuid.uuid4()), datetime.now(timezone.utc)

    def record(status: str, outcome: Outcome, error: str | None = None) -> None:
        try:
            lake.append(HEALTH, health_row(
                lake.spark, name, layer, run_id, status, start, datetime.now(timezone.utc),
                outcome.processed, outcome.quarantined, error), batch)
        except Exception:
            log.exception("health row of %s (%s) was not written", name, status)

    try:
        outcome = step()
    except Exception as failure:
        record("FAILED", Outcome(), str(failure))
        raise
    record("SUCCESS", outcome, outcome.note)
    return outcome


def record_reconciliation(lake: Lakehouse, result: DataFrame, batch: str | None = None) -> None:
    """Append a reconciliation; its own failure is logged, since the data is already there."""
    try:
        lake.append(RECONCILIATION, result.withColumn(
            "validation_timestamp", F.current_timestamp()), batch)
    except Exception:
        log.exception("reconciliation was not written")
