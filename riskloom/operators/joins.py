"""Currency conversion, interval matching and as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.risk import amount_cad
from riskloom.operators.bounded import BROADCAST_BYTES, measured_bytes


def left_join_aggregate(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with a side that was aggregated on the same keys, hot keys split.

    Joined on the keys themselves, the aggregate's partitioning would serve the join as well,
    and adaptive execution only splits sides that come straight from a shuffle of the join's
    own. One composite key gives it that: the aggregate moves once more, the large side does
    not. Rows with a NULL key match nothing.
    """
    slot = F.struct(*keys)
    right = right.na.drop(how="any", subset=list(keys)).withColumn("_slot", slot).drop(*keys)
    return left.withColumn("_slot", slot).join(right, "_slot", "left").drop("_slot")


def _lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], max_broadcast_bytes: int
) -> DataFrame:
    """Left join with an aggregated side, broadcast while it fits."""
    if measured_bytes(right) <= max_broadcast_bytes:
        return left.join(F.broadcast(right), list(keys), "left")
    return left_join_aggregate(left, right, keys)


def daily_rates(rates: DataFrame, prefer: Sequence[str] = ()) -> DataFrame:
    """One rate per currency and date; of several, the greatest by `prefer`, then by rate."""
    best = F.max_by("rate_to_cad", F.struct(*prefer, "rate_to_cad")) if prefer else F.max("rate_to_cad")
    known = rates.na.drop(how="any", subset=["currency", "rate_date", "rate_to_cad"])
    return known.groupBy("currency", "rate_date").agg(best.alias("rate_to_cad"))


def carried_rates(rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rates with gaps closed by the rate before, and each currency's last rate.

    Every date between two quotes gets a row, so a later lookup is an equality join.
    """
    order = Window.partitionBy("currency").orderBy("rate_date")
    spans = rates.withColumn("_next", F.lead("rate_date").over(order))
    filled = spans.filter(F.col("_next").isNotNull()).select(
        "currency",
        F.explode(F.sequence("rate_date", F.date_sub("_next", 1))).alias("rate_date"),
        "rate_to_cad")
    last = spans.filter(F.col("_next").isNull()).select(
        "currency", F.col("rate_date").alias("_last_date"), F.col("rate_to_cad").alias("_last_rate"))
    return filled, last


def fx_enrich(
    transactions: DataFrame,
    rates: DataFrame,
    prefer: Sequence[str] = (),
    asof: bool = False,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every transaction with the CAD rate of its currency and day, and its CAD amount.

    Rates are reduced to one per currency and day, so no transaction is multiplied. With
    `asof`, a day without a rate takes the latest earlier one. While the rates fit
    `max_broadcast_bytes` the transactions are not shuffled.
    """
    day = F.to_date("transaction_timestamp")
    rates = daily_rates(rates, prefer)
    filled, last = carried_rates(rates) if asof else (rates, None)
    joined = _lookup(
        transactions.withColumn("_day", day), filled.withColumnRenamed("rate_date", "_day"),
        ["currency", "_day"], max_broadcast_bytes)
    if asof:
        joined = _lookup(joined, last, ["currency"], max_broadcast_bytes).withColumn(
            "rate_to_cad", F.coalesce(
                "rate_to_cad",
                F.when(F.col("_day") >= F.col("_last_date"), F.col("_last_rate"))))
    return joined.withColumn("amount_cad", amount_cad()).select(
        *transactions.columns, "rate_to_cad", "amount_cad")


def _bucket(ts: str | Column, width: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / width)


def _plus(ts: str, seconds: int) -> Column:
    return F.col(ts) + F.expr(f"INTERVAL {seconds} SECONDS")


def interval_matches(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    seconds: int = 1800,
) -> DataFrame:
    """Pairs of one key with `right_ts` in `[left_ts, left_ts + seconds]`.

    Time is cut into buckets of the match width. A right row goes to its own bucket and the
    one before, which covers every left row it can match, and the join is on key and bucket:
    a busy key is spread over its buckets instead of being paired in full. It is an inner
    join of two shuffled sides, both of which adaptive execution may split.
    `right` must not share column names with `left` other than `key`.
    """
    bucket = _bucket(right_ts, seconds)
    near = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).withColumn(
        "_bucket", F.explode(F.array(bucket, bucket - 1))
    ).withColumn("_slot", F.struct(key, "_bucket")).drop(key, "_bucket")
    return (
        _bucketed(left, key, left_ts, seconds)
        .join(near, "_slot")
        .filter((F.col(right_ts) >= F.col(left_ts))
                & (F.col(right_ts) <= _plus(left_ts, seconds)))
        .drop("_slot"))


def _slotted(left: DataFrame, key: str, left_ts: str, seconds: int) -> DataFrame:
    """Add `_slot`, key and bucket as one join key (see `left_join_aggregate`)."""
    return left.withColumn("_slot", F.struct(key, _bucket(left_ts, seconds).alias("_bucket")))


def _bucketed(left: DataFrame, key: str, left_ts: str, seconds: int) -> DataFrame:
    # the same filters in both branches of `interval_join` let Spark reuse one exchange
    return _slotted(
        left.filter(F.col(key).isNotNull() & F.col(left_ts).isNotNull()), key, left_ts, seconds
    ).filter(F.col("_slot").isNotNull())


def _with_match_flag(
    slotted: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int
) -> DataFrame:
    """Add `_matched` without pairing rows.

    Within one bucket a left row has a match when the latest right row there is not before
    it, or the earliest right row of the next bucket is within reach. Two values per key and
    bucket answer that, and they are aggregated before the shuffle.
    """
    bucket, absent = _bucket(right_ts, seconds), F.lit(None).cast(right.schema[right_ts].dataType)
    reach = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        key,
        F.explode(F.array(
            F.struct(bucket.alias("_bucket"), F.col(right_ts).alias("_latest"),
                     absent.alias("_earliest_next")),
            F.struct((bucket - 1).alias("_bucket"), absent.alias("_latest"),
                     F.col(right_ts).alias("_earliest_next")))).alias("r"),
    ).select(key, "r.*").groupBy(key, "_bucket").agg(
        F.max("_latest").alias("_latest"), F.min("_earliest_next").alias("_earliest_next")
    ).withColumn("_slot", F.struct(key, "_bucket")).drop(key, "_bucket")
    return slotted.join(reach, "_slot", "left").withColumn(
        "_matched",
        F.coalesce(F.col("_latest") >= F.col(left_ts), F.lit(False))
        | F.coalesce(F.col("_earliest_next") <= _plus(left_ts, seconds), F.lit(False)),
    ).drop("_latest", "_earliest_next", "_slot")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    seconds: int = 1800,
) -> DataFrame:
    """Every left row with each right row of its key within `seconds` after it, else NULLs.

    Pairs and unmatched rows are computed apart, so that no side of an outer join has to
    keep a hot group whole: pairs by `interval_matches`, unmatched rows by comparing with
    two values per key and bucket. Both read the left side through one shared exchange.
    """
    pairs = interval_matches(left, right, key, left_ts, right_ts, seconds)
    alone = _with_match_flag(
        _bucketed(left, key, left_ts, seconds), right, key, left_ts, right_ts, seconds
    ).filter(~F.col("_matched")).drop("_matched")
    unkeyed = left.filter(F.col(key).isNull() | F.col(left_ts).isNull())
    return pairs.unionByName(
        alone.unionByName(unkeyed), allowMissingColumns=True
    ).select(*left.columns, *[c for c in right.columns if c != key])


def interval_semi(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    seconds: int = 1800,
) -> DataFrame:
    """All left rows with a boolean `has_match`; no row is multiplied."""
    flagged = _with_match_flag(
        _slotted(left, key, left_ts, seconds), right, key, left_ts, right_ts, seconds)
    return flagged.withColumnRenamed("_matched", "has_match").select(*left.columns, "has_match")


def high_risk_transactions(enriched: DataFrame, alerts: DataFrame, high: float) -> DataFrame:
    """Enriched transactions of HIGH amount, or followed by an alert within 30 minutes."""
    flagged = interval_semi(
        enriched, alerts.select("customer_id", "alert_timestamp"),
        "customer_id", "transaction_timestamp", "alert_timestamp")
    return flagged.filter(F.col("has_match") | (F.col("amount_cad") >= high)).drop("has_match")


def transactions_with_alerts(
    transactions: DataFrame, alerts: DataFrame, seconds: int = 1800
) -> DataFrame:
    """Each transaction with the alerts its customer raised in the next 30 minutes."""
    return interval_join(
        transactions.select("transaction_id", "customer_id", "merchant_id", "amount", "currency",
                            "transaction_timestamp"),
        alerts.select("customer_id", "alert_id", "alert_type", "alert_severity",
                      "alert_timestamp"),
        "customer_id", "transaction_timestamp", "alert_timestamp", seconds)


def asof_lookup(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    date: str,
    columns: Sequence[str],
) -> DataFrame:
    """Each fact with the dimension version valid on `date`; NULLs when there is none.

    Versions of a key do not overlap, so at most one matches. A version stands once for every
    month it is valid in, open ones until the last fact, and facts meet the versions of their
    month only: their number does not grow with a key's history. Facts of a hot key and month are
    split over tasks, also when the history was just built by a window on the same keys (see
    `left_join_aggregate`). The last date is one aggregate over one column.
    """
    last = facts.agg(F.max(F.col(date).cast("date"))).first()[0]
    start, end = F.col("valid_from").cast("date"), F.col("valid_to").cast("date")
    used = history.na.drop(how="any", subset=list(keys)).where(
        (start <= F.lit(last).cast("date")) & (end.isNull() | (start < end)))
    until = F.least(F.coalesce(F.date_sub(end, 1), F.lit(last)), F.lit(last)).cast("date")
    months = F.sequence(F.trunc(start, "month"), F.trunc(until, "month"),
                        F.expr("INTERVAL 1 MONTH"))
    versions = used.select("*", F.explode(months).alias("_month")).select(
        F.struct(*keys, "_month").alias("_slot"), start.alias("_from"), end.alias("_to"),
        *columns)
    day = F.col(date).cast("date")
    slot = F.struct(*keys, F.trunc(day, "month").alias("_month")).alias("_slot")
    f, v = facts.select("*", slot).alias("f"), versions.alias("v")
    day = F.col(f"f.{date}").cast("date")
    return f.join(
        v,
        (F.col("f._slot") == F.col("v._slot")) & (F.col("v._from") <= day)
        & (F.col("v._to").isNull() | (day < F.col("v._to"))),
        "left",
    ).select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"v.{c}") for c in columns])
