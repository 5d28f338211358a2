from datetime import date, datetime, timedelta
from random import Random

import pytest

from pyspark.sql import functions as F

from riskloom.operators import history, joins, profiles

T0 = datetime(2026, 5, 30, 10, 0)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def frames(spark, left, right):
    return (spark.createDataFrame(left, "id int, k string, lt timestamp_ntz"),
            spark.createDataFrame(right, "rid int, k string, rt timestamp_ntz"))


def brute(left, right, seconds):
    out = []
    for i, k, t in left:
        hits = [r for r, rk, rt in right if k is not None and k == rk and t is not None
                and rt is not None and t <= rt <= t + timedelta(seconds=seconds)]
        out += [(i, r) for r in hits] or [(i, None)]
    return sorted(out, key=str)


def test_interval_edges(spark):
    left = [(1, "c", T0), (2, None, T0), (3, "c", None), (4, "d", T0)]
    right = [(10, "c", T0), (11, "c", T0 + timedelta(minutes=30)),
             (12, "c", T0 + timedelta(minutes=30, seconds=1)), (13, "c", T0 - timedelta(seconds=1)),
             (14, None, T0), (15, "c", None)]
    out = joins.interval_join(*frames(spark, left, right), "k", "lt", "rt")
    assert sorted(((r["id"], r["rid"]) for r in out.collect()), key=str) == [
        (1, 10), (1, 11), (2, None), (3, None), (4, None)]
    flags = joins.interval_semi(*frames(spark, left, right), "k", "lt", "rt")
    assert {r["id"]: r["has_match"] for r in flags.collect()} == {
        1: True, 2: False, 3: False, 4: False}


def skewed(seed, n):
    rnd = Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}",
             datetime(1969, 12, 31, 20) + timedelta(seconds=rnd.randrange(86400),
                                                   microseconds=rnd.randrange(10**6)))
            for i in range(n)]


def test_interval_join_equals_brute_force_with_a_hot_key(spark):
    left, right = skewed(1, 900), skewed(2, 600)
    out = joins.interval_join(*frames(spark, left, right), "k", "lt", "rt", seconds=600)
    assert sorted(((r["id"], r["rid"]) for r in out.collect()), key=str) == brute(left, right, 600)


@pytest.fixture
def small_skew_limits(spark):
    """Adaptive skew handling at test sizes, and no automatic broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def third_hot(spark, rows=60_000):
    """A third of the rows share one key and one half hour."""
    return spark.range(rows, numPartitions=12).select(
        F.col("id").cast("int").alias("a"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
         .alias("k"),
        F.expr("timestamp_ntz'2026-05-30 10:00:00' + make_dt_interval(0,0,0,id % 60)").alias("t"))


def brute_flags():
    """Rows at 10:00 sharp of the two keys that have an alert at that instant."""
    return sum(1 for i in range(60_000) if i % 60 == 0 and (i % 3 == 0 or i % 5000 == 1))


def test_hot_group_is_split_on_either_side(spark, small_skew_limits):
    narrow = spark.createDataFrame([(1, "hot", T0), (2, "k1", T0)],
                                   "b int, k string, s timestamp_ntz")
    hot_right = joins.interval_join(narrow, third_hot(spark), "k", "s", "t")
    assert "skew=true" in plan(hot_right)
    assert hot_right.filter("b = 1").count() == 20_000
    later = narrow.select("k", "b", F.expr("s + interval 1 hour").alias("s"))
    hot_left = joins.interval_join(third_hot(spark), later, "k", "t", "s")
    # the pairs and the unmatched rows
    assert plan(hot_left).count("skew=true") == 2
    assert hot_left.count() == 60_000
    flags = joins.interval_semi(third_hot(spark), narrow, "k", "t", "s")
    assert "skew=true" in plan(flags)
    assert flags.filter("has_match").count() == brute_flags()


def test_hot_currency_and_hot_customer_are_split(spark, small_skew_limits):
    """Rates too large to broadcast, and versions of a busy customer."""
    txns = third_hot(spark).select(
        F.col("a").cast("string").alias("transaction_id"), F.col("k").alias("currency"),
        F.lit(2.0).alias("amount"), F.col("t").alias("transaction_timestamp"))
    rates = spark.createDataFrame([("hot", date(2026, 5, 30), 1.5)],
                                  "currency string, rate_date date, rate_to_cad double")
    out = joins.fx_enrich(txns, rates, max_broadcast_bytes=-1)
    assert "skew=true" in plan(out)
    assert (out.count(), out.filter("amount_cad = 3.0").count()) == (60_000, 20_000)
    versions = spark.createDataFrame(
        [("hot", "LOW", date(2026, 1, 1), date(2026, 2, 1)), ("hot", "HIGH", date(2026, 2, 1), None)],
        "currency string, tier string, valid_from date, valid_to date")
    feed = versions.select("currency", "tier", F.col("valid_from").alias("d"))
    built = history.scd2_from_feed(feed, ["currency"], ["tier"], "d")
    for dimension in (versions, built):
        found = joins.asof_lookup(
            txns, dimension, ["currency"], "transaction_timestamp", ["tier"])
        assert "skew=true" in plan(found)
        assert (found.count(), found.filter("tier = 'HIGH'").count()) == (60_000, 20_000)


def test_interval_join_reads_its_left_side_through_one_exchange(spark, tmp_path):
    for name, df in zip(("l", "r"), frames(spark, skewed(1, 50), skewed(2, 50))):
        df.write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "lr")
    out = joins.interval_join(left.hint("merge"), right.hint("merge"), "k", "lt", "rt")
    assert "ReusedExchange" in plan(out)


TXN = "transaction_id string, customer_id string, merchant_id string, amount double, currency string, transaction_timestamp timestamp_ntz"


def test_fx_keeps_each_transaction_once(spark):
    txns = spark.createDataFrame(
        [("T1", "C1", "M1", 10.0, "USD", T0), ("T2", "C1", "M1", 10.0, "EUR", T0),
         ("T3", "C1", "M1", 10.0, None, None)], TXN)
    rates = spark.createDataFrame(
        [("USD", date(2026, 5, 30), 1.2, 1), ("USD", date(2026, 5, 30), 1.1, 2),
         ("EUR", date(2026, 5, 20), 1.5, 1), ("EUR", date(2026, 5, 25), 1.6, 1)],
        "currency string, rate_date date, rate_to_cad double, loaded_at int")
    for limit in (1 << 20, -1):
        out = joins.fx_enrich(txns, rates, ["loaded_at"], max_broadcast_bytes=limit)
        assert {r["transaction_id"]: r["amount_cad"] for r in out.collect()} == {
            "T1": 11.0, "T2": None, "T3": None}
        out = joins.fx_enrich(txns, rates, ["loaded_at"], asof=True, max_broadcast_bytes=limit)
        assert {r["transaction_id"]: r["amount_cad"] for r in out.collect()} == {
            "T1": 11.0, "T2": 16.0, "T3": None}
    early = rates.filter("currency = 'EUR'").withColumn("rate_date", F.date_add("rate_date", 30))
    assert joins.fx_enrich(txns, early, asof=True).filter("rate_to_cad is not null").count() == 0


def test_broadcast_follows_the_measured_size(spark):
    txns = spark.createDataFrame([("T1", "C1", "M1", 10.0, "USD", T0)], TXN)
    rates = spark.createDataFrame([("USD", date(2026, 5, 30), 1.2)],
                                  "currency string, rate_date date, rate_to_cad double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.fx_enrich(txns, rates))
        assert "BroadcastHashJoin" not in plan(joins.fx_enrich(txns, rates, max_broadcast_bytes=8))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profile_of_a_customer_without_activity(spark):
    customers = spark.createDataFrame(
        [("C1", "Ann", "CA", "MEDIUM", "VERIFIED", True), ("C1", "Ann", "CA", "LOW", "VERIFIED", False)],
        "customer_id string, customer_name string, customer_country string, "
        "customer_risk_tier string, kyc_status string, is_current boolean")
    txns = spark.createDataFrame([], TXN)
    alerts = spark.createDataFrame([], "customer_id string, alert_severity string")
    row = profiles.customer_risk_360(customers, txns, alerts).collect()
    assert len(row) == 1
    assert tuple(row[0])[5:] == (0, 0.0, 0, 0, 0, "MEDIUM")
    assert [t for _, t in profiles.customer_risk_360(customers, txns, alerts).dtypes][5:] == [
        "bigint", "double", "bigint", "bigint", "int", "string"]
