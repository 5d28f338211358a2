"""The index of keys an appended table holds."""

import uuid

import pytest
from pyspark.sql import functions as F

from riskloom.session import run_dir
from riskloom.sources import seen
from riskloom.sources.tables import Lakehouse
from riskloom.streaming.loads import transactions_to_silver

TABLE = "silver.transactions"


@pytest.fixture
def lake(spark):
    lake = Lakehouse(spark, run_dir(spark, "seen"), prefix=f"seen_{uuid.uuid4().hex[:8]}_")
    lake.create()
    return lake


def ids(spark, start, end):
    return spark.range(start, end).select(F.format_string("T%09d", "id").alias("transaction_id"))


def known(lake, batch, label="new"):
    return sorted(r[0] for r in lake.seen(TABLE).among(batch, label).collect())


def rows_read(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("pushed", [seen.PUSHED, 3])
def test_keys_of_other_batches_are_known(spark, lake, monkeypatch, pushed):
    monkeypatch.setattr(seen, "PUSHED", pushed)
    assert known(lake, ids(spark, 0, 5)) == []
    lake.append(TABLE, ids(spark, 0, 50), "a-1")
    lake.append(TABLE, ids(spark, 50, 60), "a-2")
    asked = ids(spark, 45, 70).union(ids(spark, 45, 70)).union(
        spark.createDataFrame([(None,)], "transaction_id string"))
    want = [f"T{i:09d}" for i in range(45, 60)]
    assert known(lake, asked) == want
    assert known(lake, asked, "a-2") == want[:5]
    lake.append(TABLE, ids(spark, 50, 60), "a-2")  # a replay
    lake.seen(TABLE).compact()
    assert known(lake, asked, "a-1") == want[5:]
    assert known(lake, ids(spark, 100, 105)) == known(lake, ids(spark, 0, 0)) == []


def test_keys_of_a_replaced_table_are_forgotten(spark, lake):
    pair = spark.createDataFrame([("t", "a"), ("t", None)], "transaction_id string, alert_id string")
    name = "gold.transactions_with_fraud_alerts"
    lake.append(name, pair, "one")
    lake.replace(name, pair.where("alert_id is null"), "two")
    assert [tuple(r) for r in lake.seen(name).among(pair, "x").collect()] == [("t", None)]


def test_new_keys_read_next_to_nothing_of_a_large_index(spark, lake):
    index = lake.seen(TABLE)
    for k in range(4):
        index.add(ids(spark, k * 100_000, (k + 1) * 100_000), f"b-{k}")
    with index.pushing():
        def scan(start, end):
            keys = [r[0] for r in ids(spark, start, end).select(
                seen.key_of(["transaction_id"])).collect()]
            return index.scan(keys, range(seen.BUCKETS))
        # between known ids, so that no minimum or maximum shuts them out
        new = [f'{{"transaction_id":"T{i:09d}x"}}' for i in range(0, 400_000, 400)]
        assert rows_read(index.scan(new, range(seen.BUCKETS))) == 0
        once = scan(250_000, 250_002)
        assert 2 <= rows_read(once) <= 2 * 400_000 // (4 * seen.BUCKETS) + 2000
        assert once.count() == 2
    before = spark.conf.get(seen.PUSHDOWN)
    assert int(before) < seen.PUSHED


def test_small_batches_leave_repeats_of_earlier_batches_out(spark, lake):
    events = ids(spark, 0, 40).selectExpr(
        "transaction_id", "'C1' as customer_id", "'M1' as merchant_id", "'10.5' as amount",
        "'CAD' as currency", "'2024-01-01T00:00:00' as event_timestamp",
        "timestamp'2024-01-01 00:00:00' as ingestion_timestamp")
    for part in (events, events.where("transaction_id < 'T000000020'"), events):
        lake.append("bronze.transactions_raw", part.coalesce(1))
    transactions_to_silver(lake, lake.stream("bronze.transactions_raw", max_files=1, arrival=True),
                           run_dir(spark, "checkpoint"))
    silver = lake.table(TABLE)
    assert silver.count() == silver.select("transaction_id").distinct().count()
    recon = lake.table("audit.reconciliation_results")
    assert recon.where("reconciliation_status <> 'PASSED'").count() == 0


def test_as_many_keys_as_are_pushed_need_no_stack(spark, lake):
    lake.append(TABLE, ids(spark, 0, 30_000), "old")
    asked = ids(spark, 30_000 - 5, 30_000 - 5 + seen.PUSHED)
    assert known(lake, asked) == [f"T{i:09d}" for i in range(30_000 - 5, 30_000)]
