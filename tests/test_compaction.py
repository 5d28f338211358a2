"""Compaction of micro-batches into days."""

import datetime
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.session import run_dir
from riskloom.sources import compaction
from riskloom.sources.tables import PACKED, Lakehouse
from riskloom.streaming.sinks import append_stream, finish

TABLE = "silver.transactions"
START = datetime.date(2024, 3, 1)


def new_lake(spark, **how):
    lake = Lakehouse(spark, run_dir(spark, "packed"), prefix=f"packed_{uuid.uuid4().hex[:8]}_", **how)
    lake.create()
    return lake


@pytest.fixture
def lake(spark):
    return new_lake(spark)


def batch(spark, start, end, days=3):
    """Rows over some days; every tenth has no time."""
    return spark.range(start, end).select(
        F.format_string("T%06d", "id").alias("transaction_id"),
        F.when(F.col("id") % 10 != 9, F.lit(START).cast("timestamp") + F.make_dt_interval(
            (F.col("id") % days).cast("int"), F.lit(23))).alias("transaction_timestamp"),
        F.col("id").cast("double").alias("amount"))


def ids(df):
    return Counter(int(r[0][1:]) for r in df.select("transaction_id").collect())


def fill(spark, lake, n=6):
    for i in range(n):
        lake.append(TABLE, batch(spark, 100 * i, 100 * i + 100), f"landed{i % 2}-{i // 2:010d}")
    return Counter(range(100 * n))


def loose(lake):
    return sorted(x for x in lake.batches(TABLE) if not x.startswith(PACKED))


def test_days_replace_batches_but_the_last_of_each_stream(spark, lake):
    want = fill(spark, lake)
    lake.append(TABLE, batch(spark, 600, 610), "by-name")
    lake.append(TABLE, batch(spark, 610, 620))  # no label: nobody can write it again
    want += Counter(range(600, 620))
    assert compaction.compact(lake, TABLE) == 5
    assert loose(lake) == ["by-name", "landed0-0000000002", "landed1-0000000002"]
    assert len(compaction.packed_days(lake, TABLE)) == 4 and ids(lake.table(TABLE)) == want
    # a replay of a last batch, and of a named one, still replaces its rows
    lake.append(TABLE, batch(spark, 400, 500), "landed0-0000000002")
    lake.append(TABLE, batch(spark, 600, 605), "by-name")
    want -= Counter(range(605, 610))
    assert ids(lake.table(TABLE)) == want
    assert compaction.compact(lake, TABLE) == 0 and ids(lake.table(TABLE)) == want
    lake.append(TABLE, batch(spark, 700, 800, days=1), "landed0-0000000003")
    lake.append(TABLE, batch(spark, 800, 900, days=1), "landed0-0000000004")
    assert compaction.compact(lake, TABLE) == 2
    lake.append(TABLE, batch(spark, 900, 1000, days=1), "landed0-0000000005")
    before = set(lake.batches(TABLE))
    assert compaction.compact(lake, TABLE) == 1
    # only the days of the new rows are written again: the first one and that of rows without a time
    assert len(before & {x for x in lake.batches(TABLE) if x.startswith(PACKED)}) == 2
    days = compaction.packed_days(lake, TABLE)
    assert len(days) == len(set(days)) == 4
    assert ids(lake.table(TABLE)) == want + Counter(range(700, 1000))


@pytest.mark.parametrize("calls", range(6))
def test_a_call_that_dies_shows_each_row_once_and_is_made_good(spark, lake, monkeypatch, calls):
    want, left = fill(spark, lake, 4), [calls]

    def dying(what):
        def step(*args):
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            return what(*args)
        return step

    with monkeypatch.context() as m:
        m.setattr(lake, "hide", dying(lake.hide))
        m.setattr(compaction, "_drop", dying(compaction._drop))
        try:
            compaction.compact(lake, TABLE)
        except KeyboardInterrupt:
            pass
        assert ids(lake.table(TABLE)) == want
    compaction.compact(lake, TABLE)
    assert ids(lake.table(TABLE)) == want and lake.hidden(TABLE) == []
    days = compaction.packed_days(lake, TABLE)
    assert len(days) == len(set(days)) == 4 and len(loose(lake)) == 2


def test_more_batches_than_one_switch_takes(spark, lake, monkeypatch):
    monkeypatch.setattr(compaction, "AT_ONCE", 2)
    want = fill(spark, lake, 7)
    assert compaction.compact(lake, TABLE) == 5 and ids(lake.table(TABLE)) == want
    assert len(compaction.packed_days(lake, TABLE)) == 4


def test_streams_take_up_each_row_once(spark, lake):
    where, want = run_dir(spark, "follow"), fill(spark, lake, 4)

    def drain():
        finish(append_stream(lake.stream(TABLE), f"{where}/out", f"{where}/checkpoint"))
        return ids(spark.read.parquet(f"{where}/out"))

    assert drain() == want
    compaction.compact(lake, TABLE)
    lake.append(TABLE, batch(spark, 400, 500), "landed0-0000000002")
    assert drain() == want + Counter(range(400, 500))
    late = f"{where}/late"  # a stream begun after the compaction
    finish(append_stream(lake.stream(TABLE), f"{late}/out", f"{late}/checkpoint"))
    assert ids(spark.read.parquet(f"{late}/out")) == want + Counter(range(400, 500))


def test_days_prune_the_other_partitions(spark, lake):
    fill(spark, lake)
    compaction.compact(lake, TABLE)
    second = START + datetime.timedelta(days=1)
    rows = lake.days(TABLE, second, second)
    assert ids(rows) == Counter(i for i in range(600) if i % 3 == 1 and i % 10 != 9)
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numPartitions").value() == 3  # the day and two loose batches


def test_batches_a_reader_has_not_had_stay(spark):
    lake = new_lake(spark, period="day")
    fill(spark, lake)
    assert compaction.compact(lake, TABLE) == 0
    _, mark = lake.unread(TABLE, "gold.transactions_enriched")
    lake.append(TABLE, batch(spark, 600, 700), "landed0-0000000003")
    lake.mark_read(TABLE, "gold.transactions_enriched", mark)
    assert compaction.compact(lake, TABLE) == 5
    assert lake.unread(TABLE, "gold.transactions_enriched")[0] == ["landed0-0000000003"]
    assert ids(lake.table(TABLE)) == Counter(range(700))


def test_what_can_not_be_compacted(spark, lake):
    assert compaction.compact(lake, TABLE) == 0 and lake.table(TABLE).count() == 0
    for table in ("silver.customers_scd2", "gold.customer_risk_360"):
        with pytest.raises(ValueError, match="not an appended table"):
            compaction.compact(lake, table)
    with pytest.raises(ValueError, match="compacted day"):
        lake.append(TABLE, batch(spark, 0, 1), f"{PACKED}2024-03-01-x")
    for i in range(3):  # batches without a row
        lake.append(TABLE, batch(spark, 0, 0), f"empty-{i:010d}")
    assert compaction.compact(lake, TABLE) == 2 and lake.table(TABLE).count() == 0
