"""What the stream queries land and write: packed, and dealt over tasks."""

import glob
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from crosscheck import streams
from crosscheck.registry import QUERIES
from crosscheck.views import Views
from riskloom.session import run_dir
from riskloom.sources.tables import Lakehouse
from riskloom.streaming.sinks import append_stream, append_to_table, finish

ROWS = 6000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lines of which every id comes twice, with other contents."""
    where = str(tmp_path_factory.mktemp("landing"))
    key = (F.col("id") % (ROWS // 2)).cast("bigint")
    spark.range(ROWS).select(
        key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        (F.col("id") * 7).alias("l_partkey"), (F.col("id") % 100).alias("l_suppkey"),
        (F.col("id") * 20.0).alias("l_extendedprice"),
        F.timestamp_add("DAY", F.col("id").cast("int") % 500, F.lit("2024-01-01").cast("timestamp_ntz"))
        .alias("l_shipdate"), F.lit("N").alias("l_returnflag"),
    ).write.parquet(f"{where}/lineitem.parquet")
    spark.range(ROWS // 2).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias(
        "o_custkey")).write.parquet(f"{where}/orders.parquet")
    return where


def size(pattern):
    return sum(map(os.path.getsize, glob.glob(pattern)))


def codecs(folder):
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    assert files
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
            for f in files if pq.ParquetFile(f).metadata.num_row_groups}


def test_landed_text_is_packed_and_read_back_whole(spark, tables):
    v, where = Views(spark, tables), run_dir(spark, "landed")
    streams.land_events(v, f"{where}/events")
    lines = spark.read.text(f"{where}/events")
    assert lines.count() == ROWS
    assert 4 * size(f"{where}/events/part-*") < lines.agg(F.sum(F.length("value"))).first()[0]
    feed = v.txn_raw.select(*streams.EVENT_COLUMNS)
    streams.land_csv(feed, f"{where}/feed")
    text = spark.read.text(f"{where}/feed").agg(F.sum(F.length("value"))).first()[0]
    assert 4 * size(f"{where}/feed/part-*") < text
    landed = spark.read.schema(feed.schema).option("header", True).csv(f"{where}/feed")
    assert landed.exceptAll(feed).count() == feed.exceptAll(landed).count() == 0


def test_tables_streams_and_seen_keys_are_written_small(spark, tables):
    lake = Lakehouse(spark, run_dir(spark, "small"), prefix=f"small_{uuid.uuid4().hex[:8]}_")
    lake.create("silver.transactions", "silver.merchants")
    rows = spark.range(50).select(F.format_string("T%d", "id").alias("transaction_id"))
    lake.append("silver.transactions", rows, "one")
    lake.rebuild("silver.merchants", rows.select(F.col("transaction_id").alias("merchant_id")))
    assert codecs(f"{lake.root}/silver") == {"ZSTD"}
    where = run_dir(spark, "sinks")
    finish(append_stream(lake.stream("silver.transactions"), f"{where}/out", f"{where}/cp1"))
    table = f"`{lake.prefix}silver`.`copied`"
    finish(append_to_table(lake.stream("silver.transactions"), table, f"{where}/cp2"))
    assert codecs(f"{where}/out") == codecs(f"{lake.root}/silver") == {"ZSTD"}
    assert spark.table(table).count() == 50


def test_a_delivery_is_no_single_task(spark, tables, monkeypatch):
    seen, append = [], Lakehouse.append

    def spy(lake, table, df, batch=None):
        if table == "bronze.transactions_raw":
            seen.append(df.select("transaction_id", F.spark_partition_id().alias("task")).collect())
        append(lake, table, df, batch)

    monkeypatch.setattr(Lakehouse, "append", spy)
    ids = QUERIES["foreach_batch_router_small_batches"](spark, tables).select("transaction_id")
    assert ids.count() == ids.distinct().count() > 0
    assert len(seen) == 3
    for rows in seen:
        tasks = {}
        for row in rows:
            tasks.setdefault(row["transaction_id"], set()).add(row["task"])
        assert len({row["task"] for row in rows}) > 1
        assert all(len(found) == 1 for found in tasks.values())  # an id lies in one file


@pytest.fixture(scope="module")
def five_sources(spark, tmp_path_factory):
    """Tables of all five sources; keys repeat, so that the join of lines and orders adds rows."""
    where = str(tmp_path_factory.mktemp("five"))
    day = F.timestamp_add(
        "DAY", F.col("id").cast("int") % 50, F.lit("2024-01-01").cast("timestamp_ntz"))
    tables = {
        "lineitem": spark.range(4000).select(
            (F.col("id") % 2000).alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
            (F.col("id") * 7).alias("l_partkey"), (F.col("id") % 100).alias("l_suppkey"),
            (F.col("id") * 20.0).alias("l_extendedprice"), day.alias("l_shipdate"),
            F.lit("N").alias("l_returnflag")),
        "orders": spark.range(2100).select(
            (F.col("id") % 2000).alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"),
            F.when(F.col("id") % 3 == 0, "F").when(F.col("id") % 3 == 1, "P").alias("o_orderstatus"),
            (F.col("id") * 200.0).alias("o_totalprice"), day.alias("o_orderdate")),
        "customer": spark.range(50).select(
            F.col("id").alias("c_custkey"), F.lit("name").alias("c_name"),
            F.lit(1).alias("c_nationkey")),
        "nation": spark.sql("SELECT 1 AS n_nationkey, 'CANADA' AS n_name"),
        "supplier": spark.range(40).select(
            F.col("id").alias("s_suppkey"), F.lit("shop").alias("s_name"),
            F.lit(1).alias("s_nationkey"), (F.col("id") * 300.0).alias("s_acctbal")),
        "events": spark.range(300).select(
            F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") % 50).alias("user_id"),
            F.lit("error").alias("event_type"), (F.col("id") % 120.0).alias("value")),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{where}/{name}.parquet")
    return where


def test_metadata_driven_load_joins_its_feed_once_and_loads_every_row(
        spark, five_sources, monkeypatch):
    joined, plain = [], Views.__getattr__

    def spy(v, name):
        joined.append(name)
        return plain(v, name)

    monkeypatch.setattr(Views, "__getattr__", spy)
    rows = QUERIES["metadata_driven_load"](spark, five_sources).collect()
    assert joined.count("txn_raw") == 1
    monkeypatch.undo()
    counts = {r.source: (r.loaded, r.rejected) for r in rows}
    v = Views(spark, five_sources)
    feeds = {"customers": v.cust_feed, "exchange_rates": v.fx, "merchants": v.merch_raw,
             "fraud_alerts": v.alerts_raw, "transactions": v.txn_raw}
    landed = {name: feed.count() for name, feed in feeds.items()}
    assert landed["transactions"] == 4200
    landed["transactions"] *= 2  # as events and as files
    assert {name: sum(n) for name, n in counts.items()} == landed
    assert all(counts[name][1] for name in ("customers", "merchants", "fraud_alerts", "transactions"))
