"""Queries that write tables, land files or run streams to the end of their input.

Each call works in its own new folder; what it lands is derived from the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.batch import (
    feed_parts, merchants, recon_sql,
)
from crosscheck.oracle_parts import (
    ALERT_LOADED, ALERT_PARTS, ENRICHED, LABELLED, MERCH_PARTS, TXN_PARTS,
)
from crosscheck.registry import query
from crosscheck.views import Views, duckdb_with
from riskloom.operators import audit, history, rules
from riskloom.plans import gold, silver
from riskloom.schemas import DDL, EVENT_DDL, FEED_DDL, column_names
from riskloom.session import run_dir
from riskloom.sources import compaction
from riskloom.sources.events import parse_events, read_event_files
from riskloom.sources.files import scan_csv
from riskloom.sources.registry import SOURCES
from riskloom.sources.tables import COMPRESSION, Lakehouse
from riskloom.streaming.loads import ingest_events, load_files, transactions_to_silver
from riskloom.streaming.sinks import append_stream, append_to_table, finish, late_rows
from riskloom.streaming.stateful import dedup_stream, interval_join_stream


def new_lake(v: Views, *tables: str) -> Lakehouse:
    lake = Lakehouse(v.spark, run_dir(v.spark, "lake"), prefix=f"run_{uuid.uuid4().hex[:12]}_")
    lake.create(*tables)
    return lake


# Landed text is packed to about a tenth. Packed files aren't split, so that they stay small.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 100_000}


def land_csv(df: DataFrame, path: str) -> None:
    """Write text columns the way a feed delivers them, blanks kept."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
       .write.mode("append").options(**LANDED).option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


CUSTOMER_COLUMNS, ALERT_COLUMNS, MERCHANT_COLUMNS, RATE_COLUMNS = (
    column_names(FEED_DDL[name])
    for name in ("customers", "fraud_alerts", "merchants", "exchange_rates"))
CUSTOMER_SQL = ", ".join(CUSTOMER_COLUMNS[:-1]) + ", CAST(effective_date AS VARCHAR) AS effective_date"


EVENT_COLUMNS = column_names(EVENT_DDL)


# the tables a route into silver needs, and the file of three a row comes with
ROUTED = ("bronze.transactions_raw", "silver.transactions", "quarantine.invalid_transactions",
          audit.RECONCILIATION, audit.HEALTH)
PART = "CAST(substring(card_id, 6, 3) AS INT) % 3"
DELIVERED = 16  # files of a delivery


def land_events(v: Views, path: str, feed: DataFrame | None = None) -> None:
    """Events as bus lines; cards ending in 7 send text that is no JSON. `feed` has the rows of
    `txn_raw` where they are written already."""
    payload = F.when(F.substring("card_id", -1, 1) == "7", F.lit("{broken")).otherwise(
        F.to_json(F.struct(*EVENT_COLUMNS)))
    (v.txn_raw if feed is None else feed).select(
        F.crc32("card_id").alias("offset"), payload.alias("value")
    ).write.options(**LANDED).json(path)


EVENTS_SQL = ", ".join(
    f"CASE WHEN card_id NOT LIKE '%7' THEN {c} END AS {c}" for c in EVENT_COLUMNS)


@query("kafka_event_source", duckdb_with("txn_raw") + f"SELECT {EVENTS_SQL} FROM txn_raw")
def _(v):
    where = run_dir(v.spark, "events")
    land_events(v, f"{where}/landing")
    events = parse_events(read_event_files(v.spark, f"{where}/landing"))
    finish(append_stream(events, f"{where}/out", f"{where}/checkpoint"))
    return v.spark.read.parquet(f"{where}/out").select(*EVENT_COLUMNS)


@query("incremental_csv_load", duckdb_with("cust_feed")
       + f"SELECT {CUSTOMER_SQL} FROM cust_feed WHERE kyc_status IS NOT NULL")
def _(v):
    """Two deliveries, three runs: each file is loaded once."""
    lake, where = new_lake(v), run_dir(v.spark, "feed")
    for part in feed_parts(v):
        land_csv(part.select(*CUSTOMER_COLUMNS), f"{where}/landing")
        load_files(lake, "customers", f"{where}/landing", f"{where}/checkpoint")
    load_files(lake, "customers", f"{where}/landing", f"{where}/checkpoint")
    return lake.table("bronze.customers_raw").select(*CUSTOMER_COLUMNS)


@query("csv_batch_scan", duckdb_with("cust_feed") + f"SELECT {CUSTOMER_SQL} FROM cust_feed")
def _(v):
    where = run_dir(v.spark, "feed")
    land_csv(v.cust_feed.select(*CUSTOMER_COLUMNS), where)
    return scan_csv(v.spark, where, SOURCES["customers"].text_schema)


@query("metadata_driven_load", duckdb_with("cust_feed", "fx", "merch_raw", "txn_raw",
                                           loaded_alerts=ALERT_LOADED) + """
SELECT 'customers' AS source, count(*) FILTER (kyc_status IS NOT NULL) AS loaded,
  count(*) FILTER (kyc_status IS NULL) AS rejected FROM cust_feed
UNION ALL SELECT 'exchange_rates', count(*), 0 FROM fx
UNION ALL SELECT 'merchants', count(*) FILTER (merchant_name IS NOT NULL),
  count(*) FILTER (merchant_name IS NULL) FROM merch_raw
UNION ALL SELECT 'fraud_alerts', count(*) FILTER (error_reason = ''),
  count(*) FILTER (error_reason <> '') FROM loaded_alerts
UNION ALL SELECT 'transactions', 2 * count(*) - count(*) FILTER (bad), count(*) FILTER (bad)
FROM (SELECT coalesce(transaction_id IS NULL OR customer_id IS NULL OR card_id IS NULL
  OR merchant_id IS NULL OR amount IS NULL OR currency IS NULL OR transaction_timestamp IS NULL
  OR channel IS NULL OR transaction_status IS NULL OR coalesce(TRY_CAST(amount AS DOUBLE) <= 0, FALSE)
  OR upper(trim(currency)) NOT IN ('CAD', 'USD', 'EUR', 'GBP'), TRUE) AS bad FROM txn_raw)""")
def _(v):
    """All five sources; transactions come as events first and as files into the same table. Both
    land from one copy of the feed, so that its tables are joined once."""
    lake, where = new_lake(v), run_dir(v.spark, "feeds")
    v.txn_raw.select(*EVENT_COLUMNS).write.option("compression", COMPRESSION).parquet(f"{where}/txn")
    txn_raw = v.spark.read.parquet(f"{where}/txn")
    land_events(v, f"{where}/events", txn_raw)
    finish(ingest_events(lake, read_event_files(v.spark, f"{where}/events"), f"{where}/bus"))
    feeds = {
        "customers": v.cust_feed.select(*CUSTOMER_COLUMNS),
        "exchange_rates": v.fx.select(*RATE_COLUMNS),
        "transactions": txn_raw.select(*EVENT_COLUMNS),
        "merchants": v.merch_raw.select(*MERCHANT_COLUMNS),
        "fraud_alerts": v.alerts_raw.select(*ALERT_COLUMNS),
    }
    counts = None
    for source, feed in feeds.items():
        land_csv(feed, f"{where}/{source}")
        load_files(lake, source, f"{where}/{source}", f"{where}/checkpoint/{source}")
        row = lake.table(SOURCES[source].target).select(F.lit(1).alias("l"), F.lit(0).alias("r")).union(
            lake.table(SOURCES[source].quarantine).select(F.lit(0), F.lit(1))
        ).agg(F.sum("l").alias("loaded"), F.sum("r").alias("rejected")).select(
            F.lit(source).alias("source"), "loaded", "rejected")
        counts = row if counts is None else counts.unionByName(row)
    return counts


@query("alert_load_two_stage", duckdb_with(loaded_alerts=ALERT_LOADED)
       + f"SELECT {', '.join(ALERT_COLUMNS)}, error_reason FROM loaded_alerts")
def _(v):
    lake, where = new_lake(v), run_dir(v.spark, "alerts")
    land_csv(v.alerts_raw.select(*ALERT_COLUMNS), f"{where}/landing")
    load_files(lake, "fraud_alerts", f"{where}/landing", f"{where}/checkpoint")
    loaded = lake.table("bronze.fraud_alerts_raw").withColumns({
        "alert_timestamp": F.date_format("alert_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "error_reason": F.lit("")})
    rejected = lake.table("quarantine.invalid_fraud_alerts")
    columns = [*ALERT_COLUMNS, "error_reason"]
    return loaded.select(*columns).unionByName(rejected.select(*columns))


@query("batch_load_history", duckdb_with("cust_feed") + """
SELECT 'load_customers' AS pipeline_name, 'customers' AS source_name,
  'bronze.customers_raw' AS target_table, 'SUCCESS' AS status, 2 AS loads,
  CAST(count(*) AS BIGINT) AS record_count FROM cust_feed""")
def _(v):
    lake, where = new_lake(v), run_dir(v.spark, "feed")
    for part in feed_parts(v):
        land_csv(part.select(*CUSTOMER_COLUMNS), f"{where}/landing")
        load_files(lake, "customers", f"{where}/landing", f"{where}/checkpoint")
    return lake.table(audit.LOADS).groupBy(
        "pipeline_name", "source_name", "target_table", "status").agg(
        F.count_distinct("load_id").cast("int").alias("loads"),
        F.sum("record_count").alias("record_count"))


@query("create_tables", duckdb_with("txn") + """
SELECT transaction_id, customer_id, CAST(NULL AS VARCHAR) AS card_id, merchant_id, amount, currency,
  transaction_timestamp, CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS VARCHAR) AS location_country,
  CAST(NULL AS VARCHAR) AS transaction_status, CAST(NULL AS TIMESTAMP) AS ingestion_timestamp,
  24 AS tables FROM txn""")
def _(v):
    lake = new_lake(v)
    lake.append("silver.transactions", v.txn)
    names = [lake.name(t) for t in DDL if v.spark.catalog.tableExists(lake.name(t))]
    return lake.table("silver.transactions").withColumn("tables", F.lit(len(names)))


@query("append_table", duckdb_with("txn") + """
SELECT transaction_id, amount, transaction_timestamp FROM txn
UNION ALL SELECT transaction_id, amount, transaction_timestamp FROM txn WHERE amount >= 3000""")
def _(v):
    """Two appends, the second one replayed."""
    lake = new_lake(v, "silver.transactions")
    lake.append("silver.transactions", v.txn, "first")
    for _attempt in range(2):
        lake.append("silver.transactions", v.txn.filter("amount >= 3000"), "second")
    return lake.table("silver.transactions").select(
        "transaction_id", "amount", "transaction_timestamp")


@query("overwrite_rebuild", duckdb_with(**MERCH_PARTS)
       + "SELECT * REPLACE (concat(merchant_name, '!') AS merchant_name) FROM merchants")
def _(v):
    """Rebuilt twice from the source, then once from itself."""
    lake = new_lake(v, "silver.merchants")
    for _attempt in range(2):
        lake.rebuild("silver.merchants", merchants(v))
    lake.rebuild("silver.merchants", lake.table("silver.merchants").withColumn(
        "merchant_name", F.concat("merchant_name", F.lit("!"))))
    return lake.table("silver.merchants").drop("ingestion_timestamp")


@query("stream_append_sink", duckdb_with("txn_raw") + f"SELECT {EVENTS_SQL} FROM txn_raw")
def _(v):
    """Events into bronze, and bronze followed by a second stream into another table."""
    lake, where = new_lake(v, "bronze.transactions_raw", audit.HEALTH), run_dir(v.spark, "events")
    land_events(v, f"{where}/landing")
    finish(ingest_events(lake, read_event_files(v.spark, f"{where}/landing"), f"{where}/cp1"))
    table = f"`{lake.prefix}bronze`.`copied`"
    finish(append_to_table(lake.stream("bronze.transactions_raw"), table, f"{where}/cp2"))
    return v.spark.table(table).select(*EVENT_COLUMNS)


@query("table_stream_source", duckdb_with("txn")
       + "SELECT transaction_id, customer_id, amount, transaction_timestamp FROM txn")
def _(v):
    """Two appends to a table, read as a stream before and after the second."""
    lake, where = new_lake(v, "silver.transactions"), run_dir(v.spark, "tail")
    for label, part in (("small", "amount < 3000"), ("large", "amount >= 3000")):
        lake.append("silver.transactions", v.txn.filter(part), label)
        finish(append_stream(
            lake.stream("silver.transactions"), f"{where}/out", f"{where}/checkpoint"))
    return v.spark.read.parquet(f"{where}/out").select(
        "transaction_id", "customer_id", "amount", "transaction_timestamp")


@query("foreach_batch_router", duckdb_with(**TXN_PARTS) + """
SELECT DISTINCT transaction_id, '' AS error_reason FROM txn_clean
UNION ALL SELECT transaction_id, error_reason FROM txn_tagged WHERE error_reason <> ''""")
def _(v):
    lake, where = new_lake(v, *ROUTED), run_dir(v.spark, "route")
    lake.append("bronze.transactions_raw", v.txn_raw, "landed")
    transactions_to_silver(
        lake, lake.stream("bronze.transactions_raw"), f"{where}/checkpoint")
    return lake.table("silver.transactions").select(
        "transaction_id", F.lit("").alias("error_reason")
    ).unionByName(lake.table("quarantine.invalid_transactions").select(
        "transaction_id", "error_reason"))


@query("foreach_batch_router_small_batches", duckdb_with(**TXN_PARTS) + f"""
SELECT {', '.join(EVENT_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {PART},
    ingestion_timestamp NULLS FIRST, {', '.join(c + ' NULLS FIRST' for c in EVENT_COLUMNS)}) AS nth FROM txn_clean) WHERE nth = 1""")
def _(v):
    """Duplicates across deliveries, the files of one per micro-batch: the row that arrived first
    stays. Rows with the same id lie in one file of a delivery, so that its files have no order."""
    lake, where = new_lake(v, *ROUTED), run_dir(v.spark, "route")
    for part in range(3):
        lake.append("bronze.transactions_raw", v.txn_raw.filter(f"{PART} = {part}").repartition(
            DELIVERED, "transaction_id"))
    for _run in range(2):
        transactions_to_silver(
            lake, lake.stream("bronze.transactions_raw", max_files=DELIVERED, arrival=True),
            f"{where}/checkpoint")
    return lake.table("silver.transactions").select(*EVENT_COLUMNS)


@query("load_audit_rows", duckdb_with("cust_feed") + """
SELECT 'load_customers' AS pipeline_name, 'health' AS kind, 'SUCCESS' AS status, 2 AS n,
  count(*) FILTER (kyc_status IS NOT NULL) AS processed,
  count(*) FILTER (kyc_status IS NULL) AS other FROM cust_feed
UNION ALL SELECT 'load_customers', 'reconciliation', 'PASSED', 2, count(*), count(*) FROM cust_feed
UNION ALL SELECT 'load_merchants', 'health', 'FAILED', 1, 0, 0""")
def _(v):
    """Two good loads, a failing one, and a replay, which leaves no second row."""
    lake, where = new_lake(v), run_dir(v.spark, "feed")
    for part in feed_parts(v):
        land_csv(part.select(*CUSTOMER_COLUMNS), f"{where}/landing")
        load_files(lake, "customers", f"{where}/landing", f"{where}/checkpoint")
    land_csv(v.merch_raw.select(*MERCHANT_COLUMNS), f"{where}/merchants")
    v.spark.sql(f"DROP TABLE {lake.name('quarantine.invalid_merchants')}")
    for _attempt in range(2):
        try:
            load_files(lake, "merchants", f"{where}/merchants", f"{where}/checkpoint-m")
        except Exception:
            pass
    health = lake.table(audit.HEALTH).groupBy("pipeline_name", "status").agg(
        F.count("*").cast("int").alias("n"), F.sum("records_processed").alias("processed"),
        F.sum("records_quarantined").alias("other"))
    recon = lake.table(audit.RECONCILIATION).groupBy(
        "pipeline_name", F.col("reconciliation_status").alias("status")).agg(
        F.count("*").cast("int").alias("n"), F.sum("source_count").alias("processed"),
        F.sum("target_count").alias("other"))
    columns = ["pipeline_name", "kind", "status", "n", "processed", "other"]
    return health.withColumn("kind", F.lit("health")).select(*columns).unionByName(
        recon.withColumn("kind", F.lit("reconciliation")).select(*columns))


@query("unparsed_feed_rows_quarantined", duckdb_with("cust_feed", "fx") + f"""
SELECT 'customers' AS source, customer_id AS id, CASE WHEN seq % 7 = 3 THEN 'never'
  ELSE CAST(effective_date AS VARCHAR) END AS value, concat_ws(', ',
  CASE WHEN kyc_status IS NULL THEN 'MISSING_KYC_STATUS' END,
  CASE WHEN seq % 7 = 3 THEN 'MISSING_EFFECTIVE_DATE' END) AS error_reason
FROM cust_feed WHERE kyc_status IS NULL OR seq % 7 = 3
UNION ALL SELECT 'exchange_rates', currency, 'n/a', 'MISSING_RATE_TO_CAD' FROM fx
WHERE currency = 'GBP'""")
def _(v):
    lake, where = new_lake(v), run_dir(v.spark, "feeds")
    feeds = {
        "customers": v.cust_feed.withColumn("effective_date", F.when(
            F.col("seq") % 7 == 3, "never").otherwise(F.col("effective_date").cast("string"))),
        "exchange_rates": v.fx.withColumn("rate_to_cad", F.when(
            F.col("currency") == "GBP", "n/a").otherwise(F.col("rate_to_cad").cast("string"))),
    }
    for source, columns in (("customers", CUSTOMER_COLUMNS), ("exchange_rates", RATE_COLUMNS)):
        land_csv(feeds[source].select(*columns), f"{where}/{source}")
        load_files(lake, source, f"{where}/{source}", f"{where}/checkpoint/{source}")
    people = lake.table("quarantine.invalid_customers").select(
        F.lit("customers").alias("source"), F.col("customer_id").alias("id"),
        F.col("effective_date").alias("value"), "error_reason")
    return people.unionByName(lake.table("quarantine.invalid_exchange_rates").select(
        F.lit("exchange_rates").alias("source"), F.col("currency").alias("id"),
        F.col("rate_to_cad").alias("value"), "error_reason"))


@query("stream_then_backfill", duckdb_with(**TXN_PARTS, **ALERT_PARTS) + """,
once AS (SELECT * FROM txn_clean QUALIFY row_number() OVER (
  PARTITION BY transaction_id ORDER BY customer_id, merchant_id, amount) = 1)
SELECT t.transaction_id, a.alert_id FROM once t LEFT JOIN alerts a
  ON t.customer_id = a.customer_id AND a.alert_timestamp >= t.transaction_timestamp
  AND a.alert_timestamp <= t.transaction_timestamp + INTERVAL 30 MINUTE""")
def _(v):
    """Matches streamed, then backfilled, each twice: every pair once."""
    lake, where = new_lake(v), run_dir(v.spark, "matches")
    clean = rules.split_transactions(v.txn_raw).clean
    lake.append("silver.transactions", history.dedup_first(
        clean, ["transaction_id"], ["customer_id", "merchant_id", "amount"]), "landed")
    land_csv(v.alerts_raw.select(*ALERT_COLUMNS), f"{where}/alerts")
    load_files(lake, "fraud_alerts", f"{where}/alerts", f"{where}/load")
    silver.build_alerts(lake)
    for _attempt in range(2):
        gold.follow_alert_matches(lake, f"{where}/checkpoint")
    for _attempt in range(2):
        gold.build_alert_matches(lake)
    gold.follow_alert_matches(lake, f"{where}/checkpoint")
    return lake.table("gold.transactions_with_fraud_alerts").select("transaction_id", "alert_id")


def event_stream(v: Views) -> DataFrame:
    schema = v.table("events").schema
    return v.spark.readStream.schema(schema).parquet(f"{v.dir}/events.parquet*")


# An unmatched purchase comes out once the watermark (30 minutes behind the slower side) is past
# its 30-minute match window.
STREAM_JOIN_SQL = """
WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
     e AS (SELECT * FROM events WHERE event_type = 'error'),
     mark AS (SELECT least((SELECT max(ts) FROM p), (SELECT max(ts) FROM e)) - INTERVAL 30 MINUTE AS w)
SELECT p.event_id, p.user_id, p.ts AS purchase_ts, p.value, e.event_id AS error_id, e.ts AS error_ts
FROM p LEFT JOIN e ON p.user_id = e.user_id AND e.ts >= p.ts AND e.ts <= p.ts + INTERVAL 30 MINUTE
WHERE e.event_id IS NOT NULL OR p.ts < (SELECT w FROM mark) - INTERVAL 30 MINUTE"""


@query("stream_interval_join", STREAM_JOIN_SQL)
def _(v):
    where = run_dir(v.spark, "match")
    left = event_stream(v).filter("event_type = 'purchase'").select(
        "event_id", "user_id", F.col("ts").alias("purchase_ts"), "value")
    right = event_stream(v).filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_ts"))
    joined = interval_join_stream(left, right, "user_id", "purchase_ts", "error_ts")
    finish(append_stream(joined, f"{where}/out", f"{where}/checkpoint"))
    return v.spark.read.parquet(f"{where}/out")


@query("dedup_stream", duckdb_with(**TXN_PARTS) + "SELECT DISTINCT transaction_id FROM txn_clean")
def _(v):
    lake, where = new_lake(v, "bronze.transactions_raw"), run_dir(v.spark, "dedup")
    lake.append("bronze.transactions_raw", v.txn_raw)
    clean = rules.split_transactions(lake.stream("bronze.transactions_raw")).clean
    once = dedup_stream(clean, ["transaction_id"], "transaction_timestamp")
    finish(append_stream(once, f"{where}/out", f"{where}/checkpoint"))
    return v.spark.read.parquet(f"{where}/out").select("transaction_id")


@query("late_rows", """
WITH early AS (SELECT max(ts) - INTERVAL 30 MINUTE AS w FROM events WHERE event_id % 3 = 0)
SELECT count(*) AS arrived, count(*) FILTER (event_id % 3 <> 0
  AND date_trunc('millisecond', ts) <= (SELECT date_trunc('millisecond', w) FROM early)) AS dropped_late
FROM events""")
def _(v):
    """Two deliveries, the second mostly older than the watermark the first one set."""
    where, events = run_dir(v.spark, "late"), v.table("events")
    schema = events.schema
    dropped = 0
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        events.filter(part).write.mode("append").parquet(f"{where}/landing")
        stream = v.spark.readStream.schema(schema).parquet(f"{where}/landing")
        with late_rows(v.spark) as late:
            dropped += late.of(finish(append_stream(
                dedup_stream(stream, ["event_id"], "ts"), f"{where}/out", f"{where}/checkpoint")))
    return events.agg(F.count("*").alias("arrived")).withColumn(
        "dropped_late", F.lit(dropped).cast("bigint"))


@query("run_health", duckdb_with("txn", "fx", enriched=ENRICHED) + """
SELECT 'transactions_enriched' AS pipeline_name, 'gold' AS layer, 'SUCCESS' AS status,
  count(*) AS records_processed, CAST(0 AS BIGINT) AS records_quarantined, FALSE AS has_error FROM enriched
UNION ALL SELECT 'broken_step', 'gold', 'FAILED', 0, 0, TRUE""")
def _(v):
    lake = new_lake(v)
    lake.append("silver.transactions", v.txn)
    lake.rebuild("silver.exchange_rates", v.fx)
    gold.build_enriched(lake)
    try:
        audit.run_step(lake, "broken_step", "gold",
                       lambda: lake.table("gold.absent_table"))
    except Exception:
        pass
    return lake.table(audit.HEALTH).select(
        "pipeline_name", "layer", "status", "records_processed", "records_quarantined",
        F.col("error_message").isNotNull().alias("has_error"))


@query("reconciliation_table", duckdb_with("txn", "fx", enriched=ENRICHED)
       + recon_sql("transactions_enriched", "silver_to_gold", "txn", "enriched"))
def _(v):
    lake = new_lake(v)
    lake.append("silver.transactions", v.txn)
    lake.rebuild("silver.exchange_rates", v.fx)
    gold.build_enriched(lake)
    return lake.table(audit.RECONCILIATION)


@query("refresh_changed_periods", duckdb_with("txn", "fx", enriched=ENRICHED, labelled=LABELLED) + """
SELECT transaction_date, risk_level AS part, transaction_count, total_amount_cad FROM (
  SELECT transaction_date, risk_level, count(*) AS transaction_count,
    sum(amount_cad) AS total_amount_cad FROM labelled GROUP BY 1, 2)
UNION ALL SELECT CAST(CAST(transaction_timestamp AS DATE) AS VARCHAR), currency, count(*),
  sum(amount_cad) FROM enriched GROUP BY 1, 2""")
def _(v):
    """Whole tables without a third of one day, then that third as a new batch: the tables are
    those of a rebuild, but only that day's month is read and written."""
    lake = Lakehouse(v.spark, run_dir(v.spark, "lake"), prefix=f"run_{uuid.uuid4().hex[:12]}_",
                     period="month")
    lake.create("silver.transactions", "silver.exchange_rates", gold.ENRICHED,
                "gold.daily_transaction_summary", "gold.fraud_risk_summary",
                audit.RECONCILIATION, audit.HEALTH)
    day = F.to_date("transaction_timestamp")
    first = v.txn.agg(F.min(day)).first()[0]
    late = F.coalesce((day == F.lit(first)) & (F.crc32("transaction_id") % 3 == 0), F.lit(False))
    lake.append("silver.transactions", v.txn.where(~late), "landed-0000000000")
    lake.rebuild("silver.exchange_rates", v.fx)
    for build in (gold.build_enriched, gold.build_daily_summary, gold.build_risk_summary):
        build(lake)
    lake.append("silver.transactions", v.txn.where(late), "landed-0000000001")
    gold.refresh_periods(lake)
    parts = [("gold.fraud_risk_summary", "risk_level"), ("gold.daily_transaction_summary", "currency")]
    risk, daily = (lake.table(table).select(
        F.col("transaction_date").cast("string").alias("transaction_date"),
        F.col(part).alias("part"), "transaction_count", "total_amount_cad")
        for table, part in parts)
    return risk.unionByName(daily)


@query("compact_closed_days", duckdb_with("txn") + """
SELECT transaction_id, customer_id, merchant_id, amount, currency, transaction_timestamp, 1 AS packed_per_day
FROM txn""")
def _(v):
    """Twelve micro-batches of two streams, compacted twice with more batches between: every row
    is there once, and each day has one partition."""
    table = "silver.transactions"
    lake = new_lake(v, table)
    dealt = F.pmod(F.crc32("transaction_id"), F.lit(12))
    for i in range(12):
        lake.append(table, v.txn.where(dealt == i), f"landed{i % 2}-{i // 2:010d}")
        if i == 7:
            compaction.compact(lake, table)
    compaction.compact(lake, table)
    days = compaction.packed_days(lake, table)
    return lake.table(table).select(
        "transaction_id", "customer_id", "merchant_id", "amount", "currency",
        "transaction_timestamp").withColumn(
        "packed_per_day", F.lit(int(len(days) == len(set(days)) > 0)))
