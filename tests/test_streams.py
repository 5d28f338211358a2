import json
from datetime import datetime, timedelta

import pytest

from pyspark import StorageLevel
from pyspark.sql import functions as F

from riskloom.operators import rules
from riskloom.plans import gold
from riskloom.session import STATE_CONF, run_dir
from riskloom.sources.events import bus_options, parse_events, read_event_files
from riskloom.sources.seen import SeenKeys
from riskloom.sources.tables import Lakehouse, batch_label
from riskloom.streaming import loads, sinks
from riskloom.streaming.sinks import (
    append_stream, finish, late_rows, route_batches, state_on_disk,
)
from riskloom.streaming.stateful import dedup_stream, interval_join_stream

T0 = datetime(2026, 5, 30, 10, 0)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lakehouse(spark, f"file:{tmp_path}/lake", prefix=f"t{abs(hash(str(tmp_path)))}_")
    lake.create()
    return lake


def write_lines(path, lines):
    path.mkdir(exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.json").write_text(
        "\n".join(json.dumps(line) for line in lines))


def test_bus_options():
    options = bus_options("host:9093", "transactions", "user", "secret", max_offsets=10)
    assert options["subscribe"] == "transactions"
    assert options["startingOffsets"] == "latest"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="user" password="secret";' in options["kafka.sasl.jaas.config"]
    assert options["maxOffsetsPerTrigger"] == "10"


def test_events_parse_alike_in_stream_and_batch(spark, tmp_path):
    event = {"transaction_id": "T1", "customer_id": "C1", "amount": 12.5, "currency": "CAD"}
    write_lines(tmp_path / "in", [{"offset": 1, "value": json.dumps(event)},
                                  {"offset": 2, "value": "{broken"}])
    stream = parse_events(read_event_files(spark, str(tmp_path / "in")), stamp=False)
    finish(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    batch = spark.read.schema("offset bigint, value string").json(str(tmp_path / "in"))
    expected = sorted(parse_events(batch, stamp=False).collect(), key=str)
    got = spark.read.parquet(str(tmp_path / "out")).select(*stream.columns).collect()
    assert sorted(got, key=str) == expected
    rows = {r["event_offset"]: r for r in expected}
    assert rows[1]["amount"] == "12.5" and rows[1]["merchant_id"] is None
    assert rows[2]["transaction_id"] is None and rows[2]["raw_payload"] == "{broken"


def test_replayed_batch_replaces_its_rows(spark, lake, tmp_path):
    df = spark.createDataFrame([("T1", "C1")], "transaction_id string, customer_id string")
    lake.append("bronze.transactions_raw", df)
    handled = []

    def handle(batch, batch_id):
        label = batch_label("t", str(tmp_path / "cp"), batch_id)
        for _attempt in range(2):
            lake.append("quarantine.invalid_transactions", batch, label)
        handled.append(lake.batch("quarantine.invalid_transactions", label).count())

    for _run in range(2):
        finish(route_batches(
            lake.stream("bronze.transactions_raw"), handle, str(tmp_path / "cp")))
    assert handled == [1]
    assert lake.table("quarantine.invalid_transactions").count() == 1
    assert batch_label("t", "a", 0) != batch_label("t", "b", 0)


def test_a_failing_handler_fails_the_query(spark, lake, tmp_path):
    lake.append("bronze.transactions_raw", spark.createDataFrame([("T1",)], "transaction_id string"))

    def handle(batch, batch_id):
        raise RuntimeError("no such luck")

    with pytest.raises(Exception, match="no such luck"):
        finish(route_batches(
            lake.stream("bronze.transactions_raw"), handle, str(tmp_path / "cp"), keep=True))


def test_alert_load_keeps_every_row(spark, lake, tmp_path):
    landing = tmp_path / "alerts"
    landing.mkdir()
    header = "alert_id,customer_id,merchant_id,alert_type,alert_severity,alert_timestamp\n"
    (landing / "a.csv").write_text(
        header + "A1,C1,M1,VELOCITY,HIGH,2026-05-30 10:00:00\n"
                 "A2,C1,M1,VELOCITY, high ,2026-05-30 10:00:00\n"
                 "A3,C1,M1,VELOCITY,URGENT,2026-05-30 10:00:00\n"
                 "A4,,M1,VELOCITY,LOW,never\n")
    counts = loads.load_files(lake, "fraud_alerts", str(landing), str(tmp_path / "cp"))
    assert (counts.loaded, counts.rejected) == (2, 2)
    rejected = {r["alert_id"]: r for r in lake.table("quarantine.invalid_fraud_alerts").collect()}
    assert rejected["A3"]["error_reason"] == "INVALID_ALERT_SEVERITY"
    assert rejected["A4"]["error_reason"] == "MISSING_CUSTOMER_ID, MISSING_ALERT_TIMESTAMP"
    assert rejected["A4"]["alert_timestamp"] == "never"
    again = loads.load_files(lake, "fraud_alerts", str(landing), str(tmp_path / "cp"))
    assert (again.loaded, again.batches) == (0, 0)
    assert lake.table("bronze.fraud_alerts_raw").count() == 2
    files = lake.table("audit.batch_load_history").select("record_count", "source_file").collect()
    assert [(r[0], r[1].endswith("a.csv")) for r in files] == [(4, True)]


def test_raw_severity_check_is_an_option(spark):
    from riskloom.sources.registry import SOURCES
    df = spark.createDataFrame(
        [("A1", "C1", "M1", "V", "high", "2026-05-30 10:00:00")],
        "alert_id string, customer_id string, merchant_id string, alert_type string, "
        "alert_severity string, alert_timestamp string")
    spec = SOURCES["fraud_alerts"]
    assert loads.check_batch(df, spec).clean.count() == 1
    assert loads.check_batch(df, spec, normalise=False).rejected.count() == 1


def test_every_source_can_be_checked(spark):
    from riskloom.sources.registry import SOURCES
    for spec in SOURCES.values():
        empty = spark.createDataFrame([], spec.text_schema).withColumns({
            "ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("f"),
            "load_id": F.lit("l")})
        good, bad = loads.check_batch(empty, spec)
        assert good.count() == bad.count() == 0
        assert "error_reason" in bad.columns


def arrive(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_join_waits_for_the_watermark(spark, tmp_path):
    where = str(tmp_path)
    txn = "id int, k string, lt timestamp"
    alert = "rid int, k string, rt timestamp"

    def run():
        left = spark.readStream.schema(txn).parquet(f"{where}/l")
        right = spark.readStream.schema(alert).parquet(f"{where}/r")
        finish(append_stream(interval_join_stream(left, right, "k", "lt", "rt"),
                             f"{where}/out", f"{where}/cp"))
        return {(r["id"], r["rid"]) for r in spark.read.parquet(f"{where}/out").collect()}

    arrive(spark, f"{where}/l", [(1, "c", T0), (2, "c", T0 + timedelta(minutes=5))], txn)
    arrive(spark, f"{where}/r", [(10, "c", T0 + timedelta(minutes=3)), (11, "d", T0)], alert)
    assert run() == {(1, 10)}
    # both sides move on: row 2 can no longer be matched and comes out alone
    later = T0 + timedelta(hours=3)
    arrive(spark, f"{where}/l", [(3, "z", later)], txn)
    arrive(spark, f"{where}/r", [(12, "y", later)], alert)
    assert run() == {(1, 10), (2, None)}


def test_stream_dedup_spans_batches_and_counts_late_rows(spark, tmp_path):
    where, schema = str(tmp_path), "id string, t timestamp"
    dropped = []
    for rows in ([("a", T0), ("a", T0), ("b", T0)],
                 [("a", T0 + timedelta(minutes=5)), ("c", T0 + timedelta(hours=2))],
                 [("d", T0), ("e", T0 + timedelta(hours=2))]):
        arrive(spark, f"{where}/in", rows, schema)
        stream = dedup_stream(spark.readStream.schema(schema).parquet(f"{where}/in"), ["id"], "t")
        with late_rows(spark) as late:
            dropped.append(late.of(finish(append_stream(stream, f"{where}/out", f"{where}/cp"))))
    out = sorted(r["id"] for r in spark.read.parquet(f"{where}/out").collect())
    assert out == ["a", "b", "c", "e"]
    assert dropped == [0, 0, 1]


def test_late_rows_are_counted_beyond_the_reports_spark_keeps(spark, tmp_path):
    where, schema = str(tmp_path), "id string, t timestamp"
    arrive(spark, f"{where}/in", [("first", T0 + timedelta(hours=5))], schema)
    for k in range(6):
        arrive(spark, f"{where}/in", [(f"late{k}", T0), (f"late{k}b", T0)], schema)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
            f"{where}/in")
        with late_rows(spark) as late:
            query = finish(append_stream(
                dedup_stream(stream, ["id"], "t"), f"{where}/out", f"{where}/cp"))
            # a micro-batch is held against the watermark the one before it began with
            assert late.of(query) == 10
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_silver_does_not_depend_on_the_size_of_micro_batches(spark, lake, tmp_path):
    columns = ("transaction_id string, customer_id string, merchant_id string, amount string, "
               "currency string, transaction_timestamp string, card_id string, channel string, "
               "location_country string, transaction_status string")
    for part in range(4):
        rows = [(f"T{i % 9}", f"C{i}", "M1", str(i + part + 1), "usd", "2026-05-30 10:00:00", "K",
                 "pos", "CA", "ok") for i in range(12)]
        lake.append("bronze.transactions_raw", spark.createDataFrame(rows, columns).coalesce(1))
    found = []
    for size in (None, 1, 3):
        lake.replace("silver.transactions", lake.table("silver.transactions").limit(0), "none")
        for _run in range(2):  # the second one has nothing to do
            loads.transactions_to_silver(
                lake, lake.stream("bronze.transactions_raw", size, arrival=True),
                str(tmp_path / f"cp{size}"))
        found.append(sorted(map(str, lake.table("silver.transactions").drop(
            "silver_processed_at").collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 9
    assert {r[0] for r in lake.table("audit.reconciliation_results").select(
        "reconciliation_status").collect()} == {"PASSED"}


def test_files_and_events_share_a_bronze_table(spark, lake, tmp_path):
    (tmp_path / "events").mkdir()
    (tmp_path / "files").mkdir()
    (tmp_path / "events" / "e.json").write_text('{"offset": 1, "value": "{}"}\n' * 3)
    header = ("transaction_id,customer_id,card_id,merchant_id,amount,currency,"
              "transaction_timestamp,channel,location_country,transaction_status\n")
    (tmp_path / "files" / "f.csv").write_text(
        header + "T1,C1,K,M1,5,CAD,2026-05-30 10:00:00,POS,CA,OK\n" * 7)
    from riskloom.sources.events import read_event_files
    finish(loads.ingest_events(
        lake, read_event_files(spark, str(tmp_path / "events")), str(tmp_path / "cp1")))
    counts = loads.load_files(
        lake, "transactions", str(tmp_path / "files"), str(tmp_path / "cp2"))
    assert counts.loaded == 7 and lake.table("bronze.transactions_raw").count() == 10
    assert sorted(r["pipeline_name"] for r in lake.table("audit.pipeline_health").collect()) == [
        "ingest_events", "load_transactions"]


def test_router_equals_the_batch_split(spark, lake, tmp_path):
    columns = ("transaction_id string, customer_id string, merchant_id string, amount string, "
               "currency string, transaction_timestamp string, card_id string, channel string, "
               "location_country string, transaction_status string")
    rows = [(f"T{i % 7}", "C1" if i % 5 else None, "M1", str(i - 3), "usd", "2026-05-30 10:00:00",
             "K", "pos", "CA", "ok") for i in range(40)]
    df = spark.createDataFrame(rows, columns)
    for half in range(2):
        lake.append("bronze.transactions_raw", df.filter(F.crc32("amount") % 2 == half))
    counts = loads.transactions_to_silver(
        lake, lake.stream("bronze.transactions_raw"), str(tmp_path / "cp"))
    split = rules.split_transactions(df)
    assert counts.rejected == split.rejected.count()
    kept = {r[0] for r in lake.table("silver.transactions").select("transaction_id").collect()}
    assert kept == {r[0] for r in split.clean.select("transaction_id").collect()}
    recon = lake.table("audit.reconciliation_results").collect()
    assert {r["reconciliation_status"] for r in recon} == {"PASSED"}
    assert sum(r["source_count"] for r in recon) == 40


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Session:
        def __init__(self, master, value):
            self.conf = Conf(value)
            self.sparkContext = type("Context", (), {"master": master})

    assert run_dir(Session("spark://m:7077", "/shared/x/"), "a").startswith("/shared/x/a-")
    assert run_dir(Session("local[2]", None), "a") != run_dir(Session("local[2]", None), "a")
    with pytest.raises(RuntimeError):
        run_dir(Session("spark://m:7077", None), "a")


@pytest.fixture
def plain_state(spark):
    """The session without settings of its own for state, as Spark starts it."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k in STATE_CONF:
        spark.conf.unset(k)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_state_and_batches_of_alert_matches_lie_on_disk(spark, lake, tmp_path, plain_state,
                                                        monkeypatch):
    held, among, wide = [], SeenKeys.among, spark.conf.get(sinks.PARTITIONS)
    monkeypatch.setattr(sinks, "STATES", 0)
    monkeypatch.setattr(sinks, "LEAST_STATES", 2)

    def watched(self, batch, label):
        held.append((batch.storageLevel, {k: batch.sparkSession.conf.get(k) for k in STATE_CONF},
                     batch.sparkSession.conf.get(sinks.PARTITIONS),
                     self.spark.conf.get(sinks.PARTITIONS)))
        return among(self, batch, label)

    monkeypatch.setattr(SeenKeys, "among", watched)
    lake.append("silver.transactions", spark.createDataFrame(
        [(f"T{k}", f"C{k}", T0 + timedelta(hours=k)) for k in range(6)],
        "transaction_id string, customer_id string, transaction_timestamp timestamp"))
    lake.append("bronze.fraud_alerts_raw", spark.createDataFrame(
        [(f"A{k}", f"C{k}", "M1", "error", "HIGH", T0 + timedelta(hours=k, minutes=5))
         for k in (1, 5)],
        "alert_id string, customer_id string, merchant_id string, alert_type string, "
        "alert_severity string, alert_timestamp timestamp"))
    gold.follow_alert_matches(lake, str(tmp_path / "cp"))
    # T4's window ends at the watermark, so it waits
    assert sorted(tuple(r) for r in lake.table("gold.transactions_with_fraud_alerts").select(
        "transaction_id", F.coalesce("alert_id", F.lit(""))).collect()) == [
        ("T0", ""), ("T1", "A1"), ("T2", ""), ("T3", ""), ("T5", "A5")]
    offsets = (tmp_path / "cp" / "offsets" / "0").read_text().splitlines()
    begun = json.loads(offsets[1])["conf"]
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert begun[provider] == STATE_CONF[provider] and begun[sinks.PARTITIONS] == "2" < wide
    assert len(held) == 2
    assert all(h == (StorageLevel.DISK_ONLY, STATE_CONF, wide, wide) for h in held)
    assert spark.conf.get(sinks.PARTITIONS) == wide
    assert all(spark.conf.get(k, None) is None for k in STATE_CONF)


def test_settings_of_the_session_for_state_stay(spark, plain_state):
    size = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
    spark.conf.set(size, "999")
    with pytest.raises(KeyError), state_on_disk(spark):
        assert {k: spark.conf.get(k) for k in STATE_CONF} == STATE_CONF | {size: "999"}
        raise KeyError
    assert {k: spark.conf.get(k, None) for k in STATE_CONF} == dict.fromkeys(STATE_CONF) | {
        size: "999"}
