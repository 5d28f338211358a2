"""From landed files to gold, over the tables of one lakehouse."""

import json

import pytest

from pyspark.sql import functions as F

from riskloom.operators import audit
from riskloom.plans import gold, silver
from riskloom.schemas import DDL, schema_of
from riskloom.sources.events import read_event_files
from riskloom.sources.tables import Lakehouse
from riskloom.streaming import loads
from riskloom.streaming.sinks import finish

CUSTOMERS = """customer_id,customer_name,customer_country,customer_risk_tier,kyc_status,effective_date
C001,Ann,CA,LOW,VERIFIED,2026-01-01
C001,Ann,CA,HIGH,VERIFIED,2026-03-01
C002,Bob,US,MEDIUM,PENDING,2026-01-01
C003,Cy,UK,LOW,,2026-01-01
"""
MERCHANTS = """merchant_id,merchant_name,merchant_category,merchant_country,risk_category,is_high_risk_merchant
M001,Shop,grocery,ca,low,false
M002,Coins,crypto,us,high,true
,Nobody,travel,uk,low,false
"""
RATES = """currency,rate_date,rate_to_cad
USD,2026-05-30,1.25
CAD,2026-05-30,1
 gbp,2026-05-30,bad
"""
ALERTS = """alert_id,customer_id,merchant_id,alert_type,alert_severity,alert_timestamp
A1,C002,M001,VELOCITY,HIGH,2026-05-30 10:10:00
A2,C001,M004,AMOUNT,URGENT,2026-05-30 11:00:00
"""


def event(i, **change):
    return dict(transaction_id=f"T{i}", customer_id="C002", card_id="K", merchant_id="M001",
                amount=100 * i, currency="USD", transaction_timestamp="2026-05-30T10:00:00+00:00",
                channel="POS", location_country="CA", transaction_status="APPROVED") | change


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("flow")
    lake = Lakehouse(spark, f"file:{base}/lake", prefix="flow_")
    lake.create()
    lake.create()  # a second time changes nothing
    for source, text in (("customers", CUSTOMERS), ("merchants", MERCHANTS),
                         ("exchange_rates", RATES), ("fraud_alerts", ALERTS)):
        (base / source).mkdir()
        (base / source / "f.csv").write_text(text)
        loads.load_files(lake, source, str(base / source), str(base / "cp" / source))
    (base / "events").mkdir()
    events = [event(1), event(1), event(60), event(3, currency="GBP"), event(4, amount=-1)]
    (base / "events" / "e.json").write_text("\n".join(
        json.dumps({"offset": n, "value": json.dumps(e)}) for n, e in enumerate(events)))
    for _run in range(2):
        finish(loads.ingest_events(
            lake, read_event_files(spark, str(base / "events")), str(base / "cp" / "bronze")))
    assert lake.table("bronze.transactions_raw").count() == len(events)
    loads.transactions_to_silver(
        lake, lake.stream("bronze.transactions_raw"), str(base / "cp" / "silver"))
    silver.build_customers(lake)
    silver.build_rates(lake)
    silver.build_merchants(lake)
    silver.build_alerts(lake)
    gold.build_all(lake)
    return lake


def test_all_tables_have_their_declared_columns(lake):
    assert len(DDL) == 24
    for table in DDL:
        declared = [(f.name, f.dataType) for f in schema_of(table).fields]
        assert [(f.name, f.dataType) for f in lake.table(table).schema.fields][:len(declared)] == declared


def test_silver(lake):
    rows = lake.table("silver.customers_scd2").orderBy("customer_id", "valid_from").collect()
    assert [(r["customer_id"], r["customer_risk_tier"], r["is_current"]) for r in rows] == [
        ("C001", "LOW", False), ("C001", "HIGH", True), ("C002", "MEDIUM", True)]
    assert lake.table("quarantine.invalid_customers").first()["error_reason"] == "MISSING_KYC_STATUS"
    assert {r["currency"] for r in lake.table("silver.exchange_rates").collect()} == {"USD", "CAD"}
    assert lake.table("silver.merchants").count() == 2
    assert sorted(r[0] for r in lake.table("silver.transactions").select("transaction_id").collect()) == [
        "T1", "T3", "T60"]


def test_gold(lake):
    enriched = {r["transaction_id"]: r for r in lake.table("gold.transactions_enriched").collect()}
    assert enriched["T60"]["amount_cad"] == 7500.0 and enriched["T3"]["amount_cad"] is None
    levels = {r["risk_level"]: r["transaction_count"]
              for r in lake.table("gold.fraud_risk_summary").collect()}
    assert levels == {"HIGH": 1, "LOW": 2}
    matched = lake.table("gold.transactions_with_fraud_alerts").collect()
    assert {(r["transaction_id"], r["alert_id"]) for r in matched} == {
        ("T1", "A1"), ("T3", "A1"), ("T60", "A1")}
    people = {r["customer_id"]: r for r in lake.table("gold.customer_risk_360").collect()}
    assert people["C001"]["overall_risk_flag"] == "HIGH"
    assert (people["C002"]["transaction_count"], people["C002"]["alert_count"]) == (3, 1)
    shops = {r["merchant_id"]: r for r in lake.table("gold.merchant_risk_summary").collect()}
    assert shops["M001"]["distinct_customers"] == 1 and shops["M002"]["overall_risk_flag"] == "HIGH"


def test_streamed_matches(lake, tmp_path):
    name = "gold.transactions_with_fraud_alerts"
    before = lake.table(name).count()
    # the backfill has the pairs already
    assert gold.follow_alert_matches(lake, str(tmp_path / "cp")).processed == 0
    lake.replace(name, lake.table(name).limit(0), "none")
    outcome = gold.follow_alert_matches(lake, str(tmp_path / "cp2"))
    # the matches come out at once, unmatched rows only behind the watermark
    assert outcome.processed == lake.table(name).count() == before == 3
    assert gold.follow_alert_matches(lake, str(tmp_path / "cp2")).processed == 0
    assert "transactions_with_fraud_alerts" not in gold.build_all(lake)
    gold.build_alert_matches(lake)
    assert lake.table(name).count() == 3


def test_running_again_changes_no_rows(lake):
    tables = [t for t in DDL if not t.startswith("audit")]
    before = {t: lake.table(t).count() for t in tables}
    silver.build_merchants(lake)
    silver.build_alerts(lake)
    silver.build_customers(lake)
    gold.build_all(lake)
    assert {t: lake.table(t).count() for t in tables} == before


def test_audit(lake):
    health = lake.table(audit.HEALTH).collect()
    assert {r["status"] for r in health} == {"SUCCESS"}
    assert all(r["duration_seconds"] >= 0 for r in health)
    with pytest.raises(RuntimeError, match="boom"):
        audit.run_step(lake, "bad", "gold", lambda: (_ for _ in ()).throw(RuntimeError("boom")))
    failed = lake.table(audit.HEALTH).filter("status = 'FAILED'").first()
    assert (failed["pipeline_name"], failed["error_message"]) == ("bad", "boom")
    results = {(r["pipeline_name"], r["layer"]): r["reconciliation_status"]
               for r in gold.reconcile_layers(lake).collect()}
    # plain counts differ wherever rows were rejected, which the balanced check allows for
    assert results[("transactions", "silver_to_gold")] == "PASSED"
    assert results[("transactions", "bronze_to_silver")] == "FAILED"
    written = lake.table(audit.RECONCILIATION)
    assert written.filter("pipeline_name = 'merchants_silver'").first()["reconciliation_status"] == "PASSED"


def test_other_file_formats(spark, tmp_path):
    lake = Lakehouse(spark, f"file:{tmp_path}", prefix="orc_", fmt="orc")
    lake.create("silver.exchange_rates", "bronze.customers_raw")
    rates = spark.createDataFrame([("USD", "2026-01-01", "1.5")],
                                  "currency string, rate_date string, rate_to_cad string")
    lake.rebuild("silver.exchange_rates", rates)
    lake.rebuild("silver.exchange_rates", lake.table("silver.exchange_rates"))
    lake.append("silver.exchange_rates", rates)
    assert lake.table("silver.exchange_rates").agg(F.sum("rate_to_cad")).first()[0] == 3.0
    lake.append("bronze.customers_raw", rates.withColumn("customer_id", F.lit("C1")), "b")
    assert lake.batch("bronze.customers_raw", "b").count() == 1
    with pytest.raises(ValueError):
        lake.rebuild("bronze.customers_raw", rates)
