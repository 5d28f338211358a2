import pytest

from pyspark.sql import functions as F

from riskloom.functions import privacy, risk, text
from riskloom.operators import contract, rules

TXN = ("transaction_id string, customer_id string, card_id string, merchant_id string, "
       "amount string, currency string, transaction_timestamp string, channel string, "
       "location_country string, transaction_status string, ingestion_timestamp timestamp, "
       "raw_payload string, event_offset bigint")


def txn(spark, **change):
    row = dict(transaction_id="T1", customer_id="C1", card_id="K1", merchant_id="M1", amount="10",
               currency="CAD", transaction_timestamp="2026-05-30 10:00:00", channel="pos",
               location_country="CA", transaction_status="approved")
    row.update(change)
    names = [c.split()[0] for c in TXN.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names)], TXN)


@pytest.mark.parametrize("change, reason", [
    (dict(currency=None), "INVALID_CURRENCY"),
    (dict(currency="XYZ"), "INVALID_CURRENCY"),
    (dict(transaction_timestamp="not-a-date"), "INVALID_TIMESTAMP"),
    (dict(transaction_timestamp=None), "INVALID_TIMESTAMP"),
    (dict(amount="0"), "INVALID_AMOUNT"),
    (dict(amount="-1"), "INVALID_AMOUNT"),
    (dict(amount="abc"), "INVALID_AMOUNT"),
    (dict(amount=None), "INVALID_AMOUNT"),
    (dict(merchant_id=None), "MISSING_MERCHANT_ID"),
    (dict(transaction_id=None, customer_id=None, amount=None),
     "PARSE_FAILED, MISSING_TRANSACTION_ID, MISSING_CUSTOMER_ID, INVALID_AMOUNT"),
])
def test_rejected_transactions_keep_their_text(spark, change, reason):
    clean, rejected = rules.split_transactions(txn(spark, **change))
    assert clean.count() == 0
    row = rejected.first()
    assert row["error_reason"] == reason
    assert all(row[k] == v for k, v in change.items())
    assert "raw_payload" not in rejected.columns


def test_clean_transactions_are_typed_and_standardised(spark):
    clean, rejected = rules.split_transactions(
        txn(spark, currency=" cad ", amount="0.5", transaction_timestamp="2026-05-30T12:00:00+02:00"))
    row = clean.first()
    assert rejected.count() == 0
    assert (row["currency"], row["amount"], row["channel"], row["transaction_status"]) == (
        "CAD", 0.5, "POS", "APPROVED")
    utc = clean.select(F.date_format("transaction_timestamp", "HH:mm").alias("t")).first()["t"]
    assert utc == "10:00"


def test_raw_currency_check_is_an_option(spark):
    clean, rejected = rules.split_transactions(txn(spark, currency=" cad "), normalise=False)
    assert (clean.count(), rejected.first()["error_reason"]) == (0, "INVALID_CURRENCY")


def test_older_rules_accept_a_missing_amount(spark):
    assert rules.quarantine_transactions_v1(txn(spark, amount=None)).count() == 0
    row = rules.quarantine_transactions_v1(
        txn(spark, currency=" xyz ", transaction_timestamp="x")).first()
    assert row["error_reason"] == "INVALID_CURRENCY, INVALID_TRANSACTION_TIMESTAMP"
    assert row["currency"] == "XYZ"


def test_domain_errors_and_split(spark):
    df = spark.createDataFrame(
        [(5.0, "CAD"), (1.0, "USD"), (2.0, "EUR"), (-1.0, "ZZZ"), (-1.0, "CAD")],
        "amount double, currency string")
    tagged = rules.domain_errors(df, rules.rules_from_config([
        {"column": "amount", "op": "gt", "value": 0, "error": "INVALID_AMOUNT"},
        {"column": "currency", "op": "isin", "values": ["CAD", "USD", "EUR"],
         "error": "INVALID_CURRENCY"}]))
    errors = [r["quality_errors"] for r in tagged.collect()]
    assert errors == [[], [], [], ["INVALID_AMOUNT", "INVALID_CURRENCY"], ["INVALID_AMOUNT"]]
    good, bad = rules.split_tagged(tagged)
    assert (good.count(), bad.count()) == (3, 2)
    assert good.columns == df.columns
    assert bad.first()["error_reason"] == "INVALID_AMOUNT, INVALID_CURRENCY"


def test_config_rules_let_null_pass_and_refuse_unknown_ops(spark):
    df = spark.createDataFrame([(None, None)], "amount double, currency string")
    entries = [{"column": "amount", "op": "gt", "value": 0, "error": "A"},
               {"column": "currency", "op": "isin", "values": ["it's"], "error": "C"}]
    assert rules.split(df, rules.rules_from_config(entries)).clean.count() == 1
    with pytest.raises(ValueError, match="unknown rule op"):
        rules.rules_from_config([{"column": "a", "op": "between", "error": "E"}])


def test_required_split_is_total(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", "x")], "k string, v string")
    good, bad = rules.split_required(df, ["k", "v"])
    assert good.count() == 1
    assert sorted(r["error_reason"] for r in bad.collect()) == ["MISSING_K, MISSING_V", "MISSING_V"]
    assert rules.split_required(df, []).clean.count() == 3


def test_alert_and_merchant_rules(spark):
    alerts = spark.createDataFrame(
        [("A1", "C1", "M1", " fraud", "high ", "2026-05-30 10:00:00"),
         ("A2", "C1", "M1", "fraud", None, "2026-05-30 10:00:00"),
         (None, None, "M1", "fraud", "LOW", None)],
        "alert_id string, customer_id string, merchant_id string, alert_type string, "
        "alert_severity string, alert_timestamp string")
    clean, rejected = rules.split_fraud_alerts(alerts)
    assert [(r["alert_type"], r["alert_severity"]) for r in clean.collect()] == [("FRAUD", "HIGH")]
    assert sorted(r["error_reason"] for r in rejected.collect()) == [
        "INVALID_ALERT_SEVERITY",
        "PARSE_FAILED, MISSING_ALERT_ID, MISSING_CUSTOMER_ID, INVALID_ALERT_TIMESTAMP"]
    merchants = spark.createDataFrame(
        [("M1", "One", "food", " ca", "low", "true", "L1"), (None, None, "x", None, None, None, "L1")],
        "merchant_id string, merchant_name string, merchant_category string, "
        "merchant_country string, risk_category string, is_high_risk_merchant string, load_id string")
    clean, rejected = rules.split_merchants(merchants)
    row = clean.first()
    assert (row["merchant_country"], row["is_high_risk_merchant"]) == ("CA", True)
    assert rejected.first()["error_reason"].startswith("PARSE_FAILED, MISSING_MERCHANT_ID")
    assert "load_id" not in clean.columns and "load_id" in rejected.columns


def test_contract_names_every_fault(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, c bigint")
    assert contract.contract_issues(df, {"a": "integer", "b": "string", "c": "long"}) == []
    issues = contract.contract_issues(df, {"a": "bigint", "b": "string", "d": "date"})
    assert issues == [("MISSING", "d", "date", None), ("UNEXPECTED", "c", None, "bigint"),
                      ("WRONG_TYPE", "a", "bigint", "int")]
    assert len(contract.contract_issues(df, {"a": "int"}, strict=False)) == 0
    with pytest.raises(contract.ContractError, match="MISSING d"):
        contract.validate_contract(df, {"d": "date"}, strict=False)
    with pytest.raises(contract.ContractError):
        contract.require_columns(df, ["a", "z"])
    assert contract.contract_report(df, {"a": "int", "b": "string", "c": "bigint"}).count() == 0


def test_risk_labels(spark):
    df = spark.createDataFrame([(5000.0,), (4999.99,), (1000.0,), (999.99,), (None,)], "a double")
    got = [r[0] for r in df.select(risk.amount_risk_label("a")).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    df = spark.createDataFrame([("LOW", 1), (None, 0), ("MEDIUM", 0)], "t string, n bigint")
    assert [r[0] for r in df.select(risk.customer_risk_flag("t", "n")).collect()] == [
        "HIGH", "LOW", "MEDIUM"]
    df = spark.createDataFrame([(None, None, 0), ("LOW", True, 0), ("MEDIUM", False, 0)],
                               "c string, f boolean, n bigint")
    assert [r[0] for r in df.select(risk.merchant_risk_flag("c", "f", "n")).collect()] == [
        "LOW", "HIGH", "MEDIUM"]


def test_masking(spark):
    df = spark.createDataFrame(
        [("C1", "john@gmail.com", "+1-416"), (None, "no-at-sign", "x"), ("C2", "@x", None)],
        "customer_id string, email string, phone string")
    rows = privacy.mask_customer_pii(df, "s").collect()
    assert [r["email"] for r in rows] == ["***@gmail.com", "***", "@x"]
    assert [r["phone"] for r in rows] == ["+*-***", "x", None]
    assert rows[1]["customer_id_hash"] is None and len(rows[0]["customer_id_hash"]) == 64
    assert privacy.apply_policy(df, {"phone": "drop"}, "s").columns == ["customer_id", "email"]
    with pytest.raises(ValueError):
        privacy.apply_policy(df, {"phone": "encrypt"}, "s")


def test_text_helpers(spark):
    df = spark.createDataFrame([(None, 1), ("a", None)], "k string, v int")
    assert text.require_not_null(df, []).count() == 2
    assert text.require_not_null(df, ["k"]).count() == 1
    filled = text.zero_fill(df, "v")
    assert dict(filled.dtypes)["v"] == "int" and [r["v"] for r in filled.collect()] == [1, 0]
