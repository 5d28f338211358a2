"""What the physical plans of the batch queries must not contain."""

import pytest

from crosscheck import batch  # noqa: F401
from crosscheck.batch import alerts, customer_history, enriched
from crosscheck.views import Views
from riskloom.operators import history, joins, profiles

SF = "/root/testdata/sf0.001"
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
          "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def flagship(v):
    return {
        "fx": enriched(v),
        "risk": profiles.fraud_risk_summary(enriched(v)),
        "customer": profiles.customer_risk_360(customer_history(v.cust_feed), v.txn, alerts(v)),
        "history": customer_history(v.cust_feed),
        "interval": joins.interval_join(
            *batch.purchases_and_errors(v), "user_id", "purchase_ts", "error_ts"),
        "asof": joins.asof_lookup(v.txn, customer_history(v.cust_feed), ["customer_id"],
                                  "transaction_timestamp", ["kyc_status"]),
    }


@pytest.mark.parametrize("name", ["fx", "risk", "customer", "history", "interval", "asof"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(flagship(Views(spark, SF))[name])
    assert not [b for b in BANNED if b in text]


def test_dedup_shrinks_hot_keys_before_the_shuffle(spark):
    text = plan(history.dedup_latest(Views(spark, SF).cust_feed, ["customer_id"], ["seq"]))
    below = text[text.index("Exchange hashpartitioning(customer_id"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_summary_reads_only_its_columns(spark):
    text = plan(profiles.fraud_risk_summary(enriched(Views(spark, SF))))
    schema = [line for line in text.splitlines() if "ReadSchema" in line and "o_totalprice" in line]
    assert schema and all("o_custkey" not in line for line in schema)


def test_current_slice_is_pushed_to_the_scan(spark, tmp_path):
    customer_history(Views(spark, SF).cust_feed).write.parquet(str(tmp_path / "h"))
    text = plan(history.scd2_current(spark.read.parquet(str(tmp_path / "h"))))
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in text


def test_small_change_set_leaves_a_large_target_unshuffled(spark, tmp_path):
    """With broadcasts by measured size only, the target's rows meet no exchange."""
    feed = Views(spark, SF).cust_feed
    customer_history(feed).write.parquet(str(tmp_path / "h"))
    target = spark.read.parquet(str(tmp_path / "h"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = history.merge_type2(
            target, feed.filter("seq % 50 = 0"), ["customer_id"], batch.TRACKED,
            "effective_date", ["seq"])
        new = history.anti_join_new_keys(feed.filter("seq % 50 = 0"), target, ["customer_id"])
        for df in (merged, new):
            lines = plan(df).split("== Initial Plan ==")[-1].splitlines()
            # the feed's own scans read o_*, c_* and n_* columns
            scans = [n for n, line in enumerate(lines)
                     if "FileScan parquet [customer_id#" in line]
            assert scans
            for n in scans:
                # the operators above this scan, outermost last
                depth, above = len(lines[n]) - len(lines[n].lstrip(" :+-")), []
                for line in reversed(lines[:n]):
                    level = len(line) - len(line.lstrip(" :+-"))
                    if level < depth:
                        above.append(line)
                        depth = level
                joined = next((i for i, line in enumerate(above) if "BroadcastHashJoin" in line), None)
                shuffled = next((i for i, line in enumerate(above) if "Exchange hash" in line), None)
                assert shuffled is None or joined is not None and joined < shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
