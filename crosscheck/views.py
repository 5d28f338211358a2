"""The payment feeds the queries run on, derived from the given tables.

`VIEW_SQL` holds text that Spark and DuckDB both run; `{table}` stands for a given table or
another view. Views Spark builds with other means have their own branch in `Views`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW_SQL = {
    "txn_raw": """
SELECT
  CASE WHEN l_orderkey % 41 = 0 THEN NULL
       ELSE concat('T', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS transaction_id,
  CASE WHEN l_orderkey % 43 = 1 THEN NULL ELSE concat('C', CAST(o_custkey AS STRING)) END AS customer_id,
  concat('CARD-', CAST(100 + l_partkey % 900 AS STRING)) AS card_id,
  CASE WHEN l_partkey % 47 = 2 THEN NULL ELSE concat('M', CAST(l_suppkey AS STRING)) END AS merchant_id,
  CASE l_partkey % 53 WHEN 3 THEN NULL WHEN 4 THEN '-12.50' WHEN 5 THEN 'abc' WHEN 6 THEN '0.50'
       ELSE concat(CAST(CAST(FLOOR(l_extendedprice / 15) AS BIGINT) AS STRING), '.50') END AS amount,
  CASE WHEN l_partkey % 20 < 8 THEN 'CAD' WHEN l_partkey % 20 < 13 THEN 'USD'
       WHEN l_partkey % 20 < 16 THEN 'EUR' WHEN l_partkey % 20 < 18 THEN 'GBP'
       WHEN l_partkey % 20 = 18 THEN ' cad ' WHEN l_linenumber = 1 THEN 'XYZ' ELSE NULL END AS currency,
  CASE l_partkey % 59 WHEN 6 THEN 'not-a-date' WHEN 7 THEN NULL
       ELSE CAST(l_shipdate AS STRING) END AS transaction_timestamp,
  CASE l_linenumber % 3 WHEN 0 THEN ' pos' WHEN 1 THEN 'Online' ELSE 'ATM' END AS channel,
  CASE l_suppkey % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'US' WHEN 2 THEN 'UK' ELSE 'AE' END AS location_country,
  CASE l_returnflag WHEN 'R' THEN 'declined' ELSE 'Approved ' END AS transaction_status,
  l_shipdate + INTERVAL 1 DAY AS ingestion_timestamp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "txn": """
SELECT concat('T', CAST(o_orderkey AS STRING)) AS transaction_id,
       concat('C', CAST(o_custkey AS STRING)) AS customer_id,
       concat('M', CAST(o_orderkey % 10 AS STRING)) AS merchant_id,
       CAST(FLOOR(o_totalprice / 70) AS DOUBLE) AS amount,
       CASE o_orderkey % 4 WHEN 0 THEN 'CAD' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS currency,
       o_orderdate AS transaction_timestamp
FROM {orders}""",
    # the 13th of each month has no rate; DuckDB only, see Views.fx
    "fx": """
SELECT c.currency, d.rate_date,
       CASE c.currency WHEN 'CAD' THEN CAST(1 AS DOUBLE)
            WHEN 'USD' THEN CAST(1.25 AS DOUBLE) WHEN 'EUR' THEN CAST(1.5 AS DOUBLE)
            ELSE CAST(1.75 AS DOUBLE) END AS rate_to_cad
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM {orders}) d
CROSS JOIN (SELECT DISTINCT currency FROM {txn}) c
WHERE day(d.rate_date) <> 13""",
    "alerts_raw": """
SELECT CASE WHEN event_id % 61 = 0 THEN NULL ELSE concat('A', CAST(event_id AS STRING)) END AS alert_id,
       concat('C', CAST(user_id AS STRING)) AS customer_id,
       CASE WHEN event_id % 71 = 3 THEN NULL ELSE concat('M', CAST(event_id % 10 AS STRING)) END AS merchant_id,
       concat(' ', event_type) AS alert_type,
       CASE WHEN event_id % 67 = 8 THEN NULL WHEN event_id % 67 = 9 THEN 'URGENT'
            WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 50 THEN 'high'
            WHEN value >= 20 THEN ' Medium' ELSE 'LOW' END AS alert_severity,
       CASE WHEN event_id % 73 = 5 THEN 'never' ELSE CAST(date_trunc('second', ts) AS STRING) END AS alert_timestamp
FROM {events} WHERE event_type = 'error'""",
    "cust_feed": """
SELECT concat('C', CAST(o_custkey AS STRING)) AS customer_id, c_name AS customer_name,
       n_name AS customer_country,
       CASE WHEN o_totalprice >= 400000 THEN 'HIGH' WHEN o_totalprice >= 200000 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_tier,
       CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'PENDING' ELSE NULL END AS kyc_status,
       CAST(o_orderdate AS DATE) AS effective_date, o_orderkey AS seq
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    # every tenth merchant appears twice, as version 1 and 2; DuckDB only, see Views.merch_raw
    "merch_raw": """
SELECT concat('M', CAST(s_suppkey AS STRING)) AS merchant_id,
       CASE WHEN s_suppkey % 37 = 5 THEN NULL ELSE s_name END AS merchant_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'grocery ' WHEN 1 THEN 'Crypto' ELSE 'TRAVEL' END AS merchant_category,
       lower(n_name) AS merchant_country,
       CASE WHEN s_acctbal < 2000 THEN 'high' WHEN s_acctbal < 5000 THEN 'medium' WHEN s_acctbal < 9000 THEN 'low' ELSE NULL END AS risk_category,
       CASE WHEN s_suppkey % 9 = 0 THEN 'true' WHEN s_suppkey % 9 = 1 THEN NULL ELSE 'false' END AS is_high_risk_merchant,
       v.ver AS ver
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
JOIN (SELECT 1 AS ver UNION ALL SELECT 2 AS ver) v ON v.ver = 1 OR s_suppkey % 10 = 0""",
    "pii": """
SELECT CASE WHEN c_custkey % 29 = 4 THEN NULL ELSE concat('C', CAST(c_custkey AS STRING)) END AS customer_id,
       CASE WHEN c_custkey % 31 = 5 THEN 'no-at-sign'
            ELSE concat(lower(c_mktsegment), CAST(c_custkey AS STRING), '@bank.example') END AS email,
       concat('+1-416-555-', CAST(1000 + c_custkey % 9000 AS STRING)) AS phone
FROM {customer}""",
}


class Views:
    """The views as frames over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEW_SQL:
            raise AttributeError(name)
        text = VIEW_SQL[name]
        return self.spark.sql(text, **{t: self.table(t) for t in re.findall(r"\{(\w+)\}", text)})

    @property
    def fx(self) -> DataFrame:
        rate = (F.when(F.col("currency") == "CAD", 1.0).when(F.col("currency") == "USD", 1.25)
                 .when(F.col("currency") == "EUR", 1.5).otherwise(1.75))
        days = self.table("orders").select(
            F.to_date("o_orderdate").alias("rate_date")).distinct()
        return (days.filter(F.day("rate_date") != 13)
                .select(F.explode(F.array(*map(F.lit, ["CAD", "USD", "EUR", "GBP"])))
                        .alias("currency"), "rate_date")
                .withColumn("rate_to_cad", rate))

    @property
    def merch_raw(self) -> DataFrame:
        single = VIEW_SQL["merch_raw"].split("\nJOIN (SELECT 1")[0].replace(
            "v.ver AS ver", "s_suppkey")
        text = self.spark.sql(
            single, supplier=self.table("supplier"), nation=self.table("nation"))
        versions = F.when(F.col("s_suppkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1)))
        return text.withColumn("ver", F.explode(versions)).drop("s_suppkey")


def duckdb_with(*names: str, **extra: str) -> str:
    """A WITH clause that defines the named views, and what they need, for DuckDB."""
    defined: dict[str, str] = {}

    def add(name: str, text: str) -> None:
        for needed in re.findall(r"\{(\w+)\}", text):
            if needed in VIEW_SQL and needed not in defined:
                add(needed, VIEW_SQL[needed])
        defined[name] = re.sub(r"\{(\w+)\}", r"\1", text)

    for name in names:
        if name not in defined:
            add(name, VIEW_SQL[name])
    for name, text in extra.items():
        add(name, text)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in defined.items()) + "\n"
