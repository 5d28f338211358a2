"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State of streams on the executors' disks, behind one cache of fixed size for all stores of an
# executor. Spark's default keeps every row of it on the heap; by itself RocksDB has a cache for
# each store and all indexes in memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

# Settings a long-running cluster session should have. Joins and aggregations in this
# package lean on adaptive execution to size partitions and to split skewed ones.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
} | STATE_CONF


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with `CLUSTER_CONF`; keyword names use `__` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session has these settings meanwhile, and then its own again."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, empty folder name for one run, on storage every executor can reach.

    The cluster names the shared folder in `spark.checkpoint.dir`. Only a local master,
    where driver and executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="riskloom-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
