"""JSON events from a message bus, and the same shape from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.schemas import EVENT_DDL, struct


def bus_options(
    servers: str,
    topic: str,
    username: str,
    password: str,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of the `kafka` source for one topic over SASL_SSL with a plain login."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
        "startingOffsets": starting_offsets,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_bus(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded `key, value, offset, ...` frame. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_event_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The bus shape (`value` binary, `offset`) from files of `{"offset": n, "value": "…"}` lines."""
    reader = spark.readStream.schema("offset bigint, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).withColumn("value", F.col("value").cast("binary"))


def parse_events(
    df: DataFrame, schema: StructType | None = None, stamp: bool = True
) -> DataFrame:
    """Flatten the JSON in `value`; keep the text as `raw_payload` and the offset.

    The fields are the ten of a transaction event unless `schema` says otherwise. Text that is
    no JSON gives NULL fields and keeps its row. Works on streams and batches.
    """
    schema = schema or struct(EVENT_DDL)
    parsed = df.select(
        F.col("value").cast("string").alias("raw_payload"),
        F.col("offset").alias("event_offset"),
    ).withColumn("event", F.from_json("raw_payload", schema))
    flat = parsed.select("event.*", "raw_payload", "event_offset")
    return flat.withColumn("ingestion_timestamp", F.current_timestamp()) if stamp else flat
