"""Catalogue tables on plain Spark: create, scan, stream, append, rebuild.

Plain file tables have no transactions. Two conventions give the writes the properties the
jobs need: a rebuild writes a new folder and then points the table at it, so readers never
see a half-written table and a table may be rebuilt from itself; and appends from
micro-batches go to one partition per batch, so a replayed batch replaces its own rows. The
label of a batch names the id of its query too (`batch_label`), so two queries never share one,
not even if a checkpoint is deleted and its path used again.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
import zlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from riskloom.schemas import DDL, LAYERS, conform, schema_of
from riskloom.sources.seen import SeenKeys

COMPRESSION = "zstd"  # about half the size of Spark's default
BATCH, ARRIVAL, PERIOD = "ingest_batch", "_arrival", "event_period"

# Tables fed by appends; the rest are rebuilt as a whole.
APPENDED = frozenset(
    t for t in DDL
    if t.split(".")[0] in ("bronze", "quarantine")
    or t.startswith("audit.")
    or t in ("silver.transactions", "gold.transactions_with_fraud_alerts")
)


# Large rebuilt tables that may be laid out by the day or month of this column (hidden partitions).
DATED = {"gold.transactions_enriched": "transaction_timestamp"}
NO_TIME = datetime.date(1900, 1, 1)  # period of rows without a time
NUMBERED = re.compile(r"(.*)-(\d{10})")  # batch labels of a stream: its batches come in order

# Time columns appended tables are compacted by (`sources/compaction.py`).
CLOCK = {
    "bronze.transactions_raw": "ingestion_timestamp",
    "bronze.customers_raw": "ingestion_timestamp",
    "bronze.exchange_rates_raw": "ingestion_timestamp",
    "bronze.fraud_alerts_raw": "ingestion_timestamp",
    "bronze.merchants_raw": "ingestion_timestamp",
    "silver.transactions": "transaction_timestamp",
    "gold.transactions_with_fraud_alerts": "transaction_timestamp",
    "quarantine.invalid_transactions": "quarantined_at",
    "audit.batch_load_history": "load_timestamp",
    "audit.pipeline_health": "created_at",
    "audit.reconciliation_results": "validation_timestamp",
}
PACKED = "packed-"  # labels of compacted days
HIDDEN = "hidden.batches"

# Tables that take up another's batches one by one, where they are laid out by period.
READERS = {"silver.transactions": ["gold.transactions_enriched"]}

# Appended tables that hold a key once: their batches ask which keys are there already.
KEYS = {
    "silver.transactions": ["transaction_id"],
    "gold.transactions_with_fraud_alerts": ["transaction_id", "alert_id"],
}


def batch_label(source: str, query_id: str, batch_id: int) -> str:
    """Partition of one micro-batch: the same for a replay, different for another query."""
    return f"{source}-{zlib.crc32(query_id.encode()):08x}-{batch_id:010d}"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of a checkpoint when it first started; it stays the same over
    restarts, and a checkpoint made anew gets another one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


class Lakehouse:
    """The tables of one environment under one root folder.

    `period` ("day" or "month") lays out the tables in `DATED` by time, so that single periods
    can be replaced; by default they are replaced as a whole. It is fixed when they are created.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", fmt: str = "parquet",
                 period: str | None = None):
        self.spark, self.root, self.prefix, self.fmt = spark, root.rstrip("/"), prefix, fmt
        if period not in (None, "day", "month"):
            raise ValueError(f"no such period: {period}")
        self.period = period

    def dated(self, table: str) -> bool:
        return self.period is not None and table in DATED

    def period_of(self, column: str) -> Column:
        """First day of the period a date or time lies in."""
        day = F.to_date(column)
        return F.trunc(day, "month").cast("date") if self.period == "month" else day

    def name(self, table: str) -> str:
        layer, short = table.split(".")
        return f"`{self.prefix}{layer}`.`{short}`"

    def create(self, *tables: str) -> None:
        """Create the layers and the given tables (all of them by default) if absent."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` "
                f"LOCATION '{self.root}/{layer}'")
        for table in tables or DDL:
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(table).fields)
            partition = ""
            if table in APPENDED:
                columns += f", `{BATCH}` string"
                partition = f"PARTITIONED BY (`{BATCH}`)"
            elif self.dated(table):
                columns += f", `{PERIOD}` date"
                partition = f"PARTITIONED BY (`{PERIOD}`)"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) "
                f"USING {self.fmt} {partition} LOCATION '{self._fresh(table)}'")

    def _fresh(self, table: str) -> str:
        layer, short = table.split(".")
        return f"{self.root}/{layer}/{short}-{uuid.uuid4().hex}"

    def location(self, table: str) -> str:
        detail = self.spark.sql(f"DESCRIBE FORMATTED {self.name(table)}")
        return detail.filter("col_name = 'Location'").first()["data_type"]

    def beside(self, table: str, run: str) -> str:
        """A folder for packed rows of a table, outside the one its streams read."""
        layer, short = table.split(".")
        return f"{self.root}/{layer}/{short}-packed-{run}"

    def hidden(self, table: str) -> list[str]:
        """Labels of partitions that readers leave out: a compaction adds or drops them."""
        shown = self._property(table, HIDDEN)
        return json.loads(shown) if shown else []

    def hide(self, table: str, labels: Sequence[str]) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} "
                       f"SET TBLPROPERTIES ('{HIDDEN}' = '{json.dumps(list(labels))}')")
        self.spark.catalog.refreshTable(self.name(table))

    def _property(self, table: str, key: str) -> str | None:
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(
            F.col("key") == key).first()
        return shown and shown["value"]

    def readers(self, table: str) -> list[str]:
        """Tables that ask for the batches of `table` they have not had (`unread`)."""
        return [r for r in READERS.get(table, []) if self.dated(r)]

    def _shown(self, table: str) -> DataFrame:
        rows = self.spark.table(self.name(table))
        hidden = self.hidden(table) if table in APPENDED else []
        return rows.where(~F.col(BATCH).isin(hidden)) if hidden else rows

    def table(self, table: str) -> DataFrame:
        return self._shown(table).drop(BATCH, PERIOD)

    def days(self, table: str, first: datetime.date, last: datetime.date) -> DataFrame:
        """Rows of an appended table from `first` to `last`; packed partitions of other days are
        pruned, batches not yet compacted are read by their statistics."""
        after = last + datetime.timedelta(days=1)
        label, time = F.col(BATCH), F.col(CLOCK[table])
        loose = ~label.startswith(PACKED)
        packed = (label >= f"{PACKED}{first}") & (label < f"{PACKED}{after}")
        return self._shown(table).where(
            (loose | packed) & (time >= F.lit(first).cast("timestamp"))
            & (time < F.lit(after).cast("timestamp"))).drop(BATCH)

    def periods(self, table: str, periods: Sequence[datetime.date]) -> DataFrame:
        """Rows of some periods of a dated table; the others' folders aren't listed."""
        return self.spark.table(self.name(table)).where(
            F.col(PERIOD).isin(list(periods))).drop(PERIOD)

    def stream(
        self, table: str, max_files: int | None = None, arrival: bool = False
    ) -> DataFrame:
        """Rows as they are appended. The files are read with the declared schema.

        `arrival` adds `ARRIVAL`, the place of a row's file in the order files are taken up.
        """
        schema = schema_of(table)
        if table in APPENDED:
            schema = StructType(schema.fields).add(BATCH, StringType())
        reader = self.spark.readStream.format(self.fmt).schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.load(self.location(table)).drop(BATCH)
        return rows.withColumn(ARRIVAL, F.struct(
            "_metadata.file_modification_time", "_metadata.file_path")) if arrival else rows

    def seen(self, table: str) -> SeenKeys:
        """The index of the keys of a table in `KEYS`; `append` keeps it."""
        layer, short = table.split(".")
        return SeenKeys(self.spark, self.name(table), f"{self.root}/{layer}/{short}-seen",
                        KEYS[table])

    def batches(self, table: str) -> list[str]:
        """Labels of the appended batches a table shows."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return [row["partition"].removeprefix(f"{BATCH}=") for row in shown]

    def replace(self, table: str, df: DataFrame, batch: str) -> None:
        """Make `df` the only batch of an appended table."""
        if table in KEYS:
            self.seen(table).start()
        self.append(table, df, batch)
        for old in self.batches(table):
            if old != batch:
                self.spark.sql(f"ALTER TABLE {self.name(table)} "
                               f"DROP IF EXISTS PARTITION (`{BATCH}` = '{old}')")
        self.spark.catalog.refreshTable(self.name(table))

    def append(self, table: str, df: DataFrame, batch: str | None = None) -> None:
        """Append rows; with the same `batch` a second time, replace that batch's rows."""
        rows = conform(df, table)
        if table not in APPENDED:
            rows.write.insertInto(self.name(table))
            return
        # written as a folder, so that rows may come from the table's other batches
        label = batch or uuid.uuid4().hex
        if label.startswith(PACKED):
            raise ValueError(f"{label}: the name of a compacted day")
        rows.write.format(self.fmt).option("compression", COMPRESSION).mode("overwrite").save(
            f"{self.location(table)}/{BATCH}={label}")
        self.spark.sql(f"ALTER TABLE {self.name(table)} "
                       f"ADD IF NOT EXISTS PARTITION (`{BATCH}` = '{label}')")
        self.spark.catalog.refreshTable(self.name(table))
        if table in KEYS:
            self.seen(table).add(self.batch(table, label), label)

    def batch(self, table: str, batch: str) -> DataFrame:
        """Rows of one appended batch, as they are on disk now; no other partition is listed."""
        reader = self.spark.read.format(self.fmt).schema(schema_of(table))
        try:
            return reader.load(f"{self.location(table)}/{BATCH}={batch}")
        except AnalysisException as error:
            # overwriting a batch with no rows leaves no folder
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema_of(table))

    def rebuild(self, table: str, df: DataFrame) -> None:
        """Replace all rows of a table; `df` may read the table itself."""
        if table in APPENDED:
            raise ValueError(f"{table} is fed by appends and is not rebuilt")
        if self.dated(table):
            self.replace_periods(table, df)
            return
        path = self._fresh(table)
        conform(df, table).write.format(self.fmt).option("compression", COMPRESSION).save(path)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name(table))

    def replace_periods(
        self, table: str, df: DataFrame, periods: Sequence[datetime.date] | None = None
    ) -> None:
        """Replace some periods (all by default) of a dated table by their rows in `df`, which may
        read the table itself.

        The new periods are written beside the old ones, in files of even size whatever the number
        of micro-batches they come from; then each partition is pointed at its new folder. So a
        reader meets a period as it was or as it is, a failed call leaves all as it was or can be
        called again, and the other periods aren't touched.
        """
        rows = conform(df, table).withColumn(
            PERIOD, F.coalesce(self.period_of(DATED[table]), F.lit(NO_TIME)))
        if periods is not None:
            rows = rows.where(F.col(PERIOD).isin(list(periods)))
        path, name = self._fresh(table), self.name(table)
        rows.hint("rebalance", PERIOD).write.format(self.fmt).option(
            "compression", COMPRESSION).partitionBy(PERIOD).save(path)
        try:
            written = self.spark.read.format(self.fmt).schema(rows.schema).load(path)
            new = {str(r[PERIOD]) for r in written.select(PERIOD).distinct().collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # no row, no folder
                raise
            new = set()
        old = {r["partition"].removeprefix(f"{PERIOD}=")
               for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        scope = old if periods is None else old & set(map(str, periods))
        added = " ".join(f"PARTITION (`{PERIOD}` = DATE'{p}') LOCATION '{path}/{PERIOD}={p}'"
                         for p in sorted(new - old))
        if added:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        for p in sorted(new & old):
            self.spark.sql(f"ALTER TABLE {name} PARTITION (`{PERIOD}` = DATE'{p}') "
                           f"SET LOCATION '{path}/{PERIOD}={p}'")
        for p in sorted(scope - new):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{PERIOD}` = DATE'{p}')")
        self.spark.catalog.refreshTable(name)

    def unread(self, table: str, reader: str) -> tuple[list[str], str]:
        """Labels of the batches of `table` that `reader` has not taken up, and the mark to set
        once it has. A mark has the last batch of each stream and the labels of other appends."""
        shown = self._property(reader, f"read.{table}")
        mark = json.loads(shown) if shown else {}
        new, last = [], dict(mark)
        for label in self.batches(table):
            if label.startswith(PACKED):  # only batches that were taken up are compacted
                continue
            numbered = NUMBERED.fullmatch(label)
            stream, at = (numbered[1], int(numbered[2])) if numbered else (label, 0)
            if at > mark.get(stream, -1):
                new.append(label)
                last[stream] = max(at, last.get(stream, -1))
        return new, json.dumps(last)

    def mark_read(self, table: str, reader: str, mark: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(reader)} "
                       f"SET TBLPROPERTIES ('read.{table}' = '{mark}')")

    def rows_of(self, table: str, labels: Sequence[str]) -> DataFrame:
        """Rows of some appended batches."""
        return self.spark.table(self.name(table)).where(
            F.col(BATCH).isin(list(labels))).drop(BATCH)
