"""Writing streams: triggers, checkpoints, append sinks and per-batch routing."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.session import STATE_CONF, settings
from riskloom.sources.tables import COMPRESSION

Trigger = dict[str, object]

PARTITIONS = "spark.sql.shuffle.partitions"
STATES, LEAST_STATES = 4, 24

# stop at the end of the input; `{"processingTime": "10 seconds"}` keeps a stream running
DRAIN: Trigger = {"availableNow": True}


def append_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: Trigger = DRAIN, fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a folder. The sink's log makes each micro-batch appear once, and
    readers of the folder see only finished batches."""
    writer = (df.writeStream.format(fmt).option("compression", COMPRESSION).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(**trigger))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def append_to_table(
    df: DataFrame, table: str, checkpoint: str, trigger: Trigger = DRAIN, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to a catalogue table, created on first use."""
    return (df.writeStream.format(fmt).option("compression", COMPRESSION).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**trigger).toTable(table))


def route_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger = DRAIN,
    keep: bool = False,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> StreamingQuery:
    """Hand each micro-batch to `handle(batch, batch_id)`.

    With `keep` the batch stays on the executors while the handler runs, so that several
    writes parse their source once; that pays for text sources and for streams with state, whose
    operators would run again for every write, while a columnar table is read again about as fast.
    `level` says where it stays. A batch may be handed over again after a failure: handlers write
    under the batch id so that a replay replaces its first attempt.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if not keep:
            handle(batch, batch_id)
            return
        batch.persist(level)
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    return (df.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that run meanwhile keep their state as `STATE_CONF` says, whatever the session's
    default, so that it may outgrow the executors' memory. What the session has set itself stays,
    and so does the kind of state a checkpoint began with.

    An open store takes 1.5 MB beside the cache, and a join has four for each partition of its
    state. A partition on disk may be large, so a new query has `STATES` for each task that runs at
    once, at least `LEAST_STATES`, where `PARTITIONS` says more.
    """
    values = {k: v for k, v in STATE_CONF.items() if spark.conf.get(k, None) is None}
    most = max(LEAST_STATES, STATES * spark.sparkContext.defaultParallelism)
    if int(spark.conf.get(PARTITIONS)) > most:
        values[PARTITIONS] = str(most)
    with settings(spark, values):
        yield


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; a failure of the query is raised here."""
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Counts the rows stateful operators left out because the watermark had passed them.

    Every progress event of every query is counted, however many reports Spark keeps.
    """

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self._dropped[run] = self._dropped.get(run, 0) + sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query: StreamingQuery, patience: float = 60) -> int:
        """Rows one run of a query dropped. Its end is the last event, so that is waited for."""
        run = str(query.runId)
        if not self._ended.setdefault(run, threading.Event()).wait(patience):
            raise TimeoutError("the end of the query was not reported")
        return self._dropped.get(run, 0)


@contextmanager
def late_rows(spark: SparkSession) -> Iterator[LateRows]:
    """Listens while queries run: `with late_rows(spark) as late: ...; late.of(query)`."""
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
