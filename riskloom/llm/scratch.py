"""Written intermediate tables, shared by all executors, and how many rows Python workers hold."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskloom.session import run_dir

SLICE = 500  # rows with texts that are sent to a Python worker, or held there as objects, at a time
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet to the shared scratch folder and read back.

    Cuts the lineage at a table that outlives executors, so what it holds is computed once.
    The folder is the one named by `spark.checkpoint.dir` (`session.run_dir`).
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def few_rows(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile sends Python workers `SLICE` rows at a time, at most.

    A batch lies in the executor's memory off the heap and in the worker too, for each task, and
    texts make the usual 10,000 rows tens of MB. The setting is the session's, and only how rows
    are cut into batches depends on it; it is put back at the end.
    """
    usual = spark.conf.get(BATCH_ROWS)
    if not 0 < int(usual) <= SLICE:
        spark.conf.set(BATCH_ROWS, SLICE)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, usual)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of `batches`, few at a time: texts and arrays of a whole batch would take several
    times its size beside it."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)
