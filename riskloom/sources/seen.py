"""Index of the keys an appended table holds, so that a micro-batch meets only the part of it that
may hold its keys.

The index is a narrow Parquet folder: one text key per row with the label of the batch that wrote
it, in hash buckets. Its files carry Bloom filters on the key. The keys of a micro-batch are pushed
down to the scan: buckets without any of them are pruned, and of the others only row groups whose
filter may hold one are read. New keys, the usual case, so read next to nothing whatever the size
of the table. A micro-batch with more than `PUSHED` keys is joined with the index instead, which is
two columns wide and bucketed alike for every batch.

A batch that is written again adds its keys again, which changes no answer. Files are merged by
`compact`: the new folder takes the place of the old one by one table property.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY, WRITER, BUCKET = "key", "written_by", "bucket"
BUCKETS = 16
PUSHED = 20_000  # keys pushed down at most: 2 MB of text for ids of 100 characters
CHAINED = 10
WRONG = 1e-6  # of absent keys, the share a Bloom filter takes for present
BLOOM_BYTES = 16 << 20
PUSHDOWN = "spark.sql.parquet.pushdown.inFilterThreshold"


def key_of(columns: Sequence[str]) -> Column:
    """One text for the values of `columns`; NULL differs from every value."""
    return F.to_json(F.struct(*columns))


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class SeenKeys:
    """The index of one table: `name` in the catalogue, `folder` for the files."""

    PROPERTY = "seen_keys"

    def __init__(self, spark: SparkSession, name: str, folder: str, columns: Sequence[str]):
        self.spark, self.name, self.folder, self.columns = spark, name, folder, list(columns)

    def path(self) -> str | None:
        """Folder of the present index, None while there is none."""
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where(
            F.col("key") == self.PROPERTY).first()
        return shown["value"] if shown else None

    def _switch(self, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{self.PROPERTY}' = '{path}')")

    def start(self) -> str:
        """An index without any key takes the place of the present one."""
        path = f"{self.folder}/keys-{uuid.uuid4().hex}"
        self._switch(path)
        return path

    def _write(self, keys: DataFrame, path: str, rows: int, mode: str) -> None:
        (keys.withColumn(BUCKET, _bucket(F.col(KEY)))
         .repartition(BUCKETS, BUCKET).sortWithinPartitions(BUCKET, KEY)
         .write.mode(mode).partitionBy(BUCKET)
         .option("compression", "zstd")
         .option(f"parquet.enable.dictionary#{KEY}", "false")
         .option(f"parquet.bloom.filter.enabled#{KEY}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{KEY}", max(1000, 11 * rows // (10 * BUCKETS)))
         .option(f"parquet.bloom.filter.fpp#{KEY}", WRONG)
         .option("parquet.bloom.filter.max.bytes", BLOOM_BYTES)
         .parquet(path))

    def add(self, rows: DataFrame, batch: str) -> None:
        """Record the keys of rows that `batch` has written."""
        self._write(rows.select(key_of(self.columns).alias(KEY), F.lit(batch).alias(WRITER)),
                    self.path() or self.start(), rows.count(), "append")

    def rows(self) -> DataFrame | None:
        path = self.path()
        if path is None:
            return None
        try:
            return self.spark.read.schema(
                f"{KEY} string, {WRITER} string, {BUCKET} int").parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # not a key so far
                raise
            return None

    def scan(self, keys: Sequence[str], buckets: Sequence[int]) -> DataFrame | None:
        """Index rows of `keys`, read by pushdown; to be run within `pushing`."""
        rows = self.rows()
        if rows is None:
            return None
        return rows.where(F.col(BUCKET).isin(list(buckets)) & F.col(KEY).isin(list(keys)))

    def pushing(self):
        """The setting under which lists of keys reach the Parquet reader: beyond `CHAINED` keys as
        one set. A chain of alternatives as long as the list would overflow the stack."""
        return _setting(self.spark, PUSHDOWN, str(CHAINED))

    def among(self, batch: DataFrame, label: str) -> DataFrame:
        """`columns` of the rows of `batch` that another batch than `label` has written, once."""
        rows = self.rows()
        keys = batch.select(*self.columns).distinct()
        if rows is None:
            return self.spark.createDataFrame([], keys.schema)
        keys = keys.withColumn(KEY, key_of(self.columns)).withColumn(BUCKET, _bucket(F.col(KEY)))
        asked = keys.limit(PUSHED + 1).collect()
        if len(asked) > PUSHED:
            others = rows.where(F.col(WRITER) != label).select(BUCKET, KEY)
            return keys.join(others, [BUCKET, KEY], "left_semi").select(*self.columns)
        found = set()
        if asked:
            with self.pushing():
                hits = self.scan([r[KEY] for r in asked], sorted({r[BUCKET] for r in asked}))
                found = {r[KEY] for r in hits.where(F.col(WRITER) != label).select(KEY).collect()}
        return self.spark.createDataFrame(
            [tuple(r[c] for c in self.columns) for r in asked if r[KEY] in found],
            keys.select(*self.columns).schema)

    def compact(self) -> None:
        """Merge the files of all batches into one set of files per bucket."""
        rows = self.rows()
        if rows is None:
            return
        path = f"{self.folder}/keys-{uuid.uuid4().hex}"
        self._write(rows.select(KEY, WRITER).distinct(), path, rows.count(), "errorifexists")
        self._switch(path)
