"""Compaction of appended tables: the partitions of many micro-batches become one per day.

Appends make a partition per micro-batch, which lists and opens slowly after some months of
ten-second batches. `compact` folds the batches that can't be replayed any more into one partition
per day of the table's time column, in files of even size, so the partitions of a table are bounded
by its days plus the batches since the last call.

The packed files lie beside the table's folder. A stream on the folder (`Lakehouse.stream`) takes up
each appended file once, as before; the folders of folded batches stay for it until the storage's
retention removes them.
"""

from __future__ import annotations

import datetime
import re
import uuid

from pyspark.sql import functions as F

from riskloom.schemas import schema_of
from riskloom.sources.tables import (
    APPENDED, BATCH, CLOCK, NO_TIME, NUMBERED, PACKED, PERIOD, Lakehouse,
)

UNNAMED = re.compile(r"[0-9a-f]{32}")  # label of an append nobody can repeat
AT_ONCE = 500  # batches folded by one switch, which bounds the list of hidden labels


def closed_batches(lake: Lakehouse, table: str) -> list[str]:
    """Labels of the batches no writer replaces any more, in order.

    Of a stream, all but the last batch: Spark repeats only that one. Batches appended under a name
    of the caller's choice stay as they are, since the caller may write them again. A batch that a
    reader by batches has not taken up stays too.
    """
    labels = [x for x in lake.batches(table) if not x.startswith(PACKED)]
    last: dict[str, str] = {}
    for label in labels:
        numbered = NUMBERED.fullmatch(label)
        if numbered:
            last[numbered[1]] = max(label, last.get(numbered[1], ""))
    unread = {x for reader in lake.readers(table) for x in lake.unread(table, reader)[0]}
    return sorted(
        x for x in labels if x not in unread
        and (UNNAMED.fullmatch(x) or (NUMBERED.fullmatch(x) and x not in last.values())))


def _drop(lake: Lakehouse, table: str, labels: list[str]) -> None:
    there = set(lake.batches(table))
    gone = ", ".join(f"PARTITION (`{BATCH}` = '{x}')" for x in labels if x in there)
    if gone:
        lake.spark.sql(f"ALTER TABLE {lake.name(table)} DROP IF EXISTS {gone}")
    lake.hide(table, [])


def _fold(lake: Lakehouse, table: str, labels: list[str]) -> None:
    day = F.coalesce(F.to_date(CLOCK[table]), F.lit(NO_TIME))
    days = {str(r[0]) for r in lake.rows_of(table, labels).select(day).distinct().collect()}
    packed = [x for x in lake.batches(table)
              if x.startswith(PACKED) and x.removeprefix(PACKED)[:10] in days]
    old, run = labels + packed, uuid.uuid4().hex
    rows, path = lake.rows_of(table, old), lake.beside(table, run)
    rows.withColumn(PERIOD, day).hint("rebalance", PERIOD).write.format(lake.fmt).partitionBy(
        PERIOD).save(path)
    written = 0
    if days:
        written = lake.spark.read.format(lake.fmt).schema(schema_of(table)).load(path).count()
    if written != rows.count():
        raise RuntimeError(f"{table}: {written} rows written of {rows.count()}")
    # hidden while they are added; then one property changes which side readers see
    new = {d: f"{PACKED}{d}-{run}" for d in sorted(days)}
    lake.hide(table, list(new.values()))
    added = " ".join(f"PARTITION (`{BATCH}` = '{x}') LOCATION '{path}/{PERIOD}={d}'"
                     for d, x in new.items())
    if added:
        lake.spark.sql(f"ALTER TABLE {lake.name(table)} ADD {added}")
    lake.hide(table, old)
    _drop(lake, table, old)


def compact(lake: Lakehouse, table: str) -> int:
    """Fold the closed batches of an appended table into its days; returns how many.

    A day that has packed rows already is written again with the new ones, the others aren't read.
    Rows without a time form a day of their own. Whoever calls `Lakehouse.table` sees each row once
    at any time: what is being added, or has been replaced, is hidden by a table property until it
    is dropped, so a call that dies is finished or undone by the next. A frame made before the switch
    is to be made again after it. One compaction of a table runs at a time, beside any appends.
    """
    if table not in APPENDED or table not in CLOCK:
        raise ValueError(f"{table} is not an appended table with a time")
    _drop(lake, table, lake.hidden(table))
    labels = closed_batches(lake, table)
    for at in range(0, len(labels), AT_ONCE):
        _fold(lake, table, labels[at:at + AT_ONCE])
    lake.spark.catalog.refreshTable(lake.name(table))
    return len(labels)


def packed_days(lake: Lakehouse, table: str) -> list[datetime.date]:
    return sorted(datetime.date.fromisoformat(x.removeprefix(PACKED)[:10])
                  for x in lake.batches(table) if x.startswith(PACKED))
