"""Broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows in memory: text and nested values by their length as text, 16 bytes
    more for every value."""
    row = F.lit(16 * len(df.columns))
    for name, dtype in df.dtypes:
        if dtype in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(name), F.lit(0))
        elif dtype.startswith(("struct", "array", "map")):
            row = row + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
    return df.agg(F.sum(row.cast("bigint")).alias("b")).first()["b"] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint when its measured size fits, else `df` unchanged.

    Unhinted, Spark shuffles both sides of the join and adaptive execution splits hot keys.
    Measuring is one distributed aggregate over `df`; one row comes back.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
