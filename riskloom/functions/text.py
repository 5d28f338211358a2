"""Cleaning and typing of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def standardise(column: Column | str) -> Column:
    """Trimmed, upper-case text."""
    return F.upper(F.trim(column))


def parse_timestamp(column: Column | str, zoned: bool = True) -> Column:
    """Text to timestamp; text that is no timestamp becomes NULL instead of an error.

    `zoned=False` gives TIMESTAMP_NTZ, which does not depend on the session time zone.
    """
    if zoned:
        return F.try_to_timestamp(column)
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("timestamp_ntz")


def typed(column: Column | str, dtype: str) -> Column:
    """Cast that yields NULL for values the type cannot hold."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(dtype)


def standardise_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: standardise(name) for name in names})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns that exist; absent ones are ignored."""
    return df.drop(*names)


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every listed column; an empty list keeps every row."""
    return df.na.drop(how="any", subset=columns) if columns else df


def zero_fill(df: DataFrame, *names: str) -> DataFrame:
    """NULL becomes 0 in the named columns; their types stay."""
    types = dict(df.dtypes)
    return df.withColumns({n: F.coalesce(n, F.lit(0).cast(types[n])) for n in names})


def with_load_metadata(df: DataFrame, load_id: str | None = None) -> DataFrame:
    """Source file, load time and, when given, the id of the load that read the rows."""
    df = df.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "ingestion_timestamp": F.current_timestamp(),
    })
    return df if load_id is None else df.withColumn("load_id", F.lit(load_id))
