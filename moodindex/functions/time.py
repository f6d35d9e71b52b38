"""Time columns: parse, date, hour, year, ``yyyy-MM`` month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def as_timestamp(df: DataFrame, time_col: str) -> Column:
    """Timestamp of a time column; text is parsed with ``try_to_timestamp``
    so junk gives null instead of an error under ANSI mode (N2)."""
    if isinstance(df.schema[time_col].dataType, StringType):
        return F.try_to_timestamp(F.col(time_col))
    return F.col(time_col)


def with_time_parts(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Add ``date``, ``hour``, ``year`` (int) and ``month`` (``yyyy-MM``).

    A null or unparsable time gives nulls in all four columns.
    """
    ts = as_timestamp(df, time_col)
    return df.select(
        "*",
        F.to_date(ts).alias("date"),
        F.hour(ts).cast("int").alias("hour"),
        F.year(ts).cast("int").alias("year"),
        F.date_format(ts, "yyyy-MM").alias("month"),
    )
