"""Event time: where it comes from and how long to wait for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def from_millis(column: str | Column = "timestamp") -> Column:
    """Epoch milliseconds as a timestamp with session time zone."""
    return F.timestamp_millis(column)


def envelope_time() -> Column:
    """Time of the body of an envelope, of whichever type, else the wall clock."""
    millis = F.coalesce("body.member0.timestamp", "body.member1.timestamp")
    return F.coalesce(F.timestamp_millis(millis), F.current_timestamp())


def bounded(df: DataFrame, delay: str = "10 seconds", column: str = "ts") -> DataFrame:
    """Accept rows up to ``delay`` out of order. No effect on a batch."""
    return df.withWatermark(column, delay)


def monotonous(df: DataFrame, column: str = "ts") -> DataFrame:
    """Rows arrive in time order."""
    return df.withWatermark(column, "0 seconds")
