"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def days_between_bounds(bounds: DataFrame, start: str, end_exclusive: str) -> DataFrame:
    """One row per day for a one-row frame of bounds, in a column ``date_key``."""
    last = F.date_sub(F.col(end_exclusive), 1)
    days = F.sequence(F.col(start), last, F.expr("interval 1 day"))
    # no day lies between reversed bounds, and sequence would refuse them
    return bounds.select(F.explode(F.when(F.col(start) <= last, days)).alias("date_key"))
