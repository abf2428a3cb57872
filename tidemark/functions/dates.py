"""Effective-date and calendar helpers. The current time is always an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of an open interval.
OPEN_END = "9999-12-31"


def ntz(moment: datetime | str | Column) -> Column:
    """Any moment as a `timestamp_ntz` column."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    return F.lit(str(moment)).cast("timestamp_ntz")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def add_time(unit: str, amount: Column | int, moment: Column) -> Column:
    """`moment` moved by `amount` units (MINUTE, HOUR, DAY, ...)."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(unit, amount, moment)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def day_text(moment: Column) -> Column:
    """Zero-padded yyyyMMdd."""
    return F.date_format(moment, "yyyyMMdd")
