"""Date helpers: parsing the feed's date text and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(col: Column, fmt: str) -> Column:
    """Date text -> DATE; unparseable text -> null (``to_date`` raises under ANSI)."""
    return F.try_to_date(col, fmt)


def date_key(col: Column) -> Column:
    """DATE -> integer key YYYYMMDD (arithmetic, no string round-trip)."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def day_of_week_sunday0(col: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(col) - 1).cast("int")
