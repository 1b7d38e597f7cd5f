"""Calendar source: one row per day of a closed range (the date dimension)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, day_of_week_sunday0


def calendar_days(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """Every day in [start, end], generated on executors (``spark.range`` over day offsets)."""
    n = (end - start).days + 1
    if n <= 0:
        return spark.range(0).select(F.lit(start).alias("full_date")).limit(0)
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


def dim_date(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    d = F.col("full_date")
    dow = day_of_week_sunday0(d)
    return calendar_days(spark, start, end).select(
        date_key(d).alias("date_id"),
        d,
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )
