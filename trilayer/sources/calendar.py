"""Generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.functions.dates import PERIOD_END, PERIOD_START


def calendar_days(spark: SparkSession, start: date = PERIOD_START, end: date = PERIOD_END) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return days_between(bounds, "first_day", "last_day")


def days_between(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns, both ends included."""
    return df.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("date"))


def days_covered(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest date in `column`."""
    day = F.to_date(column)
    return days_between(df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")), "first_day", "last_day")
