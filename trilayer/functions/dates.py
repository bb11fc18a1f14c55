"""Calendar column helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The period the layers cover, both ends included.
PERIOD_START = date(2023, 1, 1)
PERIOD_END = date(2024, 12, 31)
PERIOD_YEARS = [2023, 2024]

# Fixed values: `dayofweek` numbers of Sunday and Saturday.
WEEKEND_DAYS = [1, 7]


def date_key(day: Column) -> Column:
    """2024-03-09 -> 20240309."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(WEEKEND_DAYS)


def in_period(day: Column, start: date = PERIOD_START, end: date = PERIOD_END) -> Column:
    """Inclusive range on a date column, with typed literals so that it reaches the scan."""
    return day.between(F.lit(start), F.lit(end))


def from_iso_text(text: Column) -> Column:
    """ISO text with an offset to an instant; null for text that is no time."""
    return text.try_cast("timestamp")


def local_to_utc(wall_time: Column, zone: str) -> Column:
    """Zone-less wall time in `zone` to an instant.

    A repeated hour takes its first occurrence, a skipped one the offset before the change, so two wall times can meet
    on one instant.  Needs the UTC session zone of `trilayer.session`.
    """
    return F.to_utc_timestamp(wall_time.try_cast("timestamp_ntz").cast("timestamp"), zone)


def hour_bin(ts: Column) -> Column:
    return F.date_trunc("hour", ts)
