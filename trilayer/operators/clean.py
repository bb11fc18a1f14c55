"""Filters and de-duplication shared by the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def positive(*columns: str) -> Column:
    """All columns above zero; null and NaN count as not.

    NaN is above zero to Spark, so it is excluded by a test of its own, which leaves the comparison bare for the scan.
    """
    return reduce(lambda a, b: a & b, ((F.col(c) > 0) & ~F.isnan(F.col(c)) for c in columns))


def present(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole rows once; nulls compare equal.

    Copies collapse in each task before the exchange, so a row that is repeated very often costs one row per task.  Put
    filters on the input's own columns after it: the optimizer moves them below, down to the scan.  Derived columns
    belong after it too, since all columns of the input are exchanged.
    """
    return df.dropDuplicates()


def recent(df: DataFrame, ts: str, now: Column, window: str = "7 days") -> DataFrame:
    """Rows later than `now` less the window.  `now` is an argument so that a run can be repeated."""
    return df.filter(F.col(ts) > now - F.expr(f"interval {window}"))
