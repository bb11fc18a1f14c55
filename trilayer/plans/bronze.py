"""Raw inputs to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import PERIOD_YEARS, from_iso_text, in_period
from trilayer.schemas import DIM_GDP, FX_KEPT
from trilayer.sources.measurements import POLLUTANTS
from trilayer.sources.reference_data import apply_types
from trilayer.sources.trips import union_drifted


def bronze_air(raw: DataFrame, pollutants: list[str] | None = None) -> DataFrame:
    """Listed pollutants only, columns under their bronze names, time text as an instant."""
    listed = raw.filter(F.col("parameter").isin(POLLUTANTS if pollutants is None else pollutants))
    return (
        listed.withColumnsRenamed({"sensors_id": "sensor_id", "location": "location_name"})
        .withColumn("measured_at", from_iso_text(F.col("datetime")))
        .drop("datetime")
    )


def bronze_trips(parts: list[DataFrame]) -> DataFrame:
    """Monthly parts with drifting types as one relation."""
    return union_drifted(parts)


def bronze_fx(raw: DataFrame) -> DataFrame:
    """The four columns in use, dates of the period."""
    return raw.select(*FX_KEPT).filter(in_period(F.col("TIME_PERIOD")))


def bronze_gdp(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Years of the period, typed.  The year is text in the raw rows."""
    wanted = [str(y) for y in (PERIOD_YEARS if years is None else years)]
    return apply_types(raw.filter(F.col("year").isin(wanted)), DIM_GDP)
