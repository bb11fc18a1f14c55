"""Bronze to silver: one whole-row de-duplication each, filters, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import PERIOD_YEARS, in_period
from trilayer.operators.clean import distinct_rows, positive, present

# Fixed value: dollars per euro of the flat conversion.
FIXED_USD_PER_EUR = 1.08


def silver_trips(bronze: DataFrame) -> DataFrame:
    """Trips with positive distance, fare and passengers and a pickup time, with calendar columns and a euro fare.

    The euro fare is rounded per trip, before any average.
    """
    pickup = F.col("pickup_datetime")
    trips = distinct_rows(bronze).filter(
        positive("trip_distance", "fare_amount", "passenger_count") & present("tpep_pickup_datetime")
    )
    return trips.withColumn("pickup_datetime", F.col("tpep_pickup_datetime")).withColumns(
        {
            "year": F.year(pickup),
            "month": F.month(pickup),
            "day_of_week": F.dayofweek(pickup),
            "hour": F.hour(pickup),
            "fare_eur": F.round(F.col("fare_amount") / FIXED_USD_PER_EUR, 2),
        }
    )


def silver_air(bronze: DataFrame) -> DataFrame:
    """Positive measurements with a time, with calendar columns."""
    at = F.col("measured_at")
    return (
        distinct_rows(bronze)
        .filter(positive("value") & present("measured_at"))
        .withColumns({"date": F.to_date(at), "year": F.year(at), "month": F.month(at), "day_of_week": F.dayofweek(at)})
    )


def silver_fx(bronze: DataFrame) -> DataFrame:
    """Published rates of the period."""
    day = F.col("date")
    return (
        distinct_rows(bronze)
        .filter(present("OBS_VALUE"))
        .withColumnsRenamed({"TIME_PERIOD": "date", "OBS_VALUE": "usd_eur_rate"})
        .withColumn("date", F.to_date(day))
        .filter(in_period(day))
        .withColumns({"year": F.year(day), "month": F.month(day)})
    )


def silver_gdp(bronze: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Years with a value."""
    wanted = PERIOD_YEARS if years is None else years
    return distinct_rows(bronze).filter(present("gdp_usd") & F.col("year").isin(wanted))
