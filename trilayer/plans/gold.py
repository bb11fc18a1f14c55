"""Silver to gold: calendar, zones, daily facts and the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import date_key, in_period, is_weekend
from trilayer.functions.numeric import exact_mean, exact_sum, round_columns
from trilayer.operators.clean import present
from trilayer.operators.joins import star_query
from trilayer.schemas import DIM_FX, DIM_GDP, DIM_ZONE, conform


def date_dim(days: DataFrame) -> DataFrame:
    """Calendar attributes of a `date` column."""
    day = F.col("date")
    return days.select(
        day,
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.quarter(day).alias("quarter"),
        is_weekend(day).alias("is_weekend"),
    )


def zone_dim(raw: DataFrame) -> DataFrame:
    """The zone lookup as it comes, all text."""
    return conform(raw, DIM_ZONE)


def zone_dim_fixed(zones: DataFrame) -> DataFrame:
    """The zone lookup with a numeric key and lower-case names.

    Our reading of two table shapes; the statement that fills this table is not public.  A key that is no number
    becomes null and matches no trip.
    """
    return zones.select(
        F.col("LocationID").try_cast("long").alias("locationid"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def fx_dim(silver: DataFrame) -> DataFrame:
    return conform(silver, DIM_FX)


def gdp_dim(silver: DataFrame) -> DataFrame:
    return conform(silver, DIM_GDP)


def trip_daily_fact(silver: DataFrame) -> DataFrame:
    """Trips per day and pickup zone.

    All measures merge partial results, so a zone with a large share of the trips costs one row per task and day.  Sums are
    exact, so a mean that lies on half a cent is rounded the same way in every run.
    """
    trips = silver.select(
        F.to_date("pickup_datetime").alias("date"),
        F.col("PULocationID").cast("long").alias("zone_id"),
        *(F.col(c).cast("double").alias(c) for c in ("fare_amount", "fare_eur", "trip_distance", "passenger_count")),
    )
    daily = (
        trips.filter(in_period(F.col("date")) & present("zone_id"))
        .groupBy("date", "zone_id")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact_mean("fare_amount").alias("avg_fare_usd"),
            exact_sum("fare_amount").alias("total_fare_usd"),
            exact_mean("fare_eur").alias("avg_fare_eur"),
            exact_mean("trip_distance").alias("avg_distance"),
            exact_mean("passenger_count").alias("avg_passengers"),
        )
    )
    money_and_means = ["avg_fare_usd", "total_fare_usd", "avg_fare_eur", "avg_distance", "avg_passengers"]
    return round_columns(daily, money_and_means, 2).withColumn("date_key", date_key(F.col("date")))


def air_daily_fact(silver: DataFrame) -> DataFrame:
    """Measurements per day, pollutant and station."""
    daily = (
        silver.filter(in_period(F.col("date")) & present("parameter", "location_name"))
        .groupBy("date", "parameter", "location_id", "location_name")
        .agg(
            F.count(F.lit(1)).alias("measurement_count"),
            exact_mean("value").alias("avg_value"),
            F.round(F.min("value"), 2).alias("min_value"),
            F.round(F.max("value"), 2).alias("max_value"),
            exact_mean("lat").alias("lat"),
            exact_mean("lon").alias("lon"),
        )
    )
    return round_columns(round_columns(daily, ["avg_value"], 2), ["lat", "lon"], 6).withColumn("date_key", date_key(F.col("date")))


# The model's relationships, (fact, fact key, dimension, dimension key).
RELATIONSHIPS = [
    ("facttaxidaily", "date_key", "dimdate", "date_key"),
    ("factairqualitydaily", "date_key", "dimdate", "date_key"),
    ("facttaxidaily", "zone_id", "dimzone_fixed", "locationid"),
]


# Columns the model sums unless told otherwise.  Sums of means, coordinates and ids have little meaning;
# name measures of your own where it matters.
SUMMED = {
    "facttaxidaily": [
        "trip_count", "avg_fare_usd", "total_fare_usd", "avg_fare_eur", "avg_distance", "avg_passengers",
    ],
    "factairqualitydaily": [
        "location_id", "measurement_count", "avg_value", "min_value", "max_value", "lat", "lon",
    ],
    "rpt_taxi_fx_daily": [
        "year", "month", "total_trips", "total_fare_usd", "theoretical_fare_eur", "eur_difference", "usd_eur_rate",
        "fixed_fare_eur",
    ],
    "rpt_taxi_gdp_yearly": [
        "year", "total_trips", "total_fare_usd", "avg_fare_usd", "gdp_usd", "taxi_revenue_pct_of_gdp",
    ],
}


def model_query(
    tables: dict[str, DataFrame], fact: str, by: list[str], measures: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Measures of a model fact by attributes of the dimensions it is related to.

    A dimension joins only if one of its attributes is asked for.  Without `measures`, the model's own sums.
    """
    if measures is None:
        measures = {c: ("sum", c) for c in SUMMED[fact] if c not in by}
    own = set(tables[fact].columns)
    wanted = set(by) - own
    dims = [
        (tables[dim], fact_key, dim_key)
        for source, fact_key, dim, dim_key in RELATIONSHIPS
        if source == fact and dim in tables and wanted & set(tables[dim].columns)
    ]
    return star_query(tables[fact], dims, by, measures)
