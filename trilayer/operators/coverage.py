"""What the archives hold: manifest coverage, sensors, load reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import PERIOD_YEARS


def location_years(manifest: DataFrame, locations: DataFrame | None = None, years: list[int] | None = None) -> DataFrame:
    """Years with at least one file, per location, as a sorted array.

    The set holds at most the listed years, so its size has a bound.  With `locations` (id, name) the name is added.
    """
    wanted = PERIOD_YEARS if years is None else years
    found = (
        manifest.filter(F.col("year").isin(wanted))
        .groupBy("location_id")
        .agg(F.sort_array(F.collect_set("year")).alias("years"))
    )
    if locations is None:
        return found
    names = locations.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"))
    return found.join(names, "location_id", "left").select("location_id", "location_name", "years")


def sensors(locations: DataFrame) -> DataFrame:
    """One row per sensor of the location documents."""
    return locations.select(
        F.col("id").alias("location_id"),
        F.coalesce("name", F.lit("")).alias("location_name"),
        F.col("datetimeLast.utc").alias("last_seen"),
        F.inline("sensors").alias("sensor_id", "_parameter"),
    ).select("location_id", "location_name", "last_seen", "sensor_id", F.col("_parameter.name").alias("parameter"))


def sensor_activity(locations: DataFrame, since: str = "2023-01-01") -> DataFrame:
    """Sensors per parameter: all, and those of locations seen since a day.  Locations never seen, or without a time for it, are
    left out.

    ISO texts compare like the times they stand for.
    """
    seen = sensors(locations.filter(F.col("datetimeLast.utc").isNotNull()))
    active = F.coalesce(F.col("last_seen"), F.lit("")) >= since
    return seen.groupBy("parameter").agg(
        F.count(F.lit(1)).alias("sensors"),
        F.count(F.when(active, 1)).alias("active_sensors"),
    )


def sensor_span(
    locations: DataFrame,
    measurements: DataFrame,
    parameters: list[str],
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """First and last observation day per sensor of some parameters, and whether there is any.

    The measurements are reduced to one row per sensor before the join, so a busy sensor costs no more than a quiet
    one.  Sensors without data in the range stay, marked.
    """
    day = F.to_date("measured_at")
    seen = measurements.filter(F.col("parameter").isin(parameters))
    if start is not None:
        seen = seen.filter(day >= F.lit(start))
    if end is not None:
        seen = seen.filter(day <= F.lit(end))
    spans = seen.groupBy("sensor_id").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    chosen = sensors(locations).filter(F.col("parameter").isin(parameters))
    return (
        chosen.select("parameter", "sensor_id", "location_name")
        .join(spans, "sensor_id", "left")
        .withColumn("has_data", F.col("last_day").isNotNull())
    )


def sensor_last_seen(locations: DataFrame, measurements: DataFrame, parameters: list[str]) -> DataFrame:
    """Last observation day per sensor without date bounds; sensors without any are left out."""
    spans = sensor_span(locations, measurements, parameters)
    return spans.filter("has_data").select("parameter", "sensor_id", "location_name", "last_day")


def reconcile(source: DataFrame, target: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """Rows in source and target and their difference, in total or per key.

    Both sides are counted in one aggregation over their union: one exchange of partial counts, no join, and a null key
    keeps its own row.
    """
    keys = by or []

    def tagged(df: DataFrame, in_source: int) -> DataFrame:
        return df.select(*keys, F.lit(in_source).alias("_source"), F.lit(1 - in_source).alias("_target"))

    both = tagged(source, 1).unionByName(tagged(target, 0))
    names = [c for c in both.columns if c not in ("_source", "_target")]
    sums = both.groupBy(*names).agg(
        F.coalesce(F.sum("_source"), F.lit(0)).cast("long").alias("source_rows"),
        F.coalesce(F.sum("_target"), F.lit(0)).cast("long").alias("target_rows"),
    )
    return sums.withColumn("difference", F.col("source_rows") - F.col("target_rows"))
