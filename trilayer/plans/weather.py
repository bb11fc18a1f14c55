"""Hourly weather: payload rows to the enriched table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions import weather as W
from trilayer.functions.dates import local_to_utc
from trilayer.functions.numeric import to_float, to_int
from trilayer.schemas import WEATHER_HOURLY, conform


@dataclass(frozen=True)
class Place:
    key: str
    name: str
    latitude: float
    longitude: float
    zone: str


# The place the hourly job covers, and the label of its source.
NEW_YORK = Place("nyc", "NYC", 40.7128, -74.0060, "America/New_York")
SOURCE_LABEL = "open-meteo"


def enrich_weather(
    hours: DataFrame, fetched_at: Column, place: Place = NEW_YORK, source: str = SOURCE_LABEL
) -> DataFrame:
    """The 25-column table from hourly payload rows.

    Rows that bring their own `location_key`, `location_name`, `latitude` or `longitude` keep them; all share the zone
    of `place`.  Wind comes in km/h and leaves in m/s.
    """
    constants = {
        "location_key": place.key,
        "location_name": place.name,
        "latitude": place.latitude,
        "longitude": place.longitude,
    }
    measured = {
        "temperature_c": to_float("temperature_2m"),
        "relative_humidity_pct": to_float("relative_humidity_2m"),
        "dew_point_c": to_float("dew_point_2m"),
        "apparent_temperature_c": to_float("apparent_temperature"),
        "precipitation_mm": to_float("precipitation"),
        "rain_mm": to_float("rain"),
        "snowfall_cm": to_float("snowfall"),
        "cloud_cover_pct": to_float("cloud_cover"),
        "surface_pressure_hpa": to_float("surface_pressure"),
        "wind_speed_ms": W.kmh_to_ms(to_float("wind_speed_10m")),
        "wind_gusts_ms": W.kmh_to_ms(to_float("wind_gusts_10m")),
        "weather_code": to_int("weather_code"),
    }
    temperature, humidity = F.col("temperature_c"), F.col("relative_humidity_pct")
    wind = F.col("wind_speed_ms")
    derived = {
        "ts": local_to_utc(F.col("wall_time"), place.zone),
        "weather_condition": W.weather_label(F.col("weather_code")),
        "heat_index_c": W.heat_index(temperature, humidity),
        "wind_chill_c": W.wind_chill(temperature, wind),
        "comfort_index": W.comfort_index(temperature, humidity, wind),
        "is_raining": W.any_fall(F.col("rain_mm")),
        "is_snowing": W.any_fall(F.col("snowfall_cm")),
        "source": F.lit(source),
        "fetched_at": fetched_at,
        **{name: F.lit(value) for name, value in constants.items() if name not in hours.columns},
    }
    return conform(hours.withColumns(measured).withColumns(derived), WEATHER_HOURLY)
