"""Hourly weather payloads: one JSON object with parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.schemas import HOURLY_FIELDS, WEATHER_DOC


def scan_weather(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per hour of every payload file."""
    return hourly_rows(spark.read.text(paths, wholetext=True), "value")


def hourly_rows(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """One row per entry of the `time` array of each payload in a text column, plus the `keep` columns.

    A shorter array gives null for the missing hours, what lies beyond `time` is ignored.
    """
    kept = keep or []
    payload = df.select(*kept, F.from_json(F.col(column), WEATHER_DOC).alias("doc"))
    hours = payload.select(*kept, "doc.hourly", F.posexplode("doc.hourly.time").alias("_pos", "wall_time"))
    return hours.select(
        *kept,
        "wall_time",
        *(F.get(F.col(f"hourly.{name}"), F.col("_pos")).alias(name) for name in HOURLY_FIELDS),
    )
