"""Reload of a time range per key, as a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_bounds(batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Earliest and latest time of a batch per key."""
    return batch.groupBy(key).agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def outside_bounds(target: DataFrame, bounds: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows a reload keeps: other keys, times outside the key's bounds, both of which are inclusive, and null times.

    One row of bounds per key meets the target on the key.  The optimizer broadcasts the bounds while they are small;
    beyond that the adaptive skew join splits a key with very many rows.
    """
    limits = bounds.select(F.col(key).alias("_key"), F.col("min_ts").alias("_from"), F.col("max_ts").alias("_to"))
    replaced = F.coalesce(F.col(ts).between(F.col("_from"), F.col("_to")), F.lit(False))
    joined = target.join(limits, F.col(key) == F.col("_key"), "left")
    return joined.filter(~replaced).select(*target.columns)


def replaced_range(target: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """The target after a reload: rows of the batch's keys within the batch's time bounds give way to the batch.

    Reloading the same batch again changes nothing.
    """
    kept = outside_bounds(target, time_bounds(batch, key, ts), key, ts)
    return kept.unionByName(batch.select(*target.columns))
