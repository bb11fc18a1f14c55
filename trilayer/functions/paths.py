"""File keys and paths of the raw archives as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key layout of the measurement archive and path layout of the trip files.
RECORD_PREFIX = "records/csv.gz"
RECORD_KEY_PATTERN = r"^records/csv\.gz/locationid=(\d+)/year=(\d{4})/month=(\d{2})/"
LISTING_KEY_PATTERN = r"<Key>(.*?)</Key>"
TRIP_FILE_FORMAT = "Taxi/Yellow/%d/yellow_tripdata_%d-%02d.parquet"


def record_prefix(location_id: Column, year: Column, month: Column) -> Column:
    return F.format_string(
        RECORD_PREFIX + "/locationid=%d/year=%d/month=%02d/", location_id.cast("long"), year.cast("int"), month.cast("int")
    )


def listing_keys(listing: Column) -> Column:
    """All file keys of one object-store listing text, in order."""
    return F.regexp_extract_all(listing, F.lit(LISTING_KEY_PATTERN), F.lit(1))


def key_location(key: Column) -> Column:
    return F.regexp_extract(key, RECORD_KEY_PATTERN, 1).try_cast("long")


def key_year(key: Column) -> Column:
    return F.regexp_extract(key, RECORD_KEY_PATTERN, 2).try_cast("int")


def key_month(key: Column) -> Column:
    return F.regexp_extract(key, RECORD_KEY_PATTERN, 3).try_cast("int")


def relative_path(path: Column, base: str) -> Column:
    """`path` without everything up to and including `base`."""
    root = base.rstrip("/") + "/"
    return F.when(F.contains(path, F.lit(root)), F.substring_index(path, root, -1)).otherwise(path)


def trip_file(year: Column, month: Column) -> Column:
    return F.format_string(TRIP_FILE_FORMAT, year.cast("int"), year.cast("int"), month.cast("int"))
