"""Small reference files: exchange rates, GDP, zones, sensor locations, archive listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.functions.paths import key_location, key_month, key_year, listing_keys
from trilayer.schemas import FX_FILE, GDP_ROWS, LOCATION_DOC, ZONE_FILE


def apply_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns by a declared type map; text that does not fit becomes null."""
    return df.selectExpr(*(f"try_cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema))


def scan_fx(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The 32-column rate file, typed.  A line break always ends a row, even between quotes."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in FX_FILE])
    raw = spark.read.schema(text).csv(paths, header=True, multiLine=False, quote='"', escape='"', enforceSchema=False)
    return apply_types(raw, FX_FILE)


def scan_zones(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The zone lookup: header row, all text."""
    return spark.read.schema(ZONE_FILE).csv(paths, header=True, sep=",", quote='"', escape="\\", enforceSchema=False)


def scan_gdp(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Indicator documents of the form `[meta, [row, …]]`, one file each."""
    return gdp_rows(spark.read.text(paths, wholetext=True), "value")


def gdp_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of the indicator documents in a text column: the second element, expanded."""
    rows = F.from_json(F.get_json_object(F.col(column), "$[1]"), GDP_ROWS)
    return df.select(F.inline(rows)).select(
        F.col("date").alias("year"),
        F.col("value").alias("gdp_usd"),
    )


def scan_locations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Location pages, one JSON document per line."""
    return spark.read.schema(LOCATION_DOC).json(paths)


def parse_locations(df: DataFrame, column: str) -> DataFrame:
    """Location documents held in a text column."""
    return df.select(F.from_json(F.col(column), LOCATION_DOC).alias("doc")).select("doc.*")


def scan_listings(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Archive listing texts, one file each, as `listing`."""
    return spark.read.text(paths, wholetext=True).withColumnRenamed("value", "listing")


def manifest_from_listing(df: DataFrame, bucket: str = "", column: str = "listing") -> DataFrame:
    """One row per file key in the listing texts, with its address and the parts of its path."""
    key = F.col("file_key")
    return df.select(F.explode(listing_keys(F.col(column))).alias("file_key")).select(
        key,
        F.concat(F.lit(bucket), key).alias("file_url"),
        key_location(key).alias("location_id"),
        key_year(key).alias("year"),
        key_month(key).alias("month"),
    )
