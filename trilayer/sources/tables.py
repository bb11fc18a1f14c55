"""Catalog tables of the layers.

Names are `layer.table`.  A session catalog without nested namespaces has no room for `layer.dbo.table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trilayer.schemas import WAREHOUSE

LAYERS = ["bronze", "silver", "gold", "warehouse"]


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A whole table or some of its columns."""
    table = spark.read.table(name)
    return table.select(*columns) if columns else table


def model_tables(spark: SparkSession, layer: str = "warehouse") -> dict[str, DataFrame]:
    """The nine model tables by entity name, as far as they exist."""
    return {
        entity: spark.read.table(f"{layer}.{entity}")
        for entity in WAREHOUSE
        if spark.catalog.tableExists(f"{layer}.{entity}")
    }
