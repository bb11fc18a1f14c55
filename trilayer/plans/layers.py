"""All layers in one run: raw relations to the nine warehouse tables, each table stored once and read back by its name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trilayer.plans import bronze, gold, reports, silver
from trilayer.schemas import WAREHOUSE
from trilayer.sinks.tables import copy_to_warehouse, write_table
from trilayer.sources.calendar import days_covered
from trilayer.sources.tables import create_layers, read_table


@dataclass(frozen=True)
class RawInputs:
    """What the scans give: trips under their bronze names, measurement rows, typed rates, indicator rows, zones as text."""

    trips: DataFrame
    measurements: DataFrame
    fx: DataFrame
    gdp: DataFrame
    zones: DataFrame


def run_layers(spark: SparkSession, raw: RawInputs, prefix: str = "") -> dict[str, int]:
    """Write bronze, silver, gold and the warehouse; rows written by `layer.table`.

    Every source is scanned once and made distinct once, into its silver table; all that follows reads stored tables, the
    two facts once each for the reports.  A second run replaces every table, so it changes nothing where the raw data are
    the same, and can be started anew wherever the first one stopped.  `prefix` goes before the names of the layers.
    """
    create_layers(spark, prefix)
    written: dict[str, int] = {}

    def put(layer: str, table: str, rows: DataFrame, **how) -> DataFrame:
        written[f"{layer}.{table}"] = write_table(rows, f"{prefix}{layer}.{table}", **how)
        return read_table(spark, f"{prefix}{layer}.{table}")

    trips = put("bronze", "nyc_trips", raw.trips)
    air = put("bronze", "air_quality", bronze.bronze_air(raw.measurements), partition_by=["parameter"])
    fx = put("bronze", "fx_rates", bronze.bronze_fx(raw.fx))
    gdp = put("bronze", "gdp", bronze.bronze_gdp(raw.gdp))

    trips = put("silver", "nyc_trips", silver.silver_trips(trips))
    air = put("silver", "air_quality", silver.silver_air(air), partition_by=["parameter"])
    fx = put("silver", "fx_rates", silver.silver_fx(fx))
    gdp = put("silver", "gdp", silver.silver_gdp(gdp))

    facts = {
        "facttaxidaily": put("gold", "facttaxidaily", gold.trip_daily_fact(trips), recreate=True),
        "factairqualitydaily": put("gold", "factairqualitydaily", gold.air_daily_fact(air), recreate=True),
    }
    dims = {
        "dimdate": put("gold", "dimdate", gold.date_dim(days_covered(trips, "pickup_datetime"))),
        "dimfx": put("gold", "dimfx", gold.fx_dim(fx)),
        "dimgdp": put("gold", "dimgdp", gold.gdp_dim(gdp)),
        "dimzone": put("gold", "dimzone", gold.zone_dim(raw.zones)),
    }
    others = {
        "dimzone_fixed": gold.zone_dim_fixed(dims["dimzone"]),
        "rpt_taxi_fx_daily": reports.fx_daily_report(facts["facttaxidaily"], dims["dimfx"]),
        "rpt_taxi_gdp_yearly": reports.gdp_yearly_report(facts["facttaxidaily"], dims["dimgdp"]),
    }
    tables = facts | dims | others
    loaded = copy_to_warehouse({name: tables[name] for name in WAREHOUSE}, f"{prefix}warehouse", append=False)
    return written | {f"warehouse.{name}": int(rows) for name, rows in loaded.items()}
