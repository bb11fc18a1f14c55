"""Registered queries that write files or tables into the session's warehouse and read them back.

Raw files go to a folder, tables to databases, that are named after the running application: a later one finds
nothing of an earlier one in its way.  A query that runs again replaces what it wrote.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.operators.clean import present
from trilayer.plans import bronze, gold, layers
from trilayer.schemas import FX_FILE, MEASUREMENT_FILE, WAREHOUSE
from trilayer.sinks.tables import append_table, copy_to_warehouse, replace_mapped, write_table
from trilayer.sources.measurements import scan_measurements
from trilayer.sources.reference_data import apply_types, gdp_rows, scan_fx, scan_gdp, scan_zones
from trilayer.sources.tables import create_layers, model_tables, read_table
from trilayer.sources.trips import scan_trips
from workload import views
from workload.catalog import air_fact, calendar, fx_rates, gdp_years, query, trip_fact

def _application(spark: SparkSession) -> str:
    return "work_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{_application(spark)}_files/{name}"


def _layer(spark: SparkSession, layer: str) -> str:
    prefix = f"{_application(spark)}_"
    create_layers(spark, prefix)
    return prefix + layer


def _csv(df: DataFrame, path: str, **options) -> str:
    df.write.mode("overwrite").csv(path, header=True, **options)
    return path


# ---- scans of raw files ---------------------------------------------------------------------------------------------


@query
def trip_scan(spark, sf_dir):
    """Three deliveries with drifting columns and one that never came."""
    paths = [_folder(spark, f"trips_{i}") for i in range(4)]
    for part, path in zip(views.trip_parts(spark, sf_dir), paths):
        part.write.mode("overwrite").parquet(path)
    return scan_trips(spark, paths)


@query
def measurement_scan(spark, sf_dir):
    """Gzip CSV files in a tree by station, another tree absent; the rows' own files are not compared, only that there are."""
    rows = views.measurements(spark, sf_dir)
    path = _folder(spark, "records")
    station = rows.select(*MEASUREMENT_FILE.names, F.pmod("location_id", F.lit(8)).alias("station_group"))
    station.repartition("station_group").write.mode("overwrite").partitionBy("station_group").csv(path, header=True, compression="gzip")
    found = bronze.bronze_air(scan_measurements(spark, [path, path + "_absent"], base=path))
    folder = F.regexp_extract("source_file", r"^station_group=(\d+)/part-.*\.csv\.gz$", 1).cast("int")
    return found.withColumn("source_file", folder)


@query
def zone_scan(spark, sf_dir):
    """Zone names with a comma, quotes and a backslash in them."""
    odd = F.concat(F.col("Zone"), F.lit(', "'), F.col("service_zone"), F.lit('" \\'), F.col("LocationID"))
    rows = views.zones(spark, sf_dir).withColumn("Zone", odd)
    return scan_zones(spark, [_csv(rows, _folder(spark, "zones"), quote='"', escape="\\")])


@query
def fx_scan(spark, sf_dir):
    return bronze.bronze_fx(scan_fx(spark, [_csv(views.fx_text(spark, sf_dir), _folder(spark, "fx"), quote='"', escape='"')]))


@query
def gdp_scan(spark, sf_dir):
    """A file for each document."""
    path = _folder(spark, "gdp")
    views.gdp_docs(spark, sf_dir).select("page", "doc").write.mode("overwrite").partitionBy("page").text(path)
    return bronze.bronze_gdp(scan_gdp(spark, [path]))


# ---- table writes ---------------------------------------------------------------------------------------------------


@query
def table_overwrite(spark, sf_dir):
    """A table of another shape replaced by a fact; with the rows that the write observed."""
    name = f"{_layer(spark, 'gold')}.overwritten"
    fact = air_fact(spark, sf_dir)
    write_table(views.zones(spark, sf_dir), name)
    written = write_table(fact, name)
    return read_table(spark, name, fact.columns).withColumn("written", F.lit(written).cast("long"))


@query
def table_partitioned(spark, sf_dir):
    """The rows of a table partitioned on the parameter, with the folder that each one lies in."""
    name = f"{_layer(spark, 'silver')}.partitioned"
    write_table(air_fact(spark, sf_dir), name, partition_by=["parameter"])
    return read_table(spark, name).withColumn("folder", F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1))


@query
def table_recreated(spark, sf_dir):
    """A table recreated from itself: days with measurements of at least two stations stay."""
    name = f"{_layer(spark, 'gold')}.recreated"
    write_table(air_fact(spark, sf_dir), name)
    write_table(read_table(spark, name).where("measurement_count >= 2"), name, recreate=True)
    return read_table(spark, name)


@query
def table_mapped(spark, sf_dir):
    name = f"{_layer(spark, 'gold')}.mapped"
    replace_mapped(views.zones(spark, sf_dir), name, {"LocationID": "zone_key", "Zone": "zone_name"})
    return read_table(spark, name)


@query
def table_appended_twice(spark, sf_dir):
    """A fact that two jobs have appended."""
    name = f"{_layer(spark, 'warehouse')}.appended"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    fact = trip_fact(spark, sf_dir)
    for _ in range(2):
        append_table(fact, name, WAREHOUSE["facttaxidaily"])
    return read_table(spark, name)


@query
def warehouse_copied_twice(spark, sf_dir):
    """Five tables copied twice: rows of either copy as observed, and rows of the table at the end."""
    layer = _layer(spark, "warehouse")
    five = {
        "dimdate": calendar(spark, sf_dir),
        "dimfx": gold.fx_dim(fx_rates(spark, sf_dir)),
        "dimgdp": gold.gdp_dim(gdp_years(spark, sf_dir)),
        "dimzone": gold.zone_dim(scan_zones(spark, [_csv(views.zones(spark, sf_dir), _folder(spark, "zone_copy"), quote='"', escape="\\")])),
        "factairqualitydaily": air_fact(spark, sf_dir),
    }
    for name in five:
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    first, second = (copy_to_warehouse(five, layer) for _ in range(2))
    counts = [read_table(spark, f"{layer}.{name}").agg(F.lit(name).alias("name"), F.lit(int(first[name])).cast("long").alias("first"), F.lit(int(second[name])).cast("long").alias("second"), F.count("*").alias("rows")) for name in five]
    whole = counts[0]
    for other in counts[1:]:
        whole = whole.unionByName(other)
    return whole


# ---- all layers -----------------------------------------------------------------------------------------------------


@query
def layers_run(spark, sf_dir):
    """The layers from raw to warehouse in one run, then a model query over the warehouse's tables."""
    prefix = f"{_application(spark)}_all_"
    raw = layers.RawInputs(
        bronze.bronze_trips(views.trip_parts(spark, sf_dir)),
        views.measurements(spark, sf_dir),
        apply_types(views.fx_text(spark, sf_dir), FX_FILE),
        gdp_rows(views.gdp_docs(spark, sf_dir), "doc"),
        views.zones(spark, sf_dir),
    )
    layers.run_layers(spark, raw, prefix)
    tables = model_tables(spark, f"{prefix}warehouse")
    sums = gold.model_query(tables, "facttaxidaily", ["year", "month", "borough"], {"trip_count": ("sum", "trip_count")})
    return sums.where(present("borough"))
