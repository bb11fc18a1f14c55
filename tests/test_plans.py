"""Relations between layers, and what the physical plans must not contain."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import workload.stored  # noqa: F401
from trilayer.plans import gold, layers, reports, silver
from trilayer.schemas import MEASUREMENT_FILE, WAREHOUSE
from trilayer.sources.measurements import scan_measurements
from trilayer.sources.reference_data import scan_fx, scan_gdp, scan_zones
from trilayer.sources.tables import model_tables
from trilayer.sources.trips import scan_trips
from workload import views
from workload.catalog import QUERIES, trip_fact, weather


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairwise_join_or_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition, REPARTITION"):
        assert operator not in plan


def test_fact_counts_every_silver_trip(spark):
    trips = silver.silver_trips(views.trips(spark, SF_DIR))
    fact = gold.trip_daily_fact(trips)
    assert fact.agg(F.sum("trip_count")).first()[0] == trips.count()
    assert reports.city_day(fact).agg(F.sum("total_trips")).first()[0] == trips.count()


def test_silver_filter_reaches_the_scan(spark, tmp_path):
    views.trips(spark, SF_DIR).write.parquet(str(tmp_path / "trips"))
    trips = silver.silver_trips(spark.read.parquet(str(tmp_path / "trips")))
    plan = plan_of(trips)
    for pushed in ("GreaterThan(fare_amount,0.0)", "GreaterThan(trip_distance,0.0)", "IsNotNull(tpep_pickup_datetime)"):
        assert pushed in plan


def test_fact_prunes_to_the_period(spark, tmp_path):
    silver.silver_trips(views.trips(spark, SF_DIR)).write.parquet(str(tmp_path / "silver"))
    fact = gold.trip_daily_fact(spark.read.parquet(str(tmp_path / "silver")))
    plan = plan_of(fact)
    assert "GreaterThanOrEqual(pickup_datetime,2023-01-01" in plan
    assert "IsNotNull(PULocationID)" in plan
    read = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "l_orderkey" not in read and "day_of_week" not in read


def test_fact_is_aggregated_before_its_exchange(spark):
    plan = trip_fact(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    operators = [line.strip(" +-:").split(" ")[0].split("(")[0] for line in plan.splitlines()]
    steps = [name for name in operators if name in ("HashAggregate", "Exchange")]
    # From the top: final sums, exchange, partial sums and final de-duplication in one stage, exchange, partial
    # de-duplication.
    assert steps == ["HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate"]


def test_period_ends_are_included(spark):
    days = ["2022-12-31 23:59:59", "2023-01-01 00:00:00", "2024-12-31 23:59:59", "2025-01-01 00:00:00", None]
    rows = [(d, z, 10.8, 1.0, 1.0) for d in days for z in (1, None)]
    raw = spark.createDataFrame(
        rows, "t string, PULocationID int, fare_amount double, trip_distance double, passenger_count double"
    ).select(F.col("t").try_cast("timestamp_ntz").alias("tpep_pickup_datetime"), "*").drop("t")
    fact = gold.trip_daily_fact(silver.silver_trips(raw))
    assert sorted(tuple(r) for r in fact.select("date_key", "zone_id", "trip_count", "avg_fare_eur").collect()) == [
        (20230101, 1, 1, 10.0), (20241231, 1, 1, 10.0),
    ]


def test_euro_fare_is_rounded_per_trip(spark):
    raw = spark.createDataFrame(
        [("2023-05-05 01:00:00", 1, fare, 1.0, 1.0) for fare in (0.01, 0.02, 0.03)],
        "t string, PULocationID int, fare_amount double, trip_distance double, passenger_count double",
    ).withColumn("tpep_pickup_datetime", F.col("t").cast("timestamp"))
    assert gold.trip_daily_fact(silver.silver_trips(raw)).first()["avg_fare_eur"] == 0.02


def test_days_without_a_rate_keep_their_trips(spark):
    fact = spark.createDataFrame([("2023-01-01", 3, 10.8, 5.0), ("2023-01-02", 1, 21.6, 7.0)], "d string, trip_count long, total_fare_usd double, avg_fare_usd double")
    fact = fact.withColumn("date", F.to_date("d"))
    fx = spark.createDataFrame([("2023-01-02", 1.2)], "d string, usd_eur_rate double").withColumn("date", F.to_date("d"))
    found = {r["date"].day: r for r in reports.fx_daily_report(fact, fx).collect()}
    assert (found[1]["total_trips"], found[1]["fixed_fare_eur"], found[1]["eur_difference"]) == (3, 10.0, None)
    assert (found[2]["theoretical_fare_eur"], found[2]["eur_difference"]) == (18.0, -2.0)
    gdp = spark.createDataFrame([(2022, 1.0)], "year long, gdp_usd double")
    row = reports.gdp_yearly_report(fact, gdp).first()
    assert (row["total_trips"], row["avg_fare_usd"], row["taxi_revenue_pct_of_gdp"]) == (4, 6.0, None)
    assert reports.gdp_yearly_report(fact, gdp, weighted=True).first()["avg_fare_usd"] == 8.1


def test_weather_stays_in_the_jvm_and_one_stage(spark):
    plan = plan_of(weather(spark, SF_DIR))
    assert "Exchange" not in plan and "Python" not in plan


def test_layers_from_raw_files(spark, tmp_path):
    """Raw files to nine warehouse tables; a rerun changes nothing, and later layers read only stored tables."""
    for i, part in enumerate(views.trip_parts(spark, SF_DIR)):
        part.write.parquet(str(tmp_path / f"trips{i}"))
    views.measurements(spark, SF_DIR).select(*MEASUREMENT_FILE.names).write.csv(str(tmp_path / "records"), header=True, compression="gzip")
    views.fx_text(spark, SF_DIR).write.csv(str(tmp_path / "fx"), header=True, escape='"')
    views.gdp_docs(spark, SF_DIR).select("page", "doc").write.partitionBy("page").text(str(tmp_path / "gdp"))
    views.zones(spark, SF_DIR).write.csv(str(tmp_path / "zones"), header=True)

    def run():
        raw = layers.RawInputs(
            scan_trips(spark, [str(tmp_path / f"trips{i}") for i in range(4)]),
            scan_measurements(spark, [str(tmp_path / "records")], base=str(tmp_path)),
            scan_fx(spark, [str(tmp_path / "fx")]),
            scan_gdp(spark, [str(tmp_path / "gdp")]),
            scan_zones(spark, [str(tmp_path / "zones")]),
        )
        return layers.run_layers(spark, raw, "raw_")

    def content():
        return {name: sorted(map(repr, table.collect())) for name, table in model_tables(spark, "raw_warehouse").items()}

    first = run()
    tables = content()
    assert set(tables) == set(WAREHOUSE) and all(tables.values())
    assert {name: len(rows) for name, rows in tables.items()} == {name: first[f"warehouse.{name}"] for name in WAREHOUSE}
    assert run() == first and content() == tables
    # The files may go once bronze is written: nothing later reads them, but for the zones.
    trips = silver.silver_trips(spark.read.table("raw_bronze.nyc_trips"))
    assert trips.count() == first["silver.nyc_trips"]
    assert sum(r["trip_count"] for r in spark.read.table("raw_warehouse.facttaxidaily").collect()) == first["silver.nyc_trips"]
    assert {c.name for c in spark.catalog.listColumns("raw_silver.air_quality") if c.isPartition} == {"parameter"}
