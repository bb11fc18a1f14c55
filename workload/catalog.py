"""Registered queries: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from trilayer.functions.numeric import round_columns
from trilayer.operators import aggregate, coverage, joins, quality, quantiles, reload
from trilayer.operators.clean import recent
from trilayer.plans import bronze, gold, reports, silver
from trilayer.plans.weather import enrich_weather
from trilayer.schemas import FACT_TRIP_DAILY, FX_FILE, TEXT_BYTES, WAREHOUSE, WEATHER_HOURLY, conform
from trilayer.session import configure
from trilayer.sinks.documents import json_lines
from trilayer.sources.calendar import calendar_days, days_covered
from trilayer.sources.reference_data import apply_types, gdp_rows, manifest_from_listing, parse_locations
from trilayer.sources.weather import hourly_rows
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FETCHED_AT = "2026-01-01 00:00:00"
RELOADED_AT = "2026-01-02 00:00:00"
RELOAD_FROM, RELOAD_TO = "2024-07-01 05:00:00", "2024-08-15 17:00:00"
NOW = "2024-12-31 00:00:00"
WEATHER_ROUNDED = ["wind_speed_ms", "wind_gusts_ms", "heat_index_c", "wind_chill_c", "comfort_index"]


def _zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, so that a client's own zone does not shift them on the way out."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants}) if instants else df


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return round_columns(df, columns, digits)


# ---- shared steps, not registered -----------------------------------------------------------------------------------


def trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trip_daily_fact(silver.silver_trips(views.trips(spark, sf_dir)))


def air_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.air_daily_fact(silver.silver_air(views.air_table(spark, sf_dir)))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_fx(bronze.bronze_fx(apply_types(views.fx_text(spark, sf_dir), FX_FILE)))


def gdp_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_gdp(bronze.bronze_gdp(gdp_rows(views.gdp_docs(spark, sf_dir), "doc")))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.date_dim(days_covered(views.trips(spark, sf_dir), "tpep_pickup_datetime"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_locations(views.location_docs(spark, sf_dir), "doc")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_from_listing(views.listings(spark, sf_dir), "https://archive.example/")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_weather(views.weather_hours(spark, sf_dir), _at(FETCHED_AT))


def model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Model tables by name; plans only, a query pays for those it uses.

    The facts keep to the period, so its calendar will do and the trips need not be read for their bounds.
    """
    return {
        "dimdate": gold.date_dim(calendar_days(spark)),
        "dimzone_fixed": gold.zone_dim_fixed(gold.zone_dim(views.zones(spark, sf_dir))),
        "facttaxidaily": trip_fact(spark, sf_dir),
        "factairqualitydaily": air_fact(spark, sf_dir),
    }


# ---- trips ----------------------------------------------------------------------------------------------------------


@query
def schema_drift_union(spark, sf_dir):
    return bronze.bronze_trips(views.trip_parts(spark, sf_dir))


@query
def trip_silver(spark, sf_dir):
    return silver.silver_trips(views.trips(spark, sf_dir))


@query
def trip_daily_fact(spark, sf_dir):
    return trip_fact(spark, sf_dir)


@query
def zone_dim(spark, sf_dir):
    return gold.zone_dim(views.zones(spark, sf_dir))


@query
def zone_dim_fixed(spark, sf_dir):
    return gold.zone_dim_fixed(gold.zone_dim(views.zones(spark, sf_dir)))


@query
def trip_by_borough(spark, sf_dir):
    sums = {c: ("sum", c) for c in ("trip_count", "total_fare_usd")}
    totals = gold.model_query(model(spark, sf_dir), "facttaxidaily", ["borough"], sums)
    return _rounded(totals, ["total_fare_usd"], 2)


@query
def trip_by_year_borough(spark, sf_dir):
    measures = {
        "trips": ("sum", "trip_count"),
        "days_with_trips": ("count", "date"),
        "lowest_fare": ("min", "avg_fare_usd"),
        "highest_fare": ("max", "avg_fare_usd"),
        "mean_fare": ("avg", "avg_fare_usd"),
    }
    found = gold.model_query(model(spark, sf_dir), "facttaxidaily", ["year", "borough"], measures)
    return _rounded(found, ["mean_fare"], 4)


@query
def trip_by_quarter_weekend(spark, sf_dir):
    sums = {c: ("sum", c) for c in ("trip_count", "total_fare_usd")}
    totals = gold.model_query(model(spark, sf_dir), "facttaxidaily", ["quarter", "is_weekend"], sums)
    return _rounded(totals, ["total_fare_usd"], 2)


@query
def trip_model_sums(spark, sf_dir):
    sums = gold.model_query(model(spark, sf_dir), "facttaxidaily", ["year", "borough"])
    return _rounded(sums, [c for c in gold.SUMMED["facttaxidaily"] if c != "trip_count"], 2)


@query
def city_day_rollup(spark, sf_dir):
    return reports.city_day(trip_fact(spark, sf_dir))


@query
def city_day_rollup_weighted(spark, sf_dir):
    return reports.city_day(trip_fact(spark, sf_dir), weighted=True)


@query
def calendar_dim(spark, sf_dir):
    return calendar(spark, sf_dir)


@query
def load_reconciliation(spark, sf_dir):
    trips = views.trips(spark, sf_dir)
    return coverage.reconcile(trips, silver.silver_trips(trips))


@query
def load_reconciliation_by_month(spark, sf_dir):
    trips = views.trips(spark, sf_dir)
    pickup = F.col("tpep_pickup_datetime")
    keys = [F.year(pickup).alias("year"), F.month(pickup).alias("month")]
    return coverage.reconcile(trips, silver.silver_trips(trips), keys)


# ---- air ------------------------------------------------------------------------------------------------------------


@query
def air_bronze(spark, sf_dir):
    return bronze.bronze_air(views.measurements(spark, sf_dir))


@query
def air_silver(spark, sf_dir):
    return silver.silver_air(views.air_table(spark, sf_dir))


@query
def air_daily_fact(spark, sf_dir):
    return air_fact(spark, sf_dir)


@query
def air_profile(spark, sf_dir):
    return aggregate.time_profile(views.air_table(spark, sf_dir), "measured_at")


@query
def air_count_by_parameter(spark, sf_dir):
    return aggregate.count_by(views.air_table(spark, sf_dir), "parameter")


@query
def air_count_since(spark, sf_dir):
    return aggregate.count_since(views.air_table(spark, sf_dir), "parameter", "measured_at", _at("2024-01-15 00:00:00"))


@query
def air_hourly_count(spark, sf_dir):
    return aggregate.count_per_hour(views.air_table(spark, sf_dir), "measured_at")


@query
def air_by_month(spark, sf_dir):
    measures = {"measurements": ("sum", "measurement_count"), "mean_value": ("avg", "avg_value")}
    by = ["year", "month", "parameter"]
    return _rounded(gold.model_query(model(spark, sf_dir), "factairqualitydaily", by, measures), ["mean_value"])


@query
def air_model_sums(spark, sf_dir):
    sums = gold.model_query(model(spark, sf_dir), "factairqualitydaily", ["year", "month"])
    return _rounded(sums, ["avg_value", "min_value", "max_value", "lat", "lon"], 2)


@query
def air_pivot(spark, sf_dir):
    return _rounded(reports.air_by_day(air_fact(spark, sf_dir)), reports.COMPARED)


def _trips_with_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trips_with_air(trip_fact(spark, sf_dir), air_fact(spark, sf_dir))


@query
def trip_air_joined(spark, sf_dir):
    return _rounded(_trips_with_air(spark, sf_dir).orderBy("date"), reports.COMPARED)


@query
def trip_air_corr(spark, sf_dir):
    return reports.trip_air_matrix(_trips_with_air(spark, sf_dir))


@query
def trip_air_corr_pairs(spark, sf_dir):
    return reports.trip_air_pairs(_trips_with_air(spark, sf_dir))


# ---- rates, GDP and reports -----------------------------------------------------------------------------------------


@query
def fx_bronze(spark, sf_dir):
    return bronze.bronze_fx(apply_types(views.fx_text(spark, sf_dir), FX_FILE))


@query
def fx_silver(spark, sf_dir):
    return fx_rates(spark, sf_dir)


@query
def fx_dim(spark, sf_dir):
    return gold.fx_dim(fx_rates(spark, sf_dir))


@query
def gdp_bronze(spark, sf_dir):
    return bronze.bronze_gdp(gdp_rows(views.gdp_docs(spark, sf_dir), "doc"))


@query
def gdp_silver(spark, sf_dir):
    return gdp_years(spark, sf_dir)


@query
def gdp_dim(spark, sf_dir):
    return gold.gdp_dim(gdp_years(spark, sf_dir))


@query
def trip_fx_daily(spark, sf_dir):
    return reports.fx_daily_report(trip_fact(spark, sf_dir), gold.fx_dim(fx_rates(spark, sf_dir)))


@query
def trip_fx_monthly(spark, sf_dir):
    daily = reports.fx_daily_report(trip_fact(spark, sf_dir), gold.fx_dim(fx_rates(spark, sf_dir)))
    money = ["total_fare_usd", "fixed_fare_eur", "theoretical_fare_eur", "eur_difference"]
    sums = {c: ("sum", c) for c in ["total_trips", *money]}
    return _rounded(joins.star_query(daily, [], ["year", "month"], sums), money, 2)


@query
def trip_gdp_yearly(spark, sf_dir):
    yearly = reports.gdp_yearly_report(trip_fact(spark, sf_dir), gold.gdp_dim(gdp_years(spark, sf_dir)))
    return _rounded(yearly, ["taxi_revenue_pct_of_gdp"])


@query
def trip_gdp_yearly_weighted(spark, sf_dir):
    gdp = gold.gdp_dim(gdp_years(spark, sf_dir))
    return _rounded(reports.gdp_yearly_report(trip_fact(spark, sf_dir), gdp, weighted=True), ["taxi_revenue_pct_of_gdp"])


# ---- coverage -------------------------------------------------------------------------------------------------------


@query
def location_manifest(spark, sf_dir):
    return manifest(spark, sf_dir)


@query
def location_year_coverage(spark, sf_dir):
    found = coverage.location_years(manifest(spark, sf_dir), locations(spark, sf_dir))
    return found.withColumn("years", F.array_join(F.col("years").cast("array<string>"), ","))


@query
def sensor_activity(spark, sf_dir):
    return coverage.sensor_activity(locations(spark, sf_dir))


@query
def sensor_span(spark, sf_dir):
    return coverage.sensor_span(
        locations(spark, sf_dir), views.air_table(spark, sf_dir), ["co", "o3"], date(2022, 1, 1), date(2024, 12, 31)
    )


@query
def sensor_last_seen(spark, sf_dir):
    return coverage.sensor_last_seen(locations(spark, sf_dir), views.air_table(spark, sf_dir), ["co", "o3"])


@query
def allowlisted_locations(spark, sf_dir):
    allowed = views.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    kept = joins.keep_listed(locations(spark, sf_dir), allowed, "id", "c_custkey")
    return kept.select("id", "name", F.size("sensors").alias("sensors"))


# ---- weather --------------------------------------------------------------------------------------------------------


@query
def weather_payload_rows(spark, sf_dir):
    return hourly_rows(views.weather_payloads(spark, sf_dir), "doc", keep=["payload"])


@query
def weather_from_payloads(spark, sf_dir):
    hours = hourly_rows(views.weather_payloads(spark, sf_dir), "doc")
    return _rounded(enrich_weather(hours, _at(FETCHED_AT)), WEATHER_ROUNDED)


@query
def weather_enriched(spark, sf_dir):
    return _rounded(weather(spark, sf_dir), WEATHER_ROUNDED)


@query
def weather_recent(spark, sf_dir):
    return _rounded(recent(weather(spark, sf_dir), "ts", _at(NOW)).select(*WEATHER_HOURLY.names), WEATHER_ROUNDED)


@query
def weather_count(spark, sf_dir):
    return aggregate.count_rows(weather(spark, sf_dir))


@query
def weather_hourly_count(spark, sf_dir):
    return aggregate.count_per_hour(weather(spark, sf_dir), "ts")


@query
def weather_first_rows(spark, sf_dir):
    columns = ["location_key", "ts", "weather_code", "weather_condition", "is_raining", "is_snowing"]
    return aggregate.rows_as_text(weather(spark, sf_dir).select(*columns), 5, columns)


@query
def weather_take(spark, sf_dir):
    rows = aggregate.take_rows(weather(spark, sf_dir), 100, ["ts", "location_key", "dew_point_c"])
    return _rounded(rows, WEATHER_ROUNDED)


def _reload_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later fetch of some weeks: warmer by a degree, without the hours at which a code was missing."""
    fresh = enrich_weather(views.weather_hours(spark, sf_dir), _at(RELOADED_AT))
    span = F.col("ts").between(_at(RELOAD_FROM), _at(RELOAD_TO))
    return fresh.filter(span & F.col("weather_code").isNotNull()).withColumn("temperature_c", F.col("temperature_c") + 1)


@query
def weather_batch_bounds(spark, sf_dir):
    return reload.time_bounds(_reload_batch(spark, sf_dir), "location_key", "ts")


@query
def weather_range_replace(spark, sf_dir):
    after = reload.replaced_range(weather(spark, sf_dir), _reload_batch(spark, sf_dir), "location_key", "ts")
    return _rounded(after, ["temperature_c", *WEATHER_ROUNDED])


@query
def weather_json_lines(spark, sf_dir):
    lines = json_lines(weather(spark, sf_dir))
    parsed = lines.select(F.inline(F.array(F.from_json("line", WEATHER_HOURLY))))
    return _rounded(parsed, WEATHER_ROUNDED)


@query
def weather_json_text(spark, sf_dir):
    """The JSON lines as they are written, text by text."""
    return json_lines(_rounded(weather(spark, sf_dir), WEATHER_ROUNDED))


# ---- quality --------------------------------------------------------------------------------------------------------


@query
def quality_rules(spark, sf_dir):
    return quality.run_rules(weather(spark, sf_dir), quality.WEATHER_RULES)


@query
def quality_statistics(spark, sf_dir):
    return quality.rule_statistics(quality.run_rules(weather(spark, sf_dir), quality.WEATHER_RULES))


@query
def quality_failures(spark, sf_dir):
    return quality.rule_failures(quality.run_rules(weather(spark, sf_dir), quality.WEATHER_RULES))


TRIP_RULES = [
    quality.row_count(low=1),
    quality.not_null("passenger_count", mostly=0.9),
    quality.not_null("fare_amount"),
    quality.between("fare_amount", low=0),
    quality.between("trip_distance", 0, 60),
    quality.between("passenger_count", 0, 4, mostly=0.95),
    quality.in_set("l_linenumber", 1, 2, 3, 4, 5, 6),
]


@query
def trip_quality_rules(spark, sf_dir):
    return quality.run_rules(views.trips(spark, sf_dir), TRIP_RULES)


@query
def null_summary(spark, sf_dir):
    return quality.null_summary(weather(spark, sf_dir))


SUMMARY_ROUNDED = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@query
def numeric_summary(spark, sf_dir):
    return _rounded(quantiles.numeric_summary(weather(spark, sf_dir)), SUMMARY_ROUNDED)


@query
def trip_numeric_summary(spark, sf_dir):
    columns = ["fare_amount", "trip_distance", "passenger_count"]
    return _rounded(quantiles.numeric_summary(views.trips(spark, sf_dir), columns), SUMMARY_ROUNDED)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        _rounded(weather(spark, sf_dir), WEATHER_ROUNDED),
        quality.WEATHER_RULES,
        "Weather Data Quality Report",
        "weather_hourly_enriched",
        datetime.fromisoformat(FETCHED_AT),
        ["ts", "location_key"],
        top=20,
        first=5,
    )


@query
def quality_report_head(spark, sf_dir):
    """The report document without its nested lists, these as their lengths."""
    report = _report(spark, sf_dir)
    lists = ["failures", "null_summary", "numeric_summary", "first_rows"]
    return report.select(
        "report_name",
        "source",
        "generated_at_utc",
        "rows_checked",
        "success",
        "statistics.*",
        *(F.size(c).alias(c) for c in lists),
        F.element_at("null_summary", 1)["column"].alias("most_nulls_in"),
        F.element_at("first_rows", 1)["ts"].alias("first_ts"),
    )


def _listed(report: DataFrame, name: str) -> DataFrame:
    """A nested list of the report, with the place of each entry."""
    return report.select(F.posexplode(name).alias("position", "entry")).select("position", "entry.*")


@query
def quality_report_failures(spark, sf_dir):
    return _listed(_report(spark, sf_dir), "failures").drop("position")


@query
def quality_report_nulls(spark, sf_dir):
    return _listed(_report(spark, sf_dir), "null_summary")


@query
def quality_report_numbers(spark, sf_dir):
    return _rounded(_listed(_report(spark, sf_dir), "numeric_summary"), SUMMARY_ROUNDED)


@query
def quality_report_rows(spark, sf_dir):
    return _listed(_report(spark, sf_dir), "first_rows")


# ---- warehouse ------------------------------------------------------------------------------------------------------


@query
def warehouse_conform(spark, sf_dir):
    return conform(air_fact(spark, sf_dir), WAREHOUSE["factairqualitydaily"], TEXT_BYTES)


@query
def warehouse_append_twice(spark, sf_dir):
    """Content after two jobs have appended the same fact."""
    load = conform(trip_fact(spark, sf_dir), FACT_TRIP_DAILY, TEXT_BYTES)
    return load.unionByName(load)
