"""Report tables and the trips-against-air analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.functions.dates import in_period
from trilayer.functions.numeric import exact_mean, exact_sum, round_columns
from trilayer.operators.aggregate import corr_matrix, pair_corrs, pivot_mean
from trilayer.plans.silver import FIXED_USD_PER_EUR

# The pollutants set against the trips.
COMPARED = ["pm25", "no2", "o3", "co"]


def _mean_fare(weighted: bool) -> Column:
    """Plain mean of zone means, or total over trips."""
    if weighted:
        return F.try_divide(exact_sum("total_fare_usd"), F.sum("trip_count").cast("double"))
    return exact_mean("avg_fare_usd")


def city_day(trip_fact: DataFrame, weighted: bool = False) -> DataFrame:
    """Trips and mean fare per day over all zones.

    The mean fare is the unweighted mean of the zones' rounded means unless `weighted`.
    """
    daily = (
        trip_fact.filter(in_period(F.col("date")))
        .groupBy("date")
        .agg(F.sum("trip_count").alias("total_trips"), _mean_fare(weighted).alias("avg_fare"))
    )
    return round_columns(daily, ["avg_fare"], 2)


def air_by_day(air_fact: DataFrame, pollutants: list[str] | None = None) -> DataFrame:
    """Mean of the stations' daily means, one column per pollutant."""
    return pivot_mean(
        air_fact.filter(in_period(F.col("date"))), "date", "parameter", pollutants or COMPARED, "avg_value"
    )


def trips_with_air(trip_fact: DataFrame, air_fact: DataFrame) -> DataFrame:
    """Days that have both.  Both sides are daily before they meet."""
    return city_day(trip_fact).join(air_by_day(air_fact), "date", "inner")


def trip_air_matrix(daily: DataFrame) -> DataFrame:
    """Correlation of trips and each pollutant, as rows (x, y, r)."""
    return corr_matrix(daily, ["total_trips", *COMPARED])


def trip_air_pairs(daily: DataFrame) -> DataFrame:
    """Correlation of trips with each pollutant under its upper-case label, over days that have both."""
    pairs = pair_corrs(daily, "total_trips", COMPARED)
    return pairs.select(F.upper("y").alias("pollutant"), "pairs", "r")


def fx_daily_report(trip_fact: DataFrame, fx: DataFrame, fixed_rate: float = FIXED_USD_PER_EUR) -> DataFrame:
    """Daily revenue in euro at the fixed and at the published rate.

    Only this table's shape is public; its definition here is ours: the rate is dollars per euro, so both conversions
    divide; the difference is published less fixed; money is rounded to cents; a day without a published rate keeps its
    trips, with null rate, conversion and difference.
    """
    day = F.col("date")
    daily = trip_fact.groupBy("date").agg(
        F.sum("trip_count").alias("total_trips"), exact_sum("total_fare_usd").alias("total_fare_usd")
    )
    daily = round_columns(daily, ["total_fare_usd"], 2)
    rates = fx.select("date", "usd_eur_rate")
    total, rate = F.col("total_fare_usd"), F.col("usd_eur_rate")
    fixed, published = total / F.lit(fixed_rate), F.try_divide(total, rate)
    report = daily.join(rates, "date", "left").select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        "total_trips",
        total,
        fixed.alias("fixed_fare_eur"),
        published.alias("theoretical_fare_eur"),
        (published - fixed).alias("eur_difference"),
        rate,
    )
    return round_columns(report, ["fixed_fare_eur", "theoretical_fare_eur", "eur_difference"], 2)


def gdp_yearly_report(trip_fact: DataFrame, gdp: DataFrame, weighted: bool = False) -> DataFrame:
    """Yearly revenue as a percentage of GDP, not rounded since it is very small.

    Only this table's shape is public.  The mean fare is the plain mean of the daily zone means unless `weighted`.  A
    year without GDP keeps its trips.
    """
    yearly = trip_fact.groupBy(F.year("date").alias("year")).agg(
        F.sum("trip_count").alias("total_trips"),
        exact_sum("total_fare_usd").alias("total_fare_usd"),
        _mean_fare(weighted).alias("avg_fare_usd"),
    )
    yearly = round_columns(yearly, ["total_fare_usd", "avg_fare_usd"], 2)
    known = gdp.select(F.col("year").cast("int").alias("year"), "gdp_usd")
    share = F.try_divide(F.col("total_fare_usd") * 100, F.col("gdp_usd"))
    return yearly.join(known, "year", "left").withColumn("taxi_revenue_pct_of_gdp", share)
