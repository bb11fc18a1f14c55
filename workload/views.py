"""Raw inputs of the library derived from the given tables.

Each view grows with the tables and carries the dirt its consumer must handle: copies, nulls, negative values, unlisted
categories, bad text, short arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trilayer.schemas import FX_FILE, HOURLY_FIELDS
from trilayer.sources.measurements import POLLUTANTS

HOURS_PER_PAYLOAD = 216
HOURS_PER_SITE = 17544


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read once per process to learn the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _when_every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _with_copies(df: DataFrame, twice: Column) -> DataFrame:
    """Some rows a second time, in one scan."""
    copies = F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select("*", copies.alias("_copy")).drop("_copy")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from lineitem, days moved onto 2023 and 2024."""
    day = F.expr("unix_date(date'2023-01-01') + datediff(cast(l_shipdate as date), date'1995-01-01') % 731")
    items = table(spark, sf_dir, "lineitem").select(
        F.timestamp_seconds(day * 86400 + F.col("l_orderkey") % 24 * 3600).alias("tpep_pickup_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.when(_when_every("l_orderkey", 40), -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("fare_amount"),
        (F.col("l_quantity") - 1).alias("trip_distance"),
        F.when(F.col("l_linenumber") != 6, (F.col("l_linenumber") - 1).cast("double")).alias("passenger_count"),
        F.col("l_tax").alias("airport_fee"),
        "l_orderkey",
        "l_linenumber",
    )
    return _with_copies(items, _when_every("l_orderkey", 25))


def trip_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The trips as three monthly deliveries whose columns drift.

    January to April has int zones and the upper-case fee, May to August has no passengers, the rest is as it should be
    but for whole-number passengers.
    """
    whole = trips(spark, sf_dir)
    month = F.month("tpep_pickup_datetime")
    early = whole.filter(month <= 4)
    return [
        early.withColumn("PULocationID", F.col("PULocationID").cast("int")).withColumnRenamed("airport_fee", "Airport_fee"),
        whole.filter(month.between(5, 8)).drop("passenger_count"),
        whole.filter(month >= 9).withColumn("passenger_count", F.col("passenger_count").cast("long")),
    ]


def _parameter() -> Column:
    kinds = {"click": "pm25", "error": "no2", "purchase": "o3", "signup": "co", "view": "so2"}
    mapping = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    named = F.coalesce(F.try_element_at(mapping, F.col("event_type")), F.lit("nox"))
    return F.when(_when_every("event_id", 97), F.lit("temperature")).otherwise(named)


def _sensor(location: Column, parameter: Column) -> Column:
    order = F.array(*(F.lit(p) for p in ("pm25", "no2", "o3", "co", "so2", "nox", "temperature")))
    return (location * 10 + F.array_position(order, parameter)).cast("int")


def air_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the shape of the bronze air table from events, some of them twice, with an unlisted parameter."""
    location = F.col("user_id").cast("int")
    rows = table(spark, sf_dir, "events").select(
        location.alias("location_id"),
        _sensor(location, _parameter()).alias("sensor_id"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("location_name"),
        (F.lit(40.4) + (F.col("user_id") % 50) / F.lit(100.0)).alias("lat"),
        (F.lit(-74.2) + (F.col("user_id") % 50) / F.lit(100.0)).alias("lon"),
        _parameter().alias("parameter"),
        F.lit("ug/m3").alias("units"),
        F.when(_when_every("event_id", 41), None)
        .when(_when_every("event_id", 40), -F.col("value"))
        .otherwise(F.col("value"))
        .alias("value"),
        _record_key().alias("source_file"),
        F.date_trunc("second", "ts").cast("timestamp").alias("measured_at"),
        F.col("event_id").alias("_id"),
    )
    return _with_copies(rows, _when_every("_id", 50)).drop("_id")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the shape of the measurement files: other names, time as local text with an offset."""
    local = F.date_format(F.col("measured_at") - F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        air_rows(spark, sf_dir)
        .withColumn("datetime", F.concat(local, F.lit("-05:00")))
        .drop("measured_at")
        .withColumnsRenamed({"sensor_id": "sensors_id", "location_name": "location"})
    )


def air_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bronze air table holds: listed pollutants."""
    return air_rows(spark, sf_dir).filter(F.col("parameter").isin(POLLUTANTS))


def _record_key() -> Column:
    """File key of an event: years 2022 to 2024, every seventh location without 2024."""
    year = F.lit(2022) + F.col("event_id") % F.when(_when_every("user_id", 7), 2).otherwise(3)
    month = F.lit(1) + F.col("event_id") % 12
    return F.format_string(
        "records/csv.gz/locationid=%d/year=%d/month=%02d/location-%d.csv.gz",
        F.col("user_id"),
        year,
        month,
        F.col("user_id"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive listing texts, one per location with at most 36 keys, as `listing`."""
    keys = table(spark, sf_dir, "events").select("user_id", _record_key().alias("key")).distinct()
    entry = F.concat(F.lit("<Contents><Key>"), F.col("key"), F.lit("</Key><Size>1</Size></Contents>"))
    return keys.groupBy("user_id").agg(
        F.concat(F.lit("<ListBucketResult>"), F.array_join(F.collect_list(entry), ""), F.lit("</ListBucketResult>")).alias(
            "listing"
        )
    )


def location_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location documents as JSON text in `doc`, one per location with at most eight sensors.

    Sensor number 9 of a location has never measured anything.  Every seventeenth location was never seen.
    """
    location = F.col("user_id").cast("int")
    seen = table(spark, sf_dir, "events").select(
        location.alias("id"), _sensor(location, _parameter()).alias("sensor"), _parameter().alias("parameter")
    )
    sensor = F.struct(F.col("sensor").alias("id"), F.struct(F.col("parameter").alias("name")).alias("parameter"))
    silent = F.struct((F.col("id") * 10 + 9).alias("id"), F.struct(F.lit("o3").alias("name")).alias("parameter"))
    docs = seen.distinct().groupBy("id").agg(F.collect_list(sensor).alias("sensors"))
    last = F.concat((F.lit(2021) + F.col("id") % 4).cast("string"), F.lit("-01-15T00:00:00Z"))
    return docs.select(
        F.to_json(
            F.struct(
                "id",
                F.concat(F.lit("Station "), F.col("id").cast("string")).alias("name"),
                F.when(F.col("id") % 17 != 0, F.struct(last.alias("utc"))).alias("datetimeLast"),
                F.array_append("sensors", silent).alias("sensors"),
            )
        ).alias("doc")
    )


def fx_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate file's 32 text columns from orders: many copies, some bad dates, some missing rates, no weekends."""
    day = F.date_add(F.lit("2022-12-01").cast("date"), (F.col("o_orderkey") % 800).cast("int"))
    rate = F.lit(1.05) + (F.dayofmonth("_day") % 11) / F.lit(100.0)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("_day")).filter(~F.dayofweek("_day").isin(1, 7))
    known = {
        "CURRENCY": F.lit("USD"),
        "CURRENCY_DENOM": F.lit("EUR"),
        "TIME_PERIOD": F.when(_when_every("o_orderkey", 53), F.lit("n/a")).otherwise(F.col("_day").cast("string")),
        "OBS_VALUE": F.when(_when_every("o_orderkey", 37), F.lit("")).otherwise(rate.cast("string")),
        "DECIMALS": F.lit("4"),
        "UNIT_MULT": F.lit("0"),
        "TIME_FORMAT": F.lit("P1D"),
    }
    return rows.select(*(known.get(f.name, F.lit("-")).alias(f.name) for f in FX_FILE))


def gdp_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator documents `[meta, rows]` as JSON text in `doc`, a thousand orders each."""
    year = F.lit(2021) + F.col("o_orderkey") % 5
    value = F.when(~_when_every("o_orderkey", 29), F.lit(1.0e9) * (4 + F.col("o_orderkey") % 5) / 4)
    rows = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 1000).alias("page"),
        F.struct(F.lit("GDP").alias("indicator"), year.cast("string").alias("date"), value.alias("value")).alias("row"),
    )
    return rows.groupBy("page").agg(
        F.concat(F.lit('[{"page":1},'), F.to_json(F.collect_list("row")), F.lit("]")).alias("doc")
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows, all text, from suppliers."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return places.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("s_suppkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("s_name").alias("Zone"),
        F.col("n_name").alias("service_zone"),
    )


def _tenths(factor: int, modulus: int, shift: float = 0.0) -> Column:
    return (F.col("event_id") * factor % modulus) / F.lit(10.0) + F.lit(shift)


def _payload_values() -> dict[str, Column]:
    code = {0: 0.0, 1: 3.0, 2: 61.0, 3: 95.0, 4: 99.0}
    codes = F.create_map(*(F.lit(x) for pair in code.items() for x in pair))
    return {
        "temperature_2m": F.when(~_when_every("event_id", 50), _tenths(7, 551, -15.0)),
        "relative_humidity_2m": _tenths(13, 1011),
        "dew_point_2m": _tenths(3, 401, -20.0),
        "apparent_temperature": _tenths(5, 601, -20.0),
        "precipitation": _tenths(17, 90),
        "rain": F.when(_when_every("event_id", 5), _tenths(1, 30)),
        "snowfall": F.when(_when_every("event_id", 11), _tenths(1, 70)),
        "weather_code": F.try_element_at(codes, (F.col("event_id") % 6).cast("int")),
        "cloud_cover": _tenths(19, 1010),
        "surface_pressure": _tenths(23, 601, 980.0),
        "wind_speed_10m": _tenths(11, 800),
        "wind_gusts_10m": _tenths(29, 1200),
    }


def _wall_time() -> Column:
    hours = (F.col("event_id") % HOURS_PER_SITE).cast("int")
    return F.timestamp_add("HOUR", hours, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly payload rows from events, two years of hours per site."""
    site = F.floor(F.col("event_id") / HOURS_PER_SITE).cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("site-"), site).alias("location_key"),
        F.concat(F.lit("Site "), site).alias("location_name"),
        _wall_time().alias("wall_time"),
        *(value.alias(name) for name, value in _payload_values().items()),
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload documents as JSON text in `doc`, nine days of hours each.

    The rain array stops after 200 hours, and every tenth document has no snowfall at all.
    """
    hours = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / HOURS_PER_PAYLOAD).alias("payload"),
        F.struct(
            "event_id",
            F.date_format(_wall_time(), "yyyy-MM-dd'T'HH:mm").alias("time"),
            *(value.alias(name) for name, value in _payload_values().items()),
        ).alias("hour"),
    )
    docs = hours.groupBy("payload").agg(F.sort_array(F.collect_list("hour")).alias("hours"))

    def series(name: str) -> Column:
        return F.transform("hours", lambda h: h[name])

    fields = {name: series(name) for name in ["time", *HOURLY_FIELDS]}
    fields["rain"] = F.slice(fields["rain"], 1, 200)
    fields["snowfall"] = F.when(F.col("payload") % 10 != 0, fields["snowfall"])
    hourly = F.struct(*(column.alias(name) for name, column in fields.items()))
    return docs.select("payload", F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}).alias("doc"))
