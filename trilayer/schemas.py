"""Table shapes and the one place that bends a DataFrame to them.

All columns are nullable and all money is double, as in the tables these replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """A flat schema from `name type, …`, without a session at hand."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- raw inputs -----------------------------------------------------------------------------------------------------

MEASUREMENT_FILE = _struct(
    "location_id int, sensors_id int, location string, datetime string, lat double, lon double, "
    "parameter string, units string, value double"
)

# The published rate file: 32 columns, `TIME_FORMAT` is a duration nobody reads and stays text.
FX_FILE = _struct(
    "KEY string, FREQ string, CURRENCY string, CURRENCY_DENOM string, EXR_TYPE string, EXR_SUFFIX string, "
    "TIME_PERIOD date, OBS_VALUE double, OBS_STATUS string, OBS_CONF string, OBS_PRE_BREAK string, OBS_COM string, "
    "TIME_FORMAT string, BREAKS string, COLLECTION string, COMPILING_ORG string, DISS_ORG string, DOM_SER_IDS string, "
    "PUBL_ECB string, PUBL_MU string, PUBL_PUBLIC string, UNIT_INDEX_BASE string, COMPILATION string, COVERAGE string, "
    "DECIMALS bigint, NAT_TITLE string, SOURCE_AGENCY string, SOURCE_PUB string, TITLE string, TITLE_COMPL string, "
    "UNIT string, UNIT_MULT bigint"
)
FX_KEPT = ["CURRENCY", "CURRENCY_DENOM", "TIME_PERIOD", "OBS_VALUE"]

GDP_ROWS = "array<struct<date: string, value: double>>"

ZONE_FILE = _struct("LocationID string, Borough string, Zone string, service_zone string")

LOCATION_DOC = (
    "id bigint, name string, datetimeLast struct<utc: string>, "
    "sensors array<struct<id: bigint, parameter: struct<name: string>>>"
)

HOURLY_FIELDS = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "rain",
    "snowfall",
    "weather_code",
    "cloud_cover",
    "surface_pressure",
    "wind_speed_10m",
    "wind_gusts_10m",
]
WEATHER_DOC = (
    "hourly struct<time: array<string>, " + ", ".join(f"{name}: array<double>" for name in HOURLY_FIELDS) + ">"
)

# ---- warehouse tables -----------------------------------------------------------------------------------------------

DIM_DATE = _struct(
    "date date, date_key int, year int, month int, day int, day_of_week int, quarter int, is_weekend boolean"
)
DIM_FX = _struct(
    "CURRENCY string, CURRENCY_DENOM string, date date, usd_eur_rate double, year int, month int"
)
DIM_GDP = _struct("year bigint, gdp_usd double")
DIM_ZONE = ZONE_FILE
DIM_ZONE_FIXED = _struct("locationid bigint, borough string, zone string, service_zone string")
FACT_AIR_DAILY = _struct(
    "date date, parameter string, location_id int, location_name string, measurement_count bigint, avg_value double, "
    "min_value double, max_value double, lat double, lon double, date_key int"
)
FACT_TRIP_DAILY = _struct(
    "date date, zone_id bigint, trip_count bigint, avg_fare_usd double, total_fare_usd double, avg_fare_eur double, "
    "avg_distance double, avg_passengers double, date_key int"
)
REPORT_FX_DAILY = _struct(
    "date date, year int, month int, total_trips bigint, total_fare_usd double, fixed_fare_eur double, "
    "theoretical_fare_eur double, eur_difference double, usd_eur_rate double"
)
REPORT_GDP_YEARLY = _struct(
    "year int, total_trips bigint, total_fare_usd double, avg_fare_usd double, gdp_usd double, "
    "taxi_revenue_pct_of_gdp double"
)

WAREHOUSE = {
    "dimdate": DIM_DATE,
    "dimfx": DIM_FX,
    "dimgdp": DIM_GDP,
    "dimzone": DIM_ZONE,
    "dimzone_fixed": DIM_ZONE_FIXED,
    "factairqualitydaily": FACT_AIR_DAILY,
    "facttaxidaily": FACT_TRIP_DAILY,
    "rpt_taxi_fx_daily": REPORT_FX_DAILY,
    "rpt_taxi_gdp_yearly": REPORT_GDP_YEARLY,
}

# ---- event store ----------------------------------------------------------------------------------------------------

WEATHER_HOURLY = _struct(
    "ts timestamp, location_key string, location_name string, latitude double, longitude double, temperature_c double, "
    "relative_humidity_pct double, dew_point_c double, apparent_temperature_c double, precipitation_mm double, "
    "rain_mm double, snowfall_cm double, weather_code int, weather_condition string, cloud_cover_pct double, "
    "surface_pressure_hpa double, wind_speed_ms double, wind_gusts_ms double, heat_index_c double, "
    "wind_chill_c double, comfort_index double, is_raining boolean, is_snowing boolean, source string, "
    "fetched_at timestamp"
)

# Fixed value: widest text of a warehouse column, in UTF-8 bytes.
TEXT_BYTES = 8000


def truncate_utf8(text: Column, limit: int = TEXT_BYTES) -> Column:
    """The longest whole-character prefix that fits `limit` bytes."""
    raw = F.encode(text, "UTF-8")
    # A character has at most four bytes, so one of four neighbouring cuts falls between characters.
    cuts = [F.try_validate_utf8(F.substring(raw, 1, limit - back).cast("string")) for back in range(4)]
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.coalesce(*cuts))


def conversion_losses(schema: T.StructType, text_bytes: int | None = None) -> tuple[Column, Column]:
    """Per row of what `conform` takes: how many values become null, how many texts are cut."""
    nulled, cut = F.lit(0), F.lit(0)
    for field in schema:
        lost = f"`{field.name}` is not null and try_cast(`{field.name}` as {field.dataType.simpleString()}) is null"
        nulled = nulled + F.expr(f"if({lost}, 1, 0)")
        if text_bytes is not None and isinstance(field.dataType, T.StringType):
            cut = cut + F.expr(f"if(octet_length(cast(`{field.name}` as string)) > {text_bytes}, 1, 0)")
    return nulled, cut


def conform(df: DataFrame, schema: T.StructType, text_bytes: int | None = None) -> DataFrame:
    """Pick the columns of `schema` by name, in its order, cast to its types.

    Casts never fail: a value that does not fit becomes null.  With `text_bytes`, text is cut to that many UTF-8 bytes.
    A missing column is an error, a surplus one is dropped.
    """
    known = {name.lower() for name in df.columns}
    missing = [field.name for field in schema if field.name.lower() not in known]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    columns = []
    for field in schema:
        column = F.expr(f"try_cast(`{field.name}` as {field.dataType.simpleString()}) as `{field.name}`")
        if text_bytes is not None and isinstance(field.dataType, T.StringType):
            column = truncate_utf8(column, text_bytes).alias(field.name)
        columns.append(column)
    return df.select(*columns)
