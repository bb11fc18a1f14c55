"""SQL twins of the registered queries, written for DuckDB on the same tables."""

from __future__ import annotations


def r(expression: str, digits: int) -> str:
    """Half-up rounding of the decimal that fifteen significant digits, as text, stand for."""
    return f"cast(round(cast(printf('%.14e', cast({expression} as double)) as decimal(38,18)), {digits}) as double)"


def total(x: str) -> str:
    """Sum of the decimals that doubles are written as."""
    return f"cast(sum(cast(cast({x} as varchar) as decimal(38,15))) as double)"


def mean(x: str) -> str:
    """Mean of the decimals that doubles are written as."""
    return f"({total(x)} / nullif(count({x}), 0))"


def plain(x: str, digits: int) -> str:
    """Half-up rounding of the decimal that a double is written as."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), {digits}) as double)"


PERIOD = "date '2023-01-01' and date '2024-12-31'"

TRIPS_ONCE = """
select timestamp '2023-01-01 00:00:00'
         + to_hours(24 * (datediff('day', date '1995-01-01', l_shipdate::date) % 731) + l_orderkey % 24)
         as tpep_pickup_datetime,
       l_suppkey as "PULocationID",
       case when l_orderkey % 40 = 0 then -l_extendedprice else l_extendedprice end as fare_amount,
       l_quantity - 1 as trip_distance,
       case when l_linenumber <> 6 then cast(l_linenumber - 1 as double) end as passenger_count,
       l_tax as airport_fee, l_orderkey, l_linenumber
from lineitem
"""
TRIPS = f"""
trips_once as ({TRIPS_ONCE}),
trips as (select * from trips_once union all select * from trips_once where l_orderkey % 25 = 0)
"""
TRIP_SILVER = f"""{TRIPS},
trip_silver as (
  select *, tpep_pickup_datetime as pickup_datetime,
         cast(year(tpep_pickup_datetime) as int) as "year", cast(month(tpep_pickup_datetime) as int) as "month",
         cast(dayofweek(tpep_pickup_datetime) + 1 as int) as day_of_week,
         cast(hour(tpep_pickup_datetime) as int) as "hour",
         {plain("fare_amount / 1.08e0", 2)} as fare_eur
  from (select distinct * from trips)
  where trip_distance > 0 and fare_amount > 0 and passenger_count > 0 and tpep_pickup_datetime is not null)
"""
TRIP_FACT = f"""{TRIP_SILVER},
trip_fact as (
  select *, cast(strftime("date", '%Y%m%d') as int) as date_key from (
    select cast(pickup_datetime as date) as "date", cast("PULocationID" as bigint) as zone_id,
           count(*) as trip_count,
           {r(mean("fare_amount"), 2)} as avg_fare_usd, {r(total("fare_amount"), 2)} as total_fare_usd,
           {r(mean("fare_eur"), 2)} as avg_fare_eur, {r(mean("trip_distance"), 2)} as avg_distance,
           {r(mean("passenger_count"), 2)} as avg_passengers
    from trip_silver
    where cast(pickup_datetime as date) between {PERIOD} and "PULocationID" is not null
    group by 1, 2))
"""

PARAMETER = """case when event_id % 97 = 0 then 'temperature'
     else case event_type when 'click' then 'pm25' when 'error' then 'no2' when 'purchase' then 'o3'
                          when 'signup' then 'co' when 'view' then 'so2' else 'nox' end end"""
SENSOR = f"""user_id * 10 + case {PARAMETER} when 'pm25' then 1 when 'no2' then 2 when 'o3' then 3 when 'co' then 4
     when 'so2' then 5 when 'nox' then 6 when 'temperature' then 7 end"""
RECORD_YEAR = "2022 + event_id % (case when user_id % 7 = 0 then 2 else 3 end)"
RECORD_KEY = f"""'records/csv.gz/locationid=' || user_id || '/year=' || ({RECORD_YEAR}) || '/month='
     || lpad(cast(1 + event_id % 12 as varchar), 2, '0') || '/location-' || user_id || '.csv.gz'"""
AIR = f"""
air_events as (select * from events union all select * from events where event_id % 50 = 0),
air_all as (
  select cast(user_id as int) as location_id, cast({SENSOR} as int) as sensor_id, 'Station ' || user_id as location_name,
         40.4e0 + (user_id % 50) / 1e2 as lat, -74.2e0 + (user_id % 50) / 1e2 as lon,
         {PARAMETER} as parameter, 'ug/m3' as units,
         case when event_id % 41 = 0 then null when event_id % 40 = 0 then -value else value end as value,
         {RECORD_KEY} as source_file, date_trunc('second', ts) as measured_at
  from air_events),
air_bronze as (select * from air_all where parameter <> 'temperature')
"""
AIR_SILVER = f"""{AIR},
air_silver as (
  select *, cast(measured_at as date) as "date", cast(year(measured_at) as int) as "year",
         cast(month(measured_at) as int) as "month", cast(dayofweek(measured_at) + 1 as int) as day_of_week
  from (select distinct * from air_bronze) where value > 0 and measured_at is not null)
"""
AIR_FACT = f"""{AIR_SILVER},
air_fact as (
  select *, cast(strftime("date", '%Y%m%d') as int) as date_key from (
    select "date", parameter, location_id, location_name, count(*) as measurement_count,
           {r(mean("value"), 2)} as avg_value, round(min(value), 2) as min_value, round(max(value), 2) as max_value,
           {r(mean("lat"), 6)} as lat, {r(mean("lon"), 6)} as lon
    from air_silver
    where "date" between {PERIOD} and parameter is not null and location_name is not null
    group by 1, 2, 3, 4))
"""

CALENDAR = """
days as (
  select cast(unnest(generate_series(
           (select min(cast(tpep_pickup_datetime as date)) from trips_once),
           (select max(cast(tpep_pickup_datetime as date)) from trips_once), interval 1 day)) as date) as "date"),
calendar as (
  select "date", cast(strftime("date", '%Y%m%d') as int) as date_key, cast(year("date") as int) as "year",
         cast(month("date") as int) as "month", cast(day("date") as int) as "day",
         cast(dayofweek("date") + 1 as int) as day_of_week, cast(quarter("date") as int) as "quarter",
         dayofweek("date") in (0, 6) as is_weekend
  from days)
"""
ZONES = """
zones as (
  select cast(s_suppkey as varchar) as "LocationID", r_name as "Borough", s_name as "Zone", n_name as service_zone
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""
CITY_DAY = f"""
city_day as (
  select "date", cast(sum(trip_count) as bigint) as total_trips, {r(mean("avg_fare_usd"), 2)} as avg_fare
  from trip_fact where "date" between {PERIOD} group by 1)
"""
AIR_PIVOT = f"""
air_pivot as (
  select "date", {mean("case when parameter = 'pm25' then avg_value end")} as pm25,
         {mean("case when parameter = 'no2' then avg_value end")} as no2,
         {mean("case when parameter = 'o3' then avg_value end")} as o3,
         {mean("case when parameter = 'co' then avg_value end")} as co
  from air_fact where "date" between {PERIOD} group by 1)
"""
JOINED = f"""{TRIP_FACT}, {AIR_FACT.lstrip()}, {CITY_DAY}, {AIR_PIVOT},
joined as (select * from city_day join air_pivot using ("date"))
"""
COMPARED = ["pm25", "no2", "o3", "co"]


def corr(x: str, y: str) -> str:
    """Null for a constant side, as there is no correlation to speak of."""
    both = f"{x} is not null and {y} is not null"
    return (
        f"case when count(*) filter (where {both}) > 0"
        f" and min({x}) filter (where {both}) <> max({x}) filter (where {both})"
        f" and min({y}) filter (where {both}) <> max({y}) filter (where {both})"
        f" then {r(f'corr({x}, {y})', 6)} end"
    )


FX = """
fx_rows as (
  select 'USD' as "CURRENCY", 'EUR' as "CURRENCY_DENOM",
         case when o_orderkey % 53 <> 0 then d end as "TIME_PERIOD",
         case when o_orderkey % 37 <> 0 then 1.05e0 + (day(d) % 11) / 1e2 end as "OBS_VALUE"
  from (select o_orderkey, cast(date '2022-12-01' + cast(o_orderkey % 800 as int) as date) as d from orders)
  where dayofweek(d) not in (0, 6)),
fx_bronze as (select * from fx_rows where "TIME_PERIOD" between date '2023-01-01' and date '2024-12-31'),
fx as (
  select distinct "CURRENCY", "CURRENCY_DENOM", "TIME_PERIOD" as "date", "OBS_VALUE" as usd_eur_rate,
         cast(year("TIME_PERIOD") as int) as "year", cast(month("TIME_PERIOD") as int) as "month"
  from fx_bronze where "OBS_VALUE" is not null)
"""
GDP = """
gdp_bronze as (
  select 2021 + o_orderkey % 5 as "year",
         case when o_orderkey % 29 <> 0 then 1e9 * (4 + o_orderkey % 5) / 4 end as gdp_usd
  from orders where o_orderkey % 5 in (2, 3)),
gdp as (select distinct * from gdp_bronze where gdp_usd is not null)
"""
FX_DAILY = f"""
fx_daily as (
  select t."date", cast(year(t."date") as int) as "year", cast(month(t."date") as int) as "month", total_trips,
         total_fare_usd, {r("total_fare_usd / 1.08e0", 2)} as fixed_fare_eur,
         {r("total_fare_usd / usd_eur_rate", 2)} as theoretical_fare_eur,
         {r("total_fare_usd / usd_eur_rate - total_fare_usd / 1.08e0", 2)} as eur_difference, usd_eur_rate
  from (select "date", cast(sum(trip_count) as bigint) as total_trips, {r(total("total_fare_usd"), 2)} as total_fare_usd
        from trip_fact group by 1) t left join fx on t."date" = fx."date")
"""


def gdp_yearly(mean: str) -> str:
    return f"""with {TRIP_FACT}, {GDP}
select y."year", total_trips, total_fare_usd, avg_fare_usd, gdp_usd,
       {r("total_fare_usd * 100 / gdp_usd", 6)} as taxi_revenue_pct_of_gdp
from (select cast(year("date") as int) as "year", cast(sum(trip_count) as bigint) as total_trips,
             {r(total("total_fare_usd"), 2)} as total_fare_usd, {r(mean, 2)} as avg_fare_usd
      from trip_fact group by 1) y left join gdp on y."year" = gdp."year" """


LOCATIONS = f"""
air_sensors as (select distinct user_id as location_id, {SENSOR} as sensor_id, {PARAMETER} as parameter from events),
all_sensors as (
  select * from air_sensors
  union all select distinct user_id, user_id * 10 + 9, 'o3' from events),
sensors as (
  select *, 'Station ' || location_id as location_name,
         case when location_id % 17 <> 0 then (2021 + location_id % 4) || '-01-15T00:00:00Z' end as last_seen
  from all_sensors)
"""
SPANS = f"""{AIR}, {LOCATIONS},
spans as (
  select sensor_id, min(cast(measured_at as date)) as first_day, max(cast(measured_at as date)) as last_day
  from air_bronze
  where parameter in ('co', 'o3') and cast(measured_at as date) between date '2022-01-01' and date '2024-12-31'
  group by 1)
"""

VALUES = """
  select event_id, event_id // 17544 as site,
         timestamp '2024-01-01 00:00:00' + to_hours(event_id % 17544) as wall_time,
         case when event_id % 50 <> 0 then (event_id * 7 % 551) / 1e1 + -15e0 end as temperature_2m,
         (event_id * 13 % 1011) / 1e1 + 0e0 as relative_humidity_2m,
         (event_id * 3 % 401) / 1e1 + -20e0 as dew_point_2m,
         (event_id * 5 % 601) / 1e1 + -20e0 as apparent_temperature,
         (event_id * 17 % 90) / 1e1 + 0e0 as precipitation,
         case when event_id % 5 = 0 then (event_id % 30) / 1e1 end as rain,
         case when event_id % 11 = 0 then (event_id % 70) / 1e1 end as snowfall,
         case event_id % 6 when 0 then 0e0 when 1 then 3e0 when 2 then 61e0 when 3 then 95e0 when 4 then 99e0 end
           as weather_code,
         (event_id * 19 % 1010) / 1e1 + 0e0 as cloud_cover,
         (event_id * 23 % 601) / 1e1 + 980e0 as surface_pressure,
         (event_id * 11 % 800) / 1e1 + 0e0 as wind_speed_10m,
         (event_id * 29 % 1200) / 1e1 + 0e0 as wind_gusts_10m
  from events
"""
PAYLOADS = f"""
payload_rows as (
  select event_id // 216 as payload, strftime(wall_time, '%Y-%m-%dT%H:%M') as wall_time, temperature_2m,
         relative_humidity_2m, dew_point_2m, apparent_temperature, precipitation,
         case when row_number() over (partition by event_id // 216 order by event_id) <= 200 then rain end as rain,
         case when (event_id // 216) % 10 <> 0 then snowfall end as snowfall,
         weather_code, cloud_cover, surface_pressure, wind_speed_10m, wind_gusts_10m, wall_time as wall
  from ({VALUES}))
"""
# The repeated autumn hour takes its second offset here, its first in the library.
REPEATED = """wall >= timestamp '2024-11-03 01:00:00' and wall < timestamp '2024-11-03 02:00:00'
           or wall >= timestamp '2025-11-02 01:00:00' and wall < timestamp '2025-11-02 02:00:00'"""


def enriched(rows: str, key: str, name: str, fetched: str = "2026-01-01 00:00:00") -> str:
    return f"""
  select (wall at time zone 'America/New_York') at time zone 'UTC'
           - case when {REPEATED} then interval 1 hour else interval 0 hour end as ts,
         {key} as location_key, {name} as location_name, 40.7128e0 as latitude, -74.006e0 as longitude,
         temperature_2m as temperature_c, relative_humidity_2m as relative_humidity_pct, dew_point_2m as dew_point_c,
         apparent_temperature as apparent_temperature_c, precipitation as precipitation_mm, rain as rain_mm,
         snowfall as snowfall_cm, cast(weather_code as int) as weather_code,
         case cast(weather_code as int) when 0 then 'Clear sky' when 3 then 'Overcast' when 61 then 'Slight rain'
              when 95 then 'Thunderstorm' when 99 then 'Unknown (99)' end as weather_condition,
         cloud_cover as cloud_cover_pct, surface_pressure as surface_pressure_hpa,
         wind_speed_10m / 3.6e0 as wind_speed_ms, wind_gusts_10m / 3.6e0 as wind_gusts_ms,
         case when temperature_2m >= 27 then (
           -42.379e0 + 2.04901523e0 * f + 10.14333127e0 * h - 0.22475541e0 * f * h - 0.00683783e0 * f * f
           - 0.05481717e0 * h * h + 0.00122874e0 * f * f * h + 0.00085282e0 * f * h * h
           - 0.00000199e0 * f * f * h * h - 32) * 5 / 9 end as heat_index_c,
         case when temperature_2m <= 10 and wind_speed_10m / 3.6e0 > 1.34e0 then
           13.12e0 + 0.6215e0 * temperature_2m - 11.37e0 * pow(wind_speed_10m, 0.16e0)
           + 0.3965e0 * temperature_2m * pow(wind_speed_10m, 0.16e0) end as wind_chill_c,
         case when temperature_2m is not null and h is not null and wind_speed_10m is not null then
           greatest(0e0, least(100e0, 100e0 - abs(temperature_2m - 21e0) * 2e0 - abs(h - 50e0) * 0.35e0
             - greatest(wind_speed_10m / 3.6e0 - 4e0, 0e0) * 2.5e0)) end as comfort_index,
         coalesce(rain > 0, false) as is_raining, coalesce(snowfall > 0, false) as is_snowing,
         'open-meteo' as "source", timestamp '{fetched}' as fetched_at
  from (select *, temperature_2m * 9 / 5 + 32 as f, relative_humidity_2m as h from ({rows}))
"""


SITE_ROWS = f"select *, wall_time as wall from ({VALUES})"
SITE_KEY, SITE_NAME = "'site-' || site", "'Site ' || site"
WEATHER = f"weather as ({enriched(SITE_ROWS, SITE_KEY, SITE_NAME)})"
WEATHER_ROUNDED = ["wind_speed_ms", "wind_gusts_ms", "heat_index_c", "wind_chill_c", "comfort_index"]


def rounded(columns: list[str], digits: int = 6) -> str:
    return "* replace (" + ", ".join(f"{r(c, digits)} as {c}" for c in columns) + ")"


BATCH = f"""
batch as (
  select * replace (temperature_c + 1 as temperature_c)
  from ({enriched(SITE_ROWS, SITE_KEY, SITE_NAME, "2026-01-02 00:00:00")})
  where ts between timestamp '2024-07-01 05:00:00' and timestamp '2024-08-15 17:00:00' and weather_code is not null),
bounds as (select location_key, min(ts) as min_ts, max(ts) as max_ts from batch group by 1)
"""


# ---- quality --------------------------------------------------------------------------------------------------------

RULE = {
    "row_count": "expect_table_row_count_to_be_between",
    "not_null": "expect_column_values_to_not_be_null",
    "between": "expect_column_values_to_be_between",
    "in_set": "expect_column_distinct_values_to_be_in_set",
}


def _rule_row(rule: str, column: str, success: str, missing: str, unexpected: str, base: str | None) -> str:
    percent = f"coalesce({r(f'100e0 * ({unexpected}) / nullif({base}, 0)', 6)}, 0e0)" if base else "cast(null as double)"
    return (
        f"select '{RULE[rule]}' as rule, '{column}' as \"column\", {success} as success, count(*) as element_count, "
        f"cast({missing} as bigint) as missing_count, cast({unexpected} as bigint) as unexpected_count, "
        f"{percent} as unexpected_percent from t"
    )


def not_null(c: str, mostly: float = 1.0) -> str:
    broken = f"count(*) filter (where {c} is null)"
    return _rule_row("not_null", c, f"{broken} <= {1 - mostly:.4f}e0 * count(*)", "null", broken, "count(*)")


def between(c: str, low: float | None = None, high: float | None = None, mostly: float = 1.0) -> str:
    tests = " or ".join(t for t, b in ((f"{c} < {low}", low), (f"{c} > {high}", high)) if b is not None)
    broken = f"count(*) filter (where {tests})"
    success = f"{broken} <= {1 - mostly:.4f}e0 * count({c})"
    return _rule_row("between", c, success, f"count(*) - count({c})", broken, f"count({c})")


def in_set(c: str, values: str) -> str:
    success = f"count(*) filter (where {c} not in ({values})) = 0"
    return _rule_row("in_set", c, success, f"count(*) - count({c})", "null", None)


def rows_exist() -> str:
    return _rule_row("row_count", "table", "count(*) >= 1", "null", "null", None)


def rule_union(source: str, rules: list[str]) -> str:
    return f"t as (select * from {source}), results as (" + " union all ".join(rules) + ")"


WEATHER_RESULTS = rule_union(
    "weather",
    [
        rows_exist(),
        not_null("ts"),
        not_null("location_name"),
        not_null("temperature_c", 0.95),
        between("temperature_c", -50, 60),
        between("relative_humidity_pct", 0, 100),
        between("precipitation_mm", 0),
        between("rain_mm", 0),
        between("snowfall_cm", 0),
        between("cloud_cover_pct", 0, 100),
        between("wind_speed_ms", 0),
        between("wind_gusts_ms", 0),
        in_set("is_raining", "true, false"),
        in_set("is_snowing", "true, false"),
    ],
)
TRIP_RESULTS = rule_union(
    "trips",
    [
        rows_exist(),
        not_null("passenger_count", 0.9),
        not_null("fare_amount"),
        between("fare_amount", 0),
        between("trip_distance", 0, 60),
        between("passenger_count", 0, 4, 0.95),
        in_set("l_linenumber", "1, 2, 3, 4, 5, 6"),
    ],
)

WEATHER_NUMBERS = [
    "latitude", "longitude", "temperature_c", "relative_humidity_pct", "dew_point_c", "apparent_temperature_c",
    "precipitation_mm", "rain_mm", "snowfall_cm", "weather_code", "cloud_cover_pct", "surface_pressure_hpa",
    "wind_speed_ms", "wind_gusts_ms", "heat_index_c", "wind_chill_c", "comfort_index",
]
WEATHER_COLUMNS = [
    "ts", "location_key", "location_name", *WEATHER_NUMBERS[:10], "weather_condition", *WEATHER_NUMBERS[10:],
    "is_raining", "is_snowing", "source", "fetched_at",
]


def number_summary(source: str, columns: list[str]) -> str:
    rows = [
        f"select '{c}' as \"column\", count({c}) as count, {r(f'avg({c})', 6)} as mean, {r(f'stddev_samp({c})', 6)} as std, "
        f"{r(f'min({c})', 6)} as min, {r(f'quantile_cont({c}, 0.25)', 6)} as q25, "
        f"{r(f'quantile_cont({c}, 0.5)', 6)} as q50, {r(f'quantile_cont({c}, 0.75)', 6)} as q75, "
        f"{r(f'max({c})', 6)} as max from {source}"
        for c in columns
    ]
    return " union all ".join(rows)


NULL_ROWS = " union all ".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as null_count, "
    f"{r(f'100e0 * (count(*) - count({c})) / nullif(count(*), 0)', 2)} as null_percent from weather"
    for c in WEATHER_COLUMNS
)
CORR_CELLS = " union all ".join(
    f"select '{x}' as x, '{y}' as y, {corr(x, y)} as r from joined"
    for x in ["total_trips", *COMPARED]
    for y in ["total_trips", *COMPARED]
)
CORR_PAIRS = " union all ".join(
    f"select '{y.upper()}' as pollutant, count({y}) as pairs, {corr('total_trips', y)} as r from joined" for y in COMPARED
)

# ---- the queries ----------------------------------------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "schema_drift_union": f"""with {TRIPS}
        select tpep_pickup_datetime, "PULocationID", fare_amount, trip_distance,
               case when month(tpep_pickup_datetime) not between 5 and 8 then passenger_count end as passenger_count,
               airport_fee, l_orderkey, cast(l_linenumber as bigint) as l_linenumber from trips""",
    "trip_silver": f"with {TRIP_SILVER} select * from trip_silver",
    "trip_daily_fact": f"with {TRIP_FACT} select * from trip_fact",
    "zone_dim": f"with {ZONES} select * from zones",
    "zone_dim_fixed": f"""with {ZONES} select cast("LocationID" as bigint) as locationid, "Borough" as borough,
        "Zone" as "zone", service_zone from zones""",
    "trip_by_borough": f"""with {TRIP_FACT}, {ZONES}
        select "Borough" as borough, cast(sum(trip_count) as bigint) as trip_count,
               {r(total("total_fare_usd"), 2)} as total_fare_usd
        from trip_fact left join zones on zone_id = cast("LocationID" as bigint) group by 1""",
    "trip_by_year_borough": f"""with {TRIP_FACT}, {ZONES}, {CALENDAR}
        select c."year", "Borough" as borough, cast(sum(trip_count) as bigint) as trips,
               count(f."date") as days_with_trips, min(avg_fare_usd) as lowest_fare, max(avg_fare_usd) as highest_fare,
               {r(mean("avg_fare_usd"), 4)} as mean_fare
        from trip_fact f left join zones on zone_id = cast("LocationID" as bigint)
             left join calendar c on f.date_key = c.date_key group by 1, 2""",
    "trip_by_quarter_weekend": f"""with {TRIP_FACT}, {CALENDAR}
        select "quarter", is_weekend, cast(sum(trip_count) as bigint) as trip_count,
               {r(total("total_fare_usd"), 2)} as total_fare_usd
        from trip_fact f left join calendar c on f.date_key = c.date_key group by 1, 2""",
    "trip_model_sums": f"""with {TRIP_FACT}, {ZONES}, {CALENDAR}
        select c."year", "Borough" as borough, cast(sum(trip_count) as bigint) as trip_count,
               {r(total("avg_fare_usd"), 2)} as avg_fare_usd, {r(total("total_fare_usd"), 2)} as total_fare_usd,
               {r(total("avg_fare_eur"), 2)} as avg_fare_eur, {r(total("avg_distance"), 2)} as avg_distance,
               {r(total("avg_passengers"), 2)} as avg_passengers
        from trip_fact f left join zones on zone_id = cast("LocationID" as bigint)
             left join calendar c on f.date_key = c.date_key group by 1, 2""",
    "air_model_sums": f"""with {AIR_FACT}, {TRIPS}, {CALENDAR}
        select c."year", c."month", cast(sum(location_id) as bigint) as location_id,
               cast(sum(measurement_count) as bigint) as measurement_count, {r(total("avg_value"), 2)} as avg_value,
               {r(total("min_value"), 2)} as min_value, {r(total("max_value"), 2)} as max_value,
               {r(total("lat"), 2)} as lat, {r(total("lon"), 2)} as lon
        from air_fact f left join calendar c on f.date_key = c.date_key group by 1, 2""",
    "city_day_rollup": f"with {TRIP_FACT}, {CITY_DAY} select * from city_day",
    "city_day_rollup_weighted": f"""with {TRIP_FACT}
        select "date", cast(sum(trip_count) as bigint) as total_trips,
               {r(total("total_fare_usd") + " / sum(trip_count)", 2)} as avg_fare
        from trip_fact where "date" between {PERIOD} group by 1""",
    "calendar_dim": f"with {TRIPS}, {CALENDAR} select * from calendar",
    "load_reconciliation": f"""with {TRIP_SILVER}
        select s as source_rows, t as target_rows, s - t as difference
        from (select (select count(*) from trips) as s, (select count(*) from trip_silver) as t)""",
    "load_reconciliation_by_month": f"""with {TRIP_SILVER}
        select a."year", a."month", s as source_rows, coalesce(t, 0) as target_rows, s - coalesce(t, 0) as difference
        from (select cast(year(tpep_pickup_datetime) as int) as "year",
                     cast(month(tpep_pickup_datetime) as int) as "month", count(*) as s from trips group by 1, 2) a
        left join (select "year", "month", count(*) as t from trip_silver group by 1, 2) b
          on a."year" = b."year" and a."month" = b."month" """,
    "air_bronze": f"with {AIR} select * from air_bronze",
    "air_silver": f"with {AIR_SILVER} select * from air_silver",
    "air_daily_fact": f"with {AIR_FACT} select * from air_fact",
    "air_profile": f"""with {AIR} select min(measured_at) as min_measured_at, max(measured_at) as max_measured_at,
        count(*) as "rows" from air_bronze""",
    "air_count_by_parameter": f"with {AIR} select parameter, count(*) as count from air_bronze group by 1 order by 1",
    "air_count_since": f"""with {AIR} select parameter, count(*) as count from air_bronze
        where measured_at >= timestamp '2024-01-15 00:00:00' group by 1 order by 2 desc, 1""",
    "air_hourly_count": f"""with {AIR} select date_trunc('hour', measured_at) as "hour", count(*) as count
        from air_bronze group by 1""",
    "air_by_month": f"""with {AIR_FACT}, {TRIPS}, {CALENDAR}
        select c."year", c."month", parameter, cast(sum(measurement_count) as bigint) as measurements,
               {r(mean("avg_value"), 6)} as mean_value
        from air_fact f left join calendar c on f.date_key = c.date_key group by 1, 2, 3""",
    "air_pivot": f"with {AIR_FACT}, {AIR_PIVOT} select {rounded(COMPARED)} from air_pivot",
    "trip_air_joined": f'with {JOINED} select {rounded(COMPARED)} from joined order by "date"',
    "trip_air_corr": f"with {JOINED} {CORR_CELLS}",
    "trip_air_corr_pairs": f"with {JOINED} {CORR_PAIRS}",
    "fx_bronze": f"with {FX} select * from fx_bronze",
    "fx_silver": f"with {FX} select * from fx",
    "fx_dim": f"with {FX} select * from fx",
    "gdp_bronze": f"with {GDP} select * from gdp_bronze",
    "gdp_silver": f"with {GDP} select * from gdp",
    "gdp_dim": f"with {GDP} select * from gdp",
    "trip_fx_daily": f"with {TRIP_FACT}, {FX}, {FX_DAILY} select * from fx_daily",
    "trip_fx_monthly": f"""with {TRIP_FACT}, {FX}, {FX_DAILY}
        select "year", "month", cast(sum(total_trips) as bigint) as total_trips,
               {r(total("total_fare_usd"), 2)} as total_fare_usd, {r(total("fixed_fare_eur"), 2)} as fixed_fare_eur,
               {r(total("theoretical_fare_eur"), 2)} as theoretical_fare_eur,
               {r(total("eur_difference"), 2)} as eur_difference
        from fx_daily group by 1, 2""",
    "trip_gdp_yearly": gdp_yearly(mean("avg_fare_usd")),
    "trip_gdp_yearly_weighted": gdp_yearly(f"{total('total_fare_usd')} / sum(trip_count)"),
    "location_manifest": f"""select distinct {RECORD_KEY} as file_key,
        'https://archive.example/' || {RECORD_KEY} as file_url, user_id as location_id,
        cast({RECORD_YEAR} as int) as "year", cast(1 + event_id % 12 as int) as "month" from events""",
    "location_year_coverage": f"""
        select location_id, 'Station ' || location_id as location_name, string_agg(y, ',' order by y) as years
        from (select distinct user_id as location_id, {RECORD_YEAR} as y from events)
        where y in (2023, 2024) group by 1""",
    "sensor_activity": f"""with {LOCATIONS}
        select parameter, count(*) as sensors, count(*) filter (where last_seen >= '2023-01-01') as active_sensors
        from sensors where last_seen is not null group by 1""",
    "sensor_span": f"""with {SPANS}
        select s.sensor_id, parameter, location_name, first_day, last_day, last_day is not null as has_data
        from sensors s left join spans using (sensor_id) where parameter in ('co', 'o3')""",
    "sensor_last_seen": f"""with {SPANS} select s.sensor_id, parameter, location_name, last_day
        from sensors s join spans using (sensor_id) where parameter in ('co', 'o3')""",
    "allowlisted_locations": f"""with {LOCATIONS}
        select location_id as id, location_name as "name", cast(count(*) as int) as sensors from sensors
        where location_id in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by 1, 2""",
    "weather_payload_rows": f"with {PAYLOADS} select * exclude (wall) from payload_rows",
    "weather_from_payloads": f"""with {PAYLOADS}
        select {rounded(WEATHER_ROUNDED)} from ({enriched("select * from payload_rows", "'nyc'", "'NYC'")})""",
    "weather_enriched": f"with {WEATHER} select {rounded(WEATHER_ROUNDED)} from weather",
    "weather_recent": f"""with {WEATHER} select {rounded(WEATHER_ROUNDED)} from weather
        where ts > timestamp '2024-12-31 00:00:00' - interval 7 days""",
    "weather_count": f'with {WEATHER} select count(*) as "rows" from weather',
    "weather_hourly_count": f"""with {WEATHER} select date_trunc('hour', ts) as "hour", count(*) as count
        from weather group by 1""",
    "weather_first_rows": f"""with {WEATHER}
        select location_key, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, cast(weather_code as varchar) as weather_code,
               weather_condition, cast(is_raining as varchar) as is_raining, cast(is_snowing as varchar) as is_snowing
        from (select * from weather order by location_key, ts, weather_code nulls first limit 5)""",
    "weather_take": f"""with {WEATHER} select {rounded(WEATHER_ROUNDED)}
        from (select * from weather order by ts, location_key, dew_point_c limit 100)""",
    "weather_batch_bounds": f"with {BATCH} select * from bounds",
    "weather_range_replace": f"""with {WEATHER}, {BATCH}
        select {rounded(["temperature_c", *WEATHER_ROUNDED])} from (
          select w.* from weather w left join bounds b on w.location_key = b.location_key
          where not coalesce(ts between min_ts and max_ts, false)
          union all by name select * from batch)""",
    "weather_json_lines": f"with {WEATHER} select {rounded(WEATHER_ROUNDED)} from weather",
    "weather_json_text": f"""with {WEATHER}, json_rows as (
          select * replace (strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') as ts, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.000Z') as fetched_at)
          from (select {rounded(WEATHER_ROUNDED)} from weather))
        select cast(to_json(json_rows) as varchar) as line from json_rows""",
    "quality_rules": f"with {WEATHER}, {WEATHER_RESULTS} select * from results",
    "quality_statistics": f"""with {WEATHER}, {WEATHER_RESULTS}
        select bool_and(success) as success, count(*) as evaluated_expectations,
               count(*) filter (where success) as successful_expectations,
               count(*) filter (where not success) as unsuccessful_expectations from results""",
    "quality_failures": f"""with {WEATHER}, {WEATHER_RESULTS}
        select rule, "column", unexpected_count, unexpected_percent from results where not success""",
    "trip_quality_rules": f"with {TRIPS}, {TRIP_RESULTS} select * from results",
    "null_summary": f"""with {WEATHER} select * from ({NULL_ROWS}) order by null_count desc, "column" """,
    "numeric_summary": f"with {WEATHER} {number_summary('weather', WEATHER_NUMBERS)}",
    "trip_numeric_summary": f"""with {TRIPS}
        {number_summary('trips', ['fare_amount', 'trip_distance', 'passenger_count'])}""",
    "quality_report_head": f"""with {WEATHER}, {WEATHER_RESULTS}
        select 'Weather Data Quality Report' as report_name, 'weather_hourly_enriched' as "source",
               '2026-01-01T00:00:00' as generated_at_utc, (select count(*) from weather) as rows_checked,
               bool_and(success) as success, count(*) as evaluated_expectations,
               count(*) filter (where success) as successful_expectations,
               count(*) filter (where not success) as unsuccessful_expectations,
               cast(count(*) filter (where not success) as int) as failures, 20 as null_summary,
               {len(WEATHER_NUMBERS)} as numeric_summary, 5 as first_rows,
               (select "column" from ({NULL_ROWS}) order by null_count desc, "column" limit 1) as most_nulls_in,
               (select strftime(min(ts), '%Y-%m-%d %H:%M:%S') from weather) as first_ts
        from results""",
    "quality_report_failures": f"""with {WEATHER}, {WEATHER_RESULTS}
        select rule as expectation, "column", unexpected_count, unexpected_percent from results where not success""",
    "quality_report_nulls": f"""with {WEATHER}
        select cast(row_number() over (order by null_count desc, "column") - 1 as int) as position, *
        from ({NULL_ROWS}) order by position limit 20""",
    "quality_report_numbers": f"""with {WEATHER}, reported as (select {rounded(WEATHER_ROUNDED)} from weather)
        select cast(row_number() over (order by "column") - 1 as int) as position, * from ({number_summary("reported", WEATHER_NUMBERS)})""",
    "quality_report_rows": f"""with {WEATHER}
        select cast(row_number() over (order by ts, location_key) - 1 as int) as position, cast(columns(*) as varchar)
        from (select {rounded(WEATHER_ROUNDED)} from weather order by ts, location_key limit 5)""",
    "warehouse_conform": f"with {AIR_FACT} select * from air_fact",
    "warehouse_append_twice": f"with {TRIP_FACT} select * from trip_fact union all select * from trip_fact",
    "measurement_scan": f"""with {AIR} select * replace (cast(location_id % 8 as int) as source_file) from air_bronze""",
    "zone_scan": f"""with {ZONES} select * replace ("Zone" || ', "' || service_zone || '" \\' || "LocationID" as "Zone") from zones""",
    "fx_scan": f"with {FX} select * from fx_bronze",
    "gdp_scan": f"with {GDP} select * from gdp_bronze",
    "table_overwrite": f"with {AIR_FACT} select *, (select count(*) from air_fact) as written from air_fact",
    "table_partitioned": f"with {AIR_FACT} select *, 'parameter=' || parameter as folder from air_fact",
    "table_recreated": f"with {AIR_FACT} select * from air_fact where measurement_count >= 2",
    "table_mapped": f"""with {ZONES} select "LocationID" as zone_key, "Zone" as zone_name from zones""",
    "table_appended_twice": f"with {TRIP_FACT} select * from trip_fact union all select * from trip_fact",
    "warehouse_copied_twice": f"""with {AIR_FACT}, {TRIPS}, {CALENDAR}, {ZONES}, {FX}, {GDP},
        counts as (
          select 'dimdate' as "name", count(*) as n from calendar
          union all select 'dimfx', count(*) from fx
          union all select 'dimgdp', count(*) from gdp
          union all select 'dimzone', count(*) from zones
          union all select 'factairqualitydaily', count(*) from air_fact)
        select "name", n as "first", n as "second", 2 * n as "rows" from counts""",
    "layers_run": f"""with {TRIP_SILVER}, {ZONES}
        select cast(year(pickup_datetime) as int) as "year", cast(month(pickup_datetime) as int) as "month", "Borough" as borough,
               cast(count(*) as bigint) as trip_count
        from trip_silver join zones on cast("PULocationID" as varchar) = "LocationID"
        where cast(pickup_datetime as date) between {PERIOD} and month(tpep_pickup_datetime) not between 5 and 8
        group by 1, 2, 3""",
}
ORACLES["trip_scan"] = ORACLES["schema_drift_union"]
