"""Weather formulas as column expressions.  Any null input gives null unless stated."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather code labels.
WEATHER_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    95: "Thunderstorm",
}

# Heat index regression, (power of deg F, power of humidity %) -> coefficient.
HEAT_INDEX_TERMS = {
    (0, 0): -42.379,
    (1, 0): 2.04901523,
    (0, 1): 10.14333127,
    (1, 1): -0.22475541,
    (2, 0): -0.00683783,
    (0, 2): -0.05481717,
    (2, 1): 0.00122874,
    (1, 2): 0.00085282,
    (2, 2): -0.00000199,
}
HEAT_INDEX_MIN_C = 27.0

# Wind chill, constant, temperature, wind and mixed coefficients and the exponent of the wind in km/h.
WIND_CHILL_BASE = 13.12
WIND_CHILL_TEMP = 0.6215
WIND_CHILL_WIND = -11.37
WIND_CHILL_MIXED = 0.3965
WIND_CHILL_EXPONENT = 0.16
WIND_CHILL_MAX_C = 10.0
WIND_CHILL_MIN_MS = 1.34

# Comfort index, best value and cost per unit away from it.
COMFORT_TEMP_C, COMFORT_TEMP_COST = 21.0, 2.0
COMFORT_HUMIDITY_PCT, COMFORT_HUMIDITY_COST = 50.0, 0.35
COMFORT_WIND_MS, COMFORT_WIND_COST = 4.0, 2.5

KMH_PER_MS = 3.6


def kmh_to_ms(speed: Column) -> Column:
    return speed / F.lit(KMH_PER_MS)


def weather_label(code: Column) -> Column:
    """Label of a weather code, `Unknown (n)` for a code without one."""
    labels = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in WEATHER_LABELS.items()))
    unknown = F.concat(F.lit("Unknown ("), code.cast("string"), F.lit(")"))
    return F.when(code.isNotNull(), F.coalesce(F.try_element_at(labels, code), unknown))


def _monomial(coefficient: float, factors: list[Column]) -> Column:
    term = F.lit(coefficient)
    for factor in factors:
        term = term * factor
    return term


def heat_index(temp_c: Column, humidity: Column) -> Column:
    """Null below 27 deg C."""
    temp_f = temp_c * 9 / 5 + 32
    total = F.lit(0.0)
    for (temp_power, humidity_power), coefficient in HEAT_INDEX_TERMS.items():
        total = total + _monomial(coefficient, [temp_f] * temp_power + [humidity] * humidity_power)
    return F.when(temp_c >= HEAT_INDEX_MIN_C, (total - 32) * 5 / 9)


def wind_chill(temp_c: Column, wind_ms: Column) -> Column:
    """Null above 10 deg C or at a wind of 1.34 m/s and less."""
    wind_factor = F.pow(wind_ms * KMH_PER_MS, F.lit(WIND_CHILL_EXPONENT))
    felt = WIND_CHILL_BASE + WIND_CHILL_TEMP * temp_c + (WIND_CHILL_WIND + WIND_CHILL_MIXED * temp_c) * wind_factor
    return F.when((temp_c <= WIND_CHILL_MAX_C) & (wind_ms > WIND_CHILL_MIN_MS), felt)


def comfort_index(temp_c: Column, humidity: Column, wind_ms: Column) -> Column:
    """100 less a cost for each distance from the best values, kept within 0 and 100."""
    too_windy = F.when(wind_ms > COMFORT_WIND_MS, wind_ms - COMFORT_WIND_MS).otherwise(0.0)
    score = (
        F.lit(100.0)
        - F.abs(temp_c - COMFORT_TEMP_C) * COMFORT_TEMP_COST
        - F.abs(humidity - COMFORT_HUMIDITY_PCT) * COMFORT_HUMIDITY_COST
        - too_windy * COMFORT_WIND_COST
    )
    # greatest and least skip nulls, so the guard must come first.
    known = temp_c.isNotNull() & humidity.isNotNull() & wind_ms.isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def any_fall(amount: Column) -> Column:
    """True for a positive amount, false for none, null or NaN."""
    return F.coalesce((amount > 0) & ~F.isnan(amount), F.lit(False))
