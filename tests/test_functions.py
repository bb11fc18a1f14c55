"""Column expressions against plain Python."""

from __future__ import annotations

import math
from datetime import date, datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trilayer.functions import dates, numeric, paths
from trilayer.functions import weather as W

batches = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").coalesce(1)


def evaluate(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [
        (10.015, 2, 10.02),
        (10.014999999999999, 2, 10.02),
        (0.0049996, 2, 0.0),
        (1.00499997, 2, 1.0),
        (1000000.00499997, 2, 1000000.0),
        (-10.015, 2, -10.02),
        (2.675, 2, 2.68),
        (-0.001, 2, 0.0),
        (1.23456749, 6, 1.234567),
        (123456789012.345, 2, 123456789012.35),
        (1e30, 2, 1e30),
        (math.inf, 2, math.inf),
        (None, 2, None),
    ],
)
def test_stable_round(spark, value, digits, expected):
    assert evaluate(column(spark, [value]), numeric.stable_round("x", digits)) == [expected]


def test_stable_round_keeps_nan(spark):
    assert math.isnan(evaluate(column(spark, [math.nan]), numeric.stable_round("x", 2))[0])


@batches
@given(st.lists(st.floats(-1e13, 1e13), min_size=100, max_size=200))
def test_stable_round_equals_decimal(spark, values):
    def expected(x):
        return float(Decimal(f"{x:.14e}").quantize(Decimal("0.01"), ROUND_HALF_UP)) + 0.0

    found = evaluate(column(spark, values), numeric.stable_round("x", 2))
    # Beside a tie the fifteenth digit may be read either way.
    assert all(f == expected(x) or abs(abs(x) * 100 % 1 - 0.5) <= 1e-12 * max(abs(x), 1) for f, x in zip(found, values))
    assert all(f == expected(x) for f, x in zip(found, values) if abs(x) < 1e6)


def test_corr_of_constants_short_input_and_missing(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7.0, None), (2.0, 4.1, 7.0, 3.0), (3.0, 5.9, 7.0, None), (None, 1.0, 7.0, 1.0)],
        "a double, b double, c double, d double",
    )
    row = df.agg(
        numeric.safe_corr("a", "b").alias("ab"),
        numeric.safe_corr("a", "c").alias("ac"),
        numeric.safe_corr("a", "d").alias("ad"),
    ).first()
    assert row["ab"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert row["ac"] is None and row["ad"] is None


def test_to_int_truncates_and_tolerates(spark):
    df = column(spark, ["3.9", "-3.9", "x", None], "string")
    assert evaluate(df, numeric.to_int("x")) == [3, -3, None, None]
    assert evaluate(df, numeric.to_float("x")) == [3.9, -3.9, None, None]


def test_date_key_and_weekend(spark):
    df = column(spark, [date(2024, 3, 9), date(2024, 3, 10), date(2024, 3, 11)], "date")
    assert evaluate(df, dates.date_key(F.col("x"))) == [20240309, 20240310, 20240311]
    assert evaluate(df, dates.is_weekend(F.col("x"))) == [True, True, False]


def test_offset_text_falls_on_the_session_day(spark):
    df = column(spark, ["2023-01-01T23:00:00-05:00", "no time"], "string")
    assert evaluate(df, F.to_date(dates.from_iso_text(F.col("x")))) == [date(2023, 1, 2), None]


def test_local_to_utc_matches_zoneinfo(spark):
    zone = ZoneInfo("America/New_York")
    walls = [
        f"{day}T{hour:02d}:{minute:02d}"
        for day in ("2024-03-09", "2024-03-10", "2024-03-11", "2024-11-02", "2024-11-03", "2024-11-04")
        for hour in range(24)
        for minute in (0, 30)
    ]
    found = evaluate(column(spark, walls, "string"), dates.local_to_utc(F.col("x"), "America/New_York"))
    expected = [
        datetime.fromisoformat(w).replace(tzinfo=zone).astimezone(timezone.utc).replace(tzinfo=None) for w in walls
    ]
    assert found == expected


maybe = st.one_of(st.none(), st.floats(-40, 50).map(lambda x: round(x, 2)))
percent = st.one_of(st.none(), st.floats(0, 100).map(lambda x: round(x, 1)))
speed = st.one_of(st.none(), st.floats(0, 60).map(lambda x: round(x, 2)))


@batches
@given(st.lists(st.tuples(maybe, percent, speed), min_size=100, max_size=200))
def test_weather_formulas(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t double, h double, w double")
    t, h, w = F.col("t"), F.col("h"), F.col("w")
    out = df.select("i", W.heat_index(t, h), W.wind_chill(t, w), W.comfort_index(t, h, w), W.kmh_to_ms(w))
    for (_, heat, chill, comfort, ms), (tc, rh, wind) in zip(out.orderBy("i").collect(), rows):
        if tc is None or rh is None or tc < 27:
            assert heat is None
        else:
            f = tc * 1.8 + 32
            poly = sum(c * f**a * rh**b for (a, b), c in W.HEAT_INDEX_TERMS.items())
            assert heat == pytest.approx((poly - 32) / 1.8, abs=1e-6)
        if tc is None or wind is None or tc > 10 or wind <= 1.34:
            assert chill is None
        else:
            v = (3.6 * wind) ** 0.16
            assert chill == pytest.approx(13.12 + 0.6215 * tc - 11.37 * v + 0.3965 * tc * v, abs=1e-9)
        if None in (tc, rh, wind):
            assert comfort is None
        else:
            cost = 2 * abs(tc - 21) + 0.35 * abs(rh - 50) + (2.5 * (wind - 4) if wind > 4 else 0)
            assert comfort == pytest.approx(min(100, max(0, 100 - cost)), abs=1e-9)
        assert ms is None if wind is None else ms == pytest.approx(wind / 3.6)


def test_weather_labels(spark):
    df = column(spark, [0, 45, 95, 99, None], "int")
    assert evaluate(df, W.weather_label(F.col("x"))) == ["Clear sky", "Fog", "Thunderstorm", "Unknown (99)", None]


def test_any_fall(spark):
    assert evaluate(column(spark, [0.1, 0.0, None]), W.any_fall(F.col("x"))) == [True, False, False]


def test_paths(spark):
    df = spark.range(1)
    key = "records/csv.gz/locationid=384/year=2023/month=07/location-384-20230701.csv.gz"
    row = df.select(
        paths.record_prefix(F.lit(384), F.lit(2023), F.lit(7)),
        paths.key_location(F.lit(key)),
        paths.key_year(F.lit(key)),
        paths.key_month(F.lit(key)),
        paths.key_location(F.lit("elsewhere")),
        paths.relative_path(F.lit(f"file:///base/{key}"), "/base"),
        paths.trip_file(F.lit(2024), F.lit(3)),
    ).first()
    assert list(row) == [
        "records/csv.gz/locationid=384/year=2023/month=07/",
        384,
        2023,
        7,
        None,
        key,
        "Taxi/Yellow/2024/yellow_tripdata_2024-03.parquet",
    ]


@pytest.mark.parametrize("n", [20_000, 2_000_000])
def test_exact_mean_at_a_tie_for_any_partitions(spark, n):
    cents = F.when(F.col("id") < n // 2, 1012 - F.col("id") % 700).otherwise(1013 + (F.col("id") - n // 2) % 700)
    rows = spark.range(n).select((cents / 100.0).alias("x"))
    for parts in (1, 2, 3, 5, 8):
        found = rows.repartition(parts, F.xxhash64("x", F.rand(parts))).agg(numeric.exact_mean("x").alias("mean"), numeric.exact_sum("x").alias("sum"))
        assert numeric.round_columns(found, ["mean"], 2).first() == (10.13, n * 10.125)


def test_exact_sum_of_odd_values(spark):
    def both(values):
        return tuple(column(spark, values).agg(numeric.exact_sum("x"), numeric.exact_mean("x")).first())

    assert both([]) == both([None]) == (None, None)
    assert both([0.1] * 10 + [None]) == (1.0, 0.1)
    assert both([1e13, 1.5, -1e13]) == (1.5, 0.5) and both([1e9 - 1, 1.0]) == (1e9, 5e8)
    assert both([math.inf, 1.0]) == (math.inf, math.inf)
    assert all(math.isnan(x) for x in both([math.nan, 1.0]))
    assert both([1e-9, -1e-9, 3e-9]) == (3e-9, 1e-9)


@batches
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=300))
def test_exact_sum_equals_fsum(spark, values):
    found = column(spark, values).agg(numeric.exact_sum("x")).first()[0]
    assert found == pytest.approx(math.fsum(values), rel=1e-12, abs=1e-9)
