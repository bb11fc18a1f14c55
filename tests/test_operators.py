"""Operators on small frames, with the edges they must get right."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trilayer.operators import aggregate, coverage, joins, quality, quantiles
from trilayer.operators.clean import distinct_rows, positive, recent


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# ---- cleaning -------------------------------------------------------------------------------------------------------


def test_positive_drops_null_nan_zero_negative(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,), (math.nan,), (math.inf,)], "x double")
    assert rows_of(df.filter(positive("x"))) == [(1.0,), (math.inf,)]


def test_distinct_rows_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None), (None, None)], "a int, b string")
    assert distinct_rows(df).count() == 3


def test_recent_excludes_the_bound(spark):
    now = datetime(2024, 6, 8)
    times = [now - timedelta(days=7), now - timedelta(days=7) + timedelta(seconds=1), now, None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    assert recent(df, "ts", F.lit("2024-06-08 00:00:00").cast("timestamp")).count() == 2


# ---- aggregates -----------------------------------------------------------------------------------------------------


def test_pivot_mean(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 2.0), (1, "x", 9.0), (2, "b", None), (3, "x", 5.0)], "k int, c string, v double"
    )
    assert rows_of(aggregate.pivot_mean(df, "k", "c", ["a", "b"], "v")) == [(1, 1.5, None), (2, None, None), (3, None, None)]


def test_corr_matrix_equals_pandas(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame(rng.normal(size=(500, 3)), columns=["a", "b", "c"])
    frame["b"] += frame["a"]
    frame.loc[::7, "c"] = None
    frame["d"] = 4.0
    frame = frame.astype(object).where(frame.notna(), None)
    df = spark.createDataFrame(frame.values.tolist(), "a double, b double, c double, d double")
    expected = frame.astype(float).corr()
    found = {(r["x"], r["y"]): r["r"] for r in aggregate.corr_matrix(df, list("abcd")).collect()}
    assert len(found) == 16
    for (x, y), r in found.items():
        if "d" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(expected.loc[x, y], abs=1e-6)
    pairs = {r["y"]: (r["pairs"], r["r"]) for r in aggregate.pair_corrs(df, "a", ["b", "c"]).collect()}
    assert pairs["c"] == (428, found["a", "c"]) and pairs["b"][0] == 500


def test_first_rows_as_text(spark):
    df = spark.createDataFrame([(2, None), (1, 1.5), (3, 0.0)], "a int, b double")
    assert rows_of(aggregate.rows_as_text(df, 2, ["a"])) == [("1", "1.5"), ("2", None)]


# ---- joins ----------------------------------------------------------------------------------------------------------


def test_star_query_equals_direct_aggregation_on_a_hot_key(spark):
    fact = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7, id % 11) as zone", "cast(id % 50 as double) as v", "id % 4 as day", "if(id = 5, null, id % 2) as flag"
    )
    dim = spark.createDataFrame([(i, f"b{i % 3}") for i in range(8)], "id int, borough string")
    measures = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    found = joins.star_query(fact, [(dim, "zone", "id")], ["borough", "day"], measures)
    direct = (
        fact.join(dim, fact.zone == dim.id, "left")
        .groupBy("borough", "day")
        .agg(F.sum("v"), F.count("v"), F.min("v"), F.max("v"), F.avg("v"))
    )
    assert rows_of(found) == rows_of(direct)
    assert found.filter("borough is null").count() == 4


def test_keep_listed_ignores_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    allowed = spark.createDataFrame([(2,), (2,), (9,), (None,)], "key int")
    assert rows_of(joins.keep_listed(df, allowed, "id", "key")) == [(2,)]


# ---- coverage -------------------------------------------------------------------------------------------------------


def test_reconcile_per_key_with_null_and_one_sided_keys(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "f string")
    b = spark.createDataFrame([("x",), (None,), (None,), ("z",)], "f string")
    found = rows_of(coverage.reconcile(a, b, [F.col("f")]))
    assert found == sorted([("x", 2, 1, 1), (None, 1, 2, -1), ("y", 1, 0, 1), ("z", 0, 1, -1)], key=str)
    assert rows_of(coverage.reconcile(a.limit(0), b.limit(0))) == [(0, 0, 0)]


LOCATIONS = [
    (1, "A", ("2024-05-01T00:00:00Z",), [(11, ("o3",)), (12, ("co",))]),
    (2, None, ("2022-05-01T00:00:00Z",), [(21, ("o3",)), (22, None)]),
    (3, "C", None, [(31, ("o3",))]),
    (4, "D", ("2023-01-01T00:00:00Z",), []),
]


@pytest.fixture(scope="module")
def locations(spark):
    from trilayer.schemas import LOCATION_DOC

    return spark.createDataFrame(LOCATIONS, LOCATION_DOC)


def test_sensor_activity(spark, locations):
    assert rows_of(coverage.sensor_activity(locations)) == sorted([("o3", 2, 1), ("co", 1, 1), (None, 1, 0)], key=str)


def test_sensor_span_marks_silence(spark, locations):
    seen = [(11, "o3", datetime(2021, 1, 1)), (11, "o3", datetime(2023, 1, 1)), (11, "o3", datetime(2024, 7, 1)),
            (12, "co", datetime(2025, 1, 1)), (31, "no2", datetime(2023, 1, 1))]
    rows = spark.createDataFrame(seen, "sensor_id int, parameter string, measured_at timestamp")
    spans = coverage.sensor_span(locations, rows, ["co", "o3"], date(2022, 1, 1), date(2024, 12, 31))
    found = {r["sensor_id"]: (r["location_name"], r["first_day"], r["last_day"], r["has_data"]) for r in spans.collect()}
    assert found == {
        11: ("A", date(2023, 1, 1), date(2024, 7, 1), True),
        12: ("A", None, None, False),
        21: ("", None, None, False),
        31: ("C", None, None, False),
    }
    last = coverage.sensor_last_seen(locations, rows, ["co", "o3"])
    assert rows_of(last, "sensor_id", "last_day") == [(11, date(2024, 7, 1)), (12, date(2025, 1, 1))]


def test_location_years(spark):
    keys = [(1, 2023, 1), (1, 2023, 5), (1, 2024, 2), (2, 2022, 1), (3, 2024, 1), (None, None, None)]
    manifest = spark.createDataFrame(keys, "location_id long, year int, month int")
    assert rows_of(coverage.location_years(manifest)) == [(1, [2023, 2024]), (3, [2024])]


# ---- quantiles ------------------------------------------------------------------------------------------------------


def describe(values):
    s = pd.Series(values, dtype=float)
    d = s.describe()
    return [d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"]]


SAMPLES = {
    "normal": lambda rng: rng.normal(size=5000),
    "heavy_ties": lambda rng: np.where(rng.random(5000) < 0.4, 3.0, rng.integers(0, 9, 5000)),
    "outliers": lambda rng: np.concatenate([rng.random(4997), [1e15, 2e15, 1e-300]]),
    "constant": lambda rng: np.full(5000, 2.5),
    "two_values": lambda rng: np.repeat([1.0, 2.0], 2500),
}


@pytest.mark.parametrize("accuracy,steps", [(2000, 500), (20, 10), (60, 30)])
def test_numeric_summary_equals_pandas(spark, accuracy, steps):
    """Coarse sketches make brackets wide and overlap."""
    rng = np.random.default_rng(11)
    frame = pd.DataFrame({name: make(rng) for name, make in SAMPLES.items()})
    frame["gaps"] = frame["normal"].where(frame["normal"] > 0.3)
    df = spark.createDataFrame(frame)  # NaN stands for missing
    found = quantiles.numeric_summary(df, accuracy=accuracy, steps=steps)
    for row in found.collect():
        expected = describe(frame[row["column"]])
        assert list(row)[1:] == pytest.approx(expected, rel=1e-9), row["column"]


def test_numeric_summary_with_a_useless_sketch(spark):
    values = [float(v % 13) + v / 100 for v in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    (row,) = quantiles.numeric_summary(df, accuracy=4, steps=4).collect()
    assert list(row)[1:] == pytest.approx(describe(values), rel=1e-9)


@pytest.mark.parametrize("values", [[], [None, None], [4.0], [1.0, 2.0], [1.0, 2.0, 4.0, None]])
def test_numeric_summary_of_few_rows(spark, values):
    df = spark.createDataFrame([(v, "t") for v in values], "v double, s string")
    (row,) = quantiles.numeric_summary(df).collect()
    known = [v for v in values if v is not None]
    if not known:
        assert list(row) == ["v", 0] + [None] * 7
    else:
        expected = describe(known)
        if len(known) == 1:
            assert row["std"] is None or math.isnan(row["std"])
            assert [row["q25"], row["q50"], row["q75"]] == [4.0] * 3
        else:
            assert list(row)[1:] == pytest.approx(expected)


def test_numeric_summary_of_sorted_partitions(spark):
    """Each task sees another range of values."""
    df = spark.range(0, 20_000, 1, 16).selectExpr("cast(id as double) * id as v")
    (row,) = quantiles.numeric_summary(df, accuracy=50, steps=20).collect()
    assert list(row)[1:] == pytest.approx(describe([float(i) * i for i in range(20_000)]), rel=1e-9)


def scans(df):
    """Scans of files that a plan runs; a reused exchange counts once."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan")


def test_the_report_reads_its_input_three_times(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "numbers")
    spark.range(0, 5000, 1, 4).selectExpr("id", "id % 7 as a", "cast(id as string) as t", "id / 3 as b").write.parquet(path)
    df = spark.read.parquet(path)
    done = []
    monkeypatch.setattr(quality, "survey", lambda *a, real=quality.survey: (done.append(1), real(*a))[1])
    report = quality.quality_report(df, [quality.not_null("a")], "r", "s", datetime(2024, 1, 1), ["id"], 3, 2)
    assert len(done) + scans(report) == 3
    assert scans(quantiles.summarised(df, quantiles.survey(df, ["id", "a", "b"])[1])) == 1


def test_a_quartile_outside_its_bracket_raises(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as v")
    _, facts = quantiles.survey(df, ["v"], accuracy=100, steps=50)
    with pytest.raises(Exception, match="outside its bracket"):
        quantiles.summarised(df.where("v < 300"), facts).collect()


def test_no_numeric_column(spark):
    assert quantiles.numeric_summary(spark.createDataFrame([("a",)], "s string")).count() == 0


# ---- quality --------------------------------------------------------------------------------------------------------

RULES = [
    quality.row_count(low=1, high=3),
    quality.not_null("a"),
    quality.not_null("a", mostly=0.5),
    quality.between("a", 0, 10),
    quality.between("a", low=0, mostly=0.5),
    quality.between("b", high=5),
    quality.in_set("s", "it's", "ok"),
]


def verdicts(df, rules=RULES):
    return [(r["success"], r["unexpected_count"], r["unexpected_percent"]) for r in quality.run_rules(df, rules).collect()]


def test_rules(spark):
    df = spark.createDataFrame(
        [(1.0, 5, "ok"), (math.nan, 6, "it's"), (-1.0, None, None), (None, 1, "bad")], "a double, b int, s string"
    )
    assert verdicts(df) == [
        (False, None, None),
        (False, 2, 50.0),
        (True, 2, 50.0),
        (False, 1, 50.0),
        (True, 1, 50.0),
        (False, 1, 33.333333),
        (False, None, None),
    ]
    results = quality.run_rules(df, RULES)
    assert rows_of(quality.rule_statistics(results)) == [(False, 7, 2, 5)]
    assert quality.rule_failures(results).count() == 5


def test_rules_on_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int, s string")
    assert verdicts(df) == [
        (False, None, None), (True, 0, 0.0), (True, 0, 0.0), (True, 0, 0.0), (True, 0, 0.0), (True, 0, 0.0),
        (True, None, None),
    ]


def test_suite_equals_single_rules(spark):
    df = spark.range(100).selectExpr("if(id % 9 = 0, null, id - 3D) as a", "cast(id % 8 as int) as b", "'ok' as s")
    assert verdicts(df) == [verdicts(df, [rule])[0] for rule in RULES]


def test_rules_read_the_table_once(spark):
    df = spark.range(100).selectExpr("id - 3D as a", "cast(id % 8 as int) as b", "'ok' as s")
    plan = quality.run_rules(df, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Aggregate") == 1


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError, match="nope"):
        quality.run_rules(spark.range(1), [quality.not_null("nope")])


def test_null_summary_order(spark):
    columns = {f"c{i:02d}": None if i % 3 == 0 else 1.0 for i in range(25)}
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} double" for c in columns))
    found = [(r["column"], r["null_count"], r["null_percent"]) for r in quality.null_summary(df).collect()]
    assert len(found) == 25
    assert found[:9] == [(f"c{i:02d}", 1, 100.0) for i in range(0, 25, 3)]
    assert found[9] == ("c01", 0, 0.0)


def test_star_query_refuses_a_second_row_of_a_key(spark):
    fact = spark.createDataFrame([(1, 10.0)], "zone int, amount double")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id int, borough string")
    measures = {"total": ("sum", "amount")}
    with pytest.raises(Exception, match="more than one row"):
        joins.star_query(fact, [(dim, "zone", "id")], ["borough"], measures).collect()
    once = dim.filter("borough <> 'b'")
    assert [tuple(r) for r in joins.star_query(fact, [(once, "zone", "id")], ["borough"], measures).collect()] == [("a", 10.0)]


def test_locations_without_a_last_time_are_left_out(spark):
    shape = "id int, name string, datetimeLast struct<utc:string>, sensors array<struct<id:int,parameter:struct<name:string>>>"
    rows = [(1, "a", ("2024-01-01T00:00:00Z",), [(10, ("no2",))]), (2, "b", (None,), [(11, ("no2",))]), (3, "c", None, [(12, ("no2",))])]
    assert [tuple(r) for r in coverage.sensor_activity(spark.createDataFrame(rows, shape)).collect()] == [("no2", 1, 1)]
