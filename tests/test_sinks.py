"""Writes, reloads and documents."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilayer.operators import quality, reload
from trilayer.plans.gold import date_dim
from trilayer.plans.weather import enrich_weather
from trilayer.schemas import DIM_ZONE, HOURLY_FIELDS, TEXT_BYTES, conform
from trilayer.sinks import documents, tables
from trilayer.sinks import reload as sink_reload
from trilayer.sinks.reload import create_time_table, replace_range
from trilayer.sources.calendar import calendar_days

START = datetime(2024, 1, 1)


def hours(spark, key, first, count, value, skip=()):
    rows = [(key, START + timedelta(hours=first + i), value) for i in range(count) if first + i not in skip]
    return spark.createDataFrame(rows, "site string, ts timestamp, v int")


def content(df):
    return sorted((r["site"], r["ts"], r["v"]) for r in df.select("site", "ts", "v").collect())


def test_overwrite_replaces_schema_and_counts(spark):
    assert tables.write_table(spark.range(10), "bronze.t1") == 10
    other = spark.range(4).selectExpr("id as a", "'p' || id % 2 as parameter")
    assert tables.write_table(other, "bronze.t1", partition_by=["parameter"]) == 4
    assert set(spark.table("bronze.t1").columns) == {"a", "parameter"}
    assert {r[0] for r in spark.sql("SHOW PARTITIONS bronze.t1").collect()} == {"parameter=p0", "parameter=p1"}
    assert tables.write_table(spark.range(3), "bronze.t1", recreate=True) == 3


def test_partitioned_write_makes_few_files(spark):
    rows = spark.range(0, 4000, 1, 16).selectExpr("id", "if(id % 3 = 0, 'hot', 'p' || id % 5) as parameter")
    assert tables.write_table(rows, "bronze.t2", partition_by=["parameter"]) == 4000
    files = spark.table("bronze.t2").inputFiles()
    assert len(files) <= 6 * 4


def test_empty_frames(spark):
    """Counting a write of nothing must neither wait nor fail."""
    assert tables.write_table(spark.range(3).filter("id > 9"), "bronze.t4") == 0
    assert tables.write_table(spark.range(3).filter("1 = 0"), "bronze.t4") == 0
    nothing = spark.createDataFrame([], "a int, parameter string")
    assert tables.write_table(nothing, "bronze.t4", partition_by=["parameter"]) == 0
    name = "silver.weather_e"
    create_time_table(hours(spark, "a", 0, 30, 1), name, "site", "ts")
    assert replace_range(hours(spark, "a", 0, 30, 1).filter("v > 1"), name, "site", "ts") == 0
    assert spark.table(name).count() == 30


def test_mapped_replace(spark):
    rows = spark.range(2).selectExpr("id as x", "'drop' as y", "id as `a b`")
    assert tables.replace_mapped(rows, "bronze.t3", {"a b": "b", "x": "a"}) == 2
    assert spark.table("bronze.t3").columns == ["b", "a"]


def test_append_and_load(spark):
    zone = spark.createDataFrame([("1", "Q", "Z" * 9000, None, 5)], "LocationID string, Borough string, Zone string, service_zone string, more int")
    for _ in range(2):
        assert tables.append_table(zone, "warehouse.dimzone", DIM_ZONE, text_bytes=TEXT_BYTES) == 1
    assert spark.table("warehouse.dimzone").count() == 2
    assert spark.table("warehouse.dimzone").columns == ["LocationID", "Borough", "Zone", "service_zone"]
    assert spark.table("warehouse.dimzone").select(F.max(F.length("Zone"))).first()[0] == 8000
    for _ in range(2):
        assert tables.load_table(zone, "warehouse.dimzone", DIM_ZONE, text_bytes=TEXT_BYTES) == 1
    assert spark.table("warehouse.dimzone").count() == 1


def test_copy_to_warehouse(spark):
    days = date_dim(calendar_days(spark))
    assert tables.copy_to_warehouse({"dimdate": days}) == {"dimdate": 731}
    assert tables.copy_to_warehouse({"dimdate": days}) == {"dimdate": 731}
    assert spark.table("warehouse.dimdate").count() == 1462
    assert tables.copy_to_warehouse({"dimdate": days}, append=False) == {"dimdate": 731}
    assert spark.table("warehouse.dimdate").count() == 731


def test_conform(spark):
    df = spark.createDataFrame([("7", "é" * 5, "x", "y")], "locationid string, borough string, zone string, service_zone string")
    cut = conform(df, DIM_ZONE, text_bytes=5).first()
    assert cut["Borough"] == "éé" and cut["LocationID"] == "7"
    with pytest.raises(ValueError, match="service_zone"):
        conform(df.drop("service_zone"), DIM_ZONE)


def test_replaced_range_as_relation(spark):
    target = hours(spark, "a", 0, 72, 1).unionByName(hours(spark, "b", 0, 72, 1)).unionByName(
        spark.createDataFrame([("a", None, 1), (None, START, 1)], "site string, ts timestamp, v int")
    )
    batch = hours(spark, "a", 10, 30, 2, skip={20})
    after = reload.replaced_range(target, batch, "site", "ts")
    assert after.count() == 72 + 72 + 2 - 30 + 29
    assert after.filter("site = 'b'").filter("v = 1").count() == 72
    again = reload.replaced_range(after, batch, "site", "ts")
    assert again.exceptAll(after).isEmpty() and after.exceptAll(again).isEmpty()


@pytest.mark.parametrize("key", ["nyc", "a/b=c d+e'f%"])
def test_replace_range_in_a_table(spark, key):
    name = "silver.weather_t"
    target = hours(spark, key, 0, 240, 1).unionByName(hours(spark, "other", 0, 240, 1))
    assert create_time_table(target, name, "site", "ts") == 480
    # From the third day noon to the sixth day noon, with the whole fourth day missing.
    batch = hours(spark, key, 60, 72, 2, skip=set(range(72, 96)))
    expected = content(reload.replaced_range(target, batch, "site", "ts"))
    assert replace_range(batch, name, "site", "ts") == 48
    assert content(spark.table(name)) == expected
    assert replace_range(batch, name, "site", "ts") == 48
    assert content(spark.table(name)) == expected
    days = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert len(days) == 19


def test_replace_range_adds_new_days_and_keys(spark):
    name = "silver.weather_n"
    create_time_table(hours(spark, "a", 0, 48, 1), name, "site", "ts")
    batch = hours(spark, "a", 40, 40, 2).unionByName(hours(spark, "c", 0, 3, 2))
    assert replace_range(batch, name, "site", "ts") == 43
    assert spark.table(name).count() == 40 + 43


def test_replace_range_refuses_rows_without_key_or_time(spark):
    name = "silver.weather_r"
    create_time_table(hours(spark, "a", 0, 2, 1), name, "site", "ts")
    bad = spark.createDataFrame([("a", None, 1)], "site string, ts timestamp, v int")
    with pytest.raises(ValueError):
        replace_range(bad, name, "site", "ts")


def weather_rows(spark, n=30):
    row = spark.range(n).selectExpr(
        "timestamp_ntz'2024-06-01 00:00:00' + make_dt_interval(0, cast(id as int)) as wall_time",
        *(f"cast(id * {i + 1} % 41 as double) as {c}" for i, c in enumerate(HOURLY_FIELDS)),
    )
    return enrich_weather(row, F.lit("2024-06-03 00:00:00").cast("timestamp"))


def test_json_lines_round_trip(spark, tmp_path):
    rows = weather_rows(spark)
    documents.write_json_lines(rows, str(tmp_path / "w"))
    back = spark.read.schema(rows.schema).json(str(tmp_path / "w"))
    assert back.exceptAll(rows).isEmpty() and back.count() == 30


def test_quality_report_document(spark, tmp_path):
    at = datetime(2024, 6, 3, 1, 2, 3)
    report = quality.quality_report(
        weather_rows(spark), quality.WEATHER_RULES, "Weather Data Quality Report", "weather_hourly", at, ["ts"], top=20, first=5
    )
    path = documents.save_report(report, str(tmp_path), at)
    assert path.endswith("weather_quality_report_20240603_010203.json")
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == [Path(path).name]
    doc = json.loads(Path(path).read_text())
    assert doc["rows_checked"] == 30 and doc["success"] is True and doc["failures"] == []
    assert doc["statistics"] == {
        "evaluated_expectations": 14, "successful_expectations": 14, "unsuccessful_expectations": 0,
    }
    assert len(doc["null_summary"]) == 20 and len(doc["first_rows"]) == 5 and len(doc["numeric_summary"]) == 17
    counts = [n["null_count"] for n in doc["null_summary"]]
    assert counts == sorted(counts, reverse=True)
    assert doc["first_rows"][0]["ts"] == "2024-06-01 04:00:00"


def test_failing_report(spark):
    bad = weather_rows(spark).withColumn("rain_mm", F.lit(-1.0))
    report = quality.quality_report(bad, quality.WEATHER_RULES, "r", "s", START, ["ts"], top=20, first=5).first()
    assert report["success"] is False
    assert [(f["expectation"], f["column"], f["unexpected_count"]) for f in report["failures"]] == [
        ("expect_column_values_to_be_between", "rain_mm", 30)
    ]


def test_recreate_survives_a_failed_write(spark):
    tables.write_table(spark.range(3), "bronze.kept")
    with pytest.raises(Exception):
        tables.write_table(spark.range(3).withColumn("x", F.expr("raise_error('lost')")), "bronze.kept", recreate=True)
    assert spark.table("bronze.kept").count() == 3
    assert tables.write_table(spark.table("bronze.kept").withColumn("x", F.lit("new")), "bronze.kept", recreate=True) == 3
    assert spark.table("bronze.kept").columns == ["id", "x"]


def test_losses_are_counted(spark):
    rows = spark.createDataFrame([("1", "ééé"), ("x", "é"), (None, None)], "a string, b string")
    shape = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    written = tables.append_table(rows, "bronze.lossy", shape, text_bytes=4)
    assert (written, written.nulled, written.cut) == (3, 1, 1)
    written = tables.load_table(rows, "bronze.lossy", shape)
    assert (written, written.nulled, written.cut) == (3, 1, 0)
    assert {r["b"] for r in spark.table("bronze.lossy").collect()} == {"ééé", "é", None}


STEPS = ["_stage", "_swap_in", "_drop_emptied", "_forget"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_reload_cut_off_at_any_step_loses_no_row(spark, monkeypatch, step, after):
    name = f"silver.cut_{step}_{after}"
    before = hours(spark, "a", 0, 24 * 8, 1).unionByName(hours(spark, "b", 0, 48, 2))
    batch = hours(spark, "a", 30, 24 * 4, 9, skip=range(48, 96))
    create_time_table(before, name, "site", "ts")
    expected = content(reload.replaced_range(before, batch, "site", "ts"))
    work = getattr(sink_reload, step)

    def cut_off(*args):
        if after:
            work(*args)
        raise RuntimeError("cut off")

    monkeypatch.setattr(sink_reload, step, cut_off)
    # The call that clears up after an earlier run is not cut off, the one after staging is.
    monkeypatch.setattr(sink_reload, "recover", lambda s, n, real=sink_reload.recover: real(s, n) if s.catalog.tableExists(f"{n}__staged") else False)
    with pytest.raises(RuntimeError):
        replace_range(batch, name, "site", "ts")
    monkeypatch.undo()
    finished = sink_reload.recover(spark, name)
    staged_in_full = step != "_stage" or after
    assert finished == (staged_in_full and (step, after) != ("_forget", True))
    assert content(spark.table(name)) == (expected if staged_in_full else content(before))
    assert replace_range(batch, name, "site", "ts") == batch.count()
    assert content(spark.table(name)) == expected
    assert not [t.name for t in spark.catalog.listTables("silver") if t.name.startswith(name.split(".")[1] + "__")]


def test_a_swap_cut_off_half_way_is_finished(spark, monkeypatch):
    name = "silver.cut_commit"
    before, batch = hours(spark, "a", 0, 24 * 6, 1), hours(spark, "a", 0, 24 * 6, 2)
    create_time_table(before, name, "site", "ts")
    expected = content(batch)
    monkeypatch.setattr(sink_reload, "recover", lambda *_: False)
    replace_range(batch, name, "site", "ts")
    monkeypatch.undo()
    # What a lost driver leaves of a commit: partitions are gone, their new folders are not there yet.
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (site='a', day='2024-01-02'), PARTITION (site='a', day='2024-01-04')")
    assert sink_reload.recover(spark, name)
    assert content(spark.table(name)) == expected


def test_many_emptied_partitions_go_in_one_statement(spark, monkeypatch):
    name, days = "silver.emptied", 1002
    create_time_table(spark.range(days).selectExpr("'a\\'b' as site", "timestamp'2020-01-01' + make_dt_interval(cast(id as int)) as ts", "1 as v"), name, "site", "ts")
    batch = spark.range(2).selectExpr("'a\\'b' as site", f"timestamp'2020-01-01' + make_dt_interval(cast(id * {days - 1} as int)) as ts", "2 as v")
    said = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, real=type(spark).sql: (said.append(text), real(self, text))[1])
    assert replace_range(batch, name, "site", "ts") == 2
    assert len([t for t in said if "DROP IF EXISTS PARTITION" in t]) == 1
    assert spark.table(name).count() == spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_reload_leaves_the_session_as_it_is(spark):
    setting = "spark.sql.sources.partitionOverwriteMode"
    create_time_table(hours(spark, "a", 0, 30, 1), "silver.own", "site", "ts")
    before = spark.conf.get(setting)
    replace_range(hours(spark, "a", 5, 3, 2), "silver.own", "site", "ts")
    assert spark.conf.get(setting) == before


@pytest.mark.parametrize("told", ["TO bronze.again__old", "again__next RENAME TO bronze.again", "DROP TABLE IF EXISTS bronze.again__old"])
def test_recreate_cut_off_between_names(spark, monkeypatch, told):
    tables.write_table(spark.range(5), "bronze.again", recreate=True)
    real = type(spark).sql

    def cut_off(self, text):
        if text.endswith(told) and cut_off.armed:
            cut_off.armed = False
            raise RuntimeError("cut off")
        return real(self, text)

    cut_off.armed = True
    monkeypatch.setattr(type(spark), "sql", cut_off)
    with pytest.raises(RuntimeError):
        tables.write_table(spark.range(7), "bronze.again", recreate=True)
    monkeypatch.undo()
    tables.recover_swap(spark, "bronze.again")
    spark.catalog.refreshTable("bronze.again")
    assert spark.table("bronze.again").count() == (5 if told == "TO bronze.again__old" else 7)
    assert not [t.name for t in spark.catalog.listTables("bronze") if t.name.startswith("again__")]


def test_recreate_a_partitioned_table(spark):
    for n in (4, 6):
        rows = spark.range(n).selectExpr("id", "'p' || id % 2 as parameter")
        assert tables.write_table(rows, "bronze.parts", partition_by=["parameter"], recreate=True) == n
        assert spark.table("bronze.parts").count() == n
        assert spark.sql("SHOW PARTITIONS bronze.parts").count() == 2
    same = spark.table("bronze.parts").where("id < 5")
    assert tables.write_table(same, "bronze.parts", partition_by=["parameter"], recreate=True) == 5
    assert spark.table("bronze.parts").count() == 5
    assert tables.write_table(spark.range(9), "bronze.parts", recreate=True) == 9
    assert spark.table("bronze.parts").count() == 9 and spark.table("bronze.parts").columns == ["id"]


def test_recreate_a_partitioned_table_cut_off_while_it_is_written(spark, monkeypatch):
    rows = spark.range(6).selectExpr("id", "'p' || id % 2 as parameter")
    tables.write_table(rows, "bronze.cut_parts", partition_by=["parameter"], recreate=True)
    monkeypatch.setattr(tables, "_rewrite", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.write_table(rows.where("id < 4"), "bronze.cut_parts", partition_by=["parameter"], recreate=True)
    monkeypatch.undo()
    spark.sql("ALTER TABLE bronze.cut_parts DROP PARTITION (parameter='p1')")
    tables.recover_swap(spark, "bronze.cut_parts", ["parameter"])
    assert sorted(r["id"] for r in spark.table("bronze.cut_parts").collect()) == [0, 1, 2, 3]
    assert not spark.catalog.tableExists("bronze.cut_parts__whole")
