"""File scans on small trees with the damage they must tolerate."""

from __future__ import annotations

import gzip
import io
import json
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trilayer.plans.bronze import bronze_air, bronze_fx, bronze_gdp
from trilayer.schemas import FX_FILE, MEASUREMENT_FILE
from trilayer.sources import reference_data, tables
from trilayer.sources.calendar import calendar_days
from trilayer.sources.existing import existing_paths
from trilayer.sources.measurements import STATIONS, damaged_files, listed_stations, scan_measurements
from trilayer.sources.trips import read_schemas, scan_trips, trip_paths
from trilayer.sources.weather import scan_weather

HEADER = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"


def put_measurements(root, location, day, rows, header=HEADER, cut=False):
    folder = root / f"records/csv.gz/locationid={location}/year=2023/month=01"
    folder.mkdir(parents=True, exist_ok=True)
    data = gzip.compress((header + "".join(rows)).encode())
    path = folder / f"location-{location}-202301{day:02d}.csv.gz"
    path.write_bytes(data[: len(data) // 2] if cut else data)
    return path


@pytest.fixture
def air_tree(tmp_path):
    put_measurements(tmp_path, 1, 1, ['1,10,"CCNY, uptown",2023-01-01T00:00:00-05:00,40.1,-73.9,pm25,ug,3.5\n'])
    put_measurements(
        tmp_path,
        1,
        2,
        [
            "1,10,CCNY,2023-01-02T00:00:00-05:00,40.1,-73.9,pm25,ug,\n",
            "1,11,CCNY,2023-01-02T00:00:00-05:00,40.1,-73.9,temperature,c,5\n",
            "1,12,CCNY,2023-01-02T00:00:00-05:00,40.1,-73.9,o3,ppm,bad\n",
        ],
    )
    long = [f"2,20,Queens,2023-01-01T{h:02d}:{m:02d}:{s:02d}-05:00,40.2,-73.8,no2,ppm,{h + m * s}.{s}\n"
            for h in range(24) for m in range(60) for s in range(0, 60, 20)]
    put_measurements(tmp_path, 2, 1, long, cut=True)
    put_measurements(tmp_path, 2, 2, ["2,20,Queens,2023-01-02T00:00:00-05:00,40.2,-73.8,no2,ppm,1\n"])
    return tmp_path


def test_measurements_skip_a_cut_file_whole(spark, air_tree):
    rows = scan_measurements(spark, [str(air_tree), str(air_tree / "absent")], base=str(air_tree))
    assert rows.columns[-1] == "source_file" and "year" not in rows.columns
    found = {(r["location_id"], r["parameter"], r["location"], r["value"], r["source_file"]) for r in rows.collect()}
    prefix = "records/csv.gz/locationid={0}/year=2023/month=01/location-{0}-202301{1:02d}.csv.gz"
    assert found == {
        (1, "pm25", "CCNY, uptown", 3.5, prefix.format(1, 1)),
        (1, "pm25", "CCNY", None, prefix.format(1, 2)),
        (1, "o3", "CCNY", None, prefix.format(1, 2)),
        (2, "no2", "Queens", 1.0, prefix.format(2, 2)),
    }
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    damaged = damaged_files(spark, [str(air_tree)]).collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in damaged] == ["location-2-20230101.csv.gz"]


def test_measurements_without_any_path(spark, tmp_path):
    with pytest.raises(ValueError):
        scan_measurements(spark, [str(tmp_path / "absent")])


def test_listed_stations(spark):
    rows = spark.createDataFrame([(384,), (5,), (6166696,), (None,)], "location_id int")
    assert len(STATIONS) == 19
    assert {r[0] for r in listed_stations(rows).collect()} == {384, 6166696}
    assert listed_stations(rows, stations=[5]).count() == 1


def test_measurements_without_tolerance_fail(spark, air_tree):
    with pytest.raises(Exception):
        scan_measurements(spark, [str(air_tree)], skip_damaged=False).collect()


def test_measurements_are_read_by_column_name(spark, tmp_path):
    turned = HEADER.replace("lat,lon", "lon,lat")
    quoted = ",".join(f'"{name}"' for name in HEADER.strip().split(",")) + "\n"
    put_measurements(tmp_path, 3, 1, ["3,30,X,2023-01-01T00:00:00-05:00,1,2,pm25,ug,1\n"], header=turned)
    put_measurements(tmp_path, 3, 2, ["3,30,X,2023-01-02T00:00:00-05:00,2,1,pm25,ug,1\n"], header=quoted)
    put_measurements(tmp_path, 3, 3, ["3,30,X,2023-01-03T00:00:00-05:00,2,1,pm25,ug,1\n"])
    rows = scan_measurements(spark, [str(tmp_path)]).collect()
    assert [(r["lat"], r["lon"]) for r in rows] == [(2.0, 1.0)] * 3


def test_measurements_without_a_column_fail(spark, tmp_path):
    put_measurements(tmp_path, 3, 1, ["3,30,X,2023-01-01T00:00:00-05:00,1,pm25,ug,1\n"], header=HEADER.replace("lat,lon", "lat"))
    with pytest.raises(Exception):
        scan_measurements(spark, [str(tmp_path)]).collect()


def test_measurements_are_read_once(spark, air_tree):
    rows = scan_measurements(spark, [str(air_tree)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema") == 1


def test_a_file_damaged_after_the_scan_was_built_gives_no_rows(spark, air_tree):
    tolerant, strict = (scan_measurements(spark, [str(air_tree / "records/csv.gz/locationid=2/year=2023/month=01/location-2-20230102.csv.gz")], skip_damaged=x) for x in (True, False))
    assert tolerant.count() == 1
    put_measurements(air_tree, 2, 2, [f"2,20,Queens,2023-01-02T00:00:00-05:00,40.2,-73.8,no2,ppm,{i * i}\n" for i in range(9000)], cut=True)
    assert tolerant.collect() == []
    with pytest.raises(Exception):
        strict.collect()


def test_measurement_lines_parse_as_in_a_file_scan(spark, tmp_path):
    odd = [
        '5,50,"a ""b"", c",t,1,2,pm25,ug,1e1\r\n', "\n", "  \n", "5,x,\\,t,1,2,pm25,ug\n", '5,50,"a \\"q\\", z",t, 1,2,pm25,ug,3,extra\n',
        "5,50,,,,,pm25,,\n", '5,50,é"x,t,1,2,pm25,ug,-0\n', "5,50,long" + "y" * 70000 + ",t,1,2,pm25,ug,2\n", '5,50,"open,t,1,2,pm25,ug,3',
    ]
    straight = put_measurements(tmp_path / "a", 5, 1, odd)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in MEASUREMENT_FILE)
    wanted = spark.read.schema(kinds).csv(str(straight), header=True).filter("parameter = 'pm25'").collect()
    found = scan_measurements(spark, [str(straight)]).drop("source_file").collect()
    assert sorted(map(str, found)) == sorted(map(str, wanted)) and len(found) >= 5
    # The same fields behind a column more, in another order.
    names = HEADER.strip().split(",")
    moved = put_measurements(tmp_path / "b", 5, 1, ['9,1.5,ug,pm25,2,1,t,"a \\"b\\", c",50,5\n', "9,,ug,pm25\n"], header=",".join(["more", *reversed(names)]) + "\n")
    rows = scan_measurements(spark, [str(moved)]).collect()
    assert [(r["location_id"], r["location"], r["value"]) for r in rows] == [(5, 'a "b", c', 1.5), (None, None, None)]


def test_trips_of_a_folder_with_two_schemas(spark, tmp_path):
    for order in ((1, 2), (2, 1)):
        folder = tmp_path / f"trips{order[0]}"
        folder.mkdir()
        for name, kind in zip("ab", order):
            rows = spark.range(2).withColumn("extra", F.lit("x")) if kind == 1 else spark.range(3)
            rows.toPandas().to_parquet(folder / f"{name}.parquet")
        found = scan_trips(spark, [str(folder), str(tmp_path / "absent")])
        assert found.columns[-1] == "extra" and (found.count(), found.filter("extra = 'x'").count()) == (5, 2)


def test_a_refused_read_is_no_absent_path(spark):
    with pytest.raises(Exception):
        scan_trips(spark, ["nosuchstore://lake/trips.parquet"])
    with pytest.raises(Exception):
        existing_paths(spark, ["nosuchstore://lake/trips.parquet"])


def test_bronze_air(spark, air_tree):
    rows = bronze_air(scan_measurements(spark, [str(air_tree)], base=str(air_tree)))
    assert set(rows.columns) == {
        "location_id", "sensor_id", "location_name", "lat", "lon", "parameter", "units", "value", "source_file",
        "measured_at",
    }
    assert rows.filter("value = 3.5").first()["measured_at"] == datetime(2023, 1, 1, 5)


def test_trips_with_drift_absent_and_broken_files(spark, tmp_path):
    paths = trip_paths(str(tmp_path), years=[2023])[:5]
    assert paths[2].endswith("/Taxi/Yellow/2023/yellow_tripdata_2023-03.parquet")
    plain = spark.range(3).select(
        F.col("id").cast("int").alias("PULocationID"),
        F.col("id").alias("passenger_count"),
        F.lit(1.5).alias("Airport_fee"),
    )
    plain.write.parquet(paths[0])
    plain.write.parquet(paths[1])
    (
        spark.range(2)
        .select(
            F.col("id").alias("PULocationID"),
            F.lit(2.5).alias("passenger_count"),
            F.lit(0.5).alias("airport_fee"),
            F.lit("x").alias("extra"),
        )
        .write.parquet(paths[3])
    )
    broken = tmp_path / "Taxi/Yellow/2023/yellow_tripdata_2023-05.parquet"
    broken.write_bytes(b"PAR1 not parquet")
    found = scan_trips(spark, paths)
    assert dict(found.dtypes) == {
        "PULocationID": "bigint", "passenger_count": "double", "airport_fee": "double", "extra": "string",
    }
    assert found.count() == 8
    assert found.filter("extra is null").count() == 6
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_trips_of_ten_thousand_files(spark, tmp_path, monkeypatch):
    """The driver reads one footer for each distinct form, whatever the number of files."""
    kinds = [pa.schema([("a", pa.int64())]), pa.schema([("a", pa.int32())]), pa.schema([("a", pa.int64()), ("Airport_fee", pa.float64())])]
    samples = []
    for kind in kinds:
        buffer = io.BytesIO()
        pq.write_table(pa.Table.from_pylist([{"a": 1, "Airport_fee": 0.5}], schema=kind), buffer)
        samples.append(buffer.getvalue())
    for i in range(10_000):
        (tmp_path / f"part-{i:05}.parquet").write_bytes(samples[i % 3])
    (tmp_path / "notes.parquet").write_bytes(b"no table")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    calls = []
    read = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **options: calls.append(len(paths)) or read(self, *paths, **options))
    groups, skipped = read_schemas(spark, [str(tmp_path), str(tmp_path / "absent")])
    assert sorted(len(files) for _, files in groups) == [3333, 3333, 3334] and len(calls) == 3
    assert len(skipped) == 2 and skipped[str(tmp_path / "absent")] == "no such path"
    found = scan_trips(spark, [str(tmp_path)])
    assert found.agg(F.count("*"), F.sum("a"), F.sum("airport_fee")).first() == (10_000, 10_000, 3333 * 0.5)


def test_trips_without_any_file(spark, tmp_path):
    with pytest.raises(ValueError):
        scan_trips(spark, [str(tmp_path / "none.parquet")])


def test_fx_file(spark, tmp_path):
    names = [f.name for f in FX_FILE]

    def line(day, rate):
        known = {"CURRENCY": "USD", "CURRENCY_DENOM": "EUR", "TIME_PERIOD": day, "OBS_VALUE": rate,
                 "TITLE_COMPL": '"Reference rate, ""daily"", noon"', "DECIMALS": "4", "TIME_FORMAT": "P1D"}
        return ",".join(known.get(n, "") for n in names)

    lines = [",".join(names), line("2022-12-30", "1.0666"), line("2023-01-02", "1.0683"), line("2024-12-31", "1.0389"),
             line("2025-01-02", "1.03"), line("2023-05-01", ""), line("soon", "1.1"), line("2023-06-01", "n/a")]
    (tmp_path / "fx.csv").write_text("\n".join(lines) + "\n")
    raw = reference_data.scan_fx(spark, [str(tmp_path / "fx.csv")])
    assert len(raw.columns) == 32 and dict(raw.dtypes)["DECIMALS"] == "bigint"
    assert raw.first()["TITLE_COMPL"] == 'Reference rate, "daily", noon'
    kept = {(r["TIME_PERIOD"], r["OBS_VALUE"]) for r in bronze_fx(raw).collect()}
    assert kept == {
        (date(2023, 1, 2), 1.0683), (date(2024, 12, 31), 1.0389), (date(2023, 5, 1), None), (date(2023, 6, 1), None),
    }


def test_gdp_file(spark, tmp_path):
    rows = [
        {"indicator": {"id": "GDP", "value": "GDP (current US$)"}, "date": y, "value": v, "decimal": 0}
        for y, v in (("2025", None), ("2024", 2.9e13), ("2023", 27720709000000), ("2022", 1.0))
    ]
    (tmp_path / "gdp.json").write_text(json.dumps([{"page": 1}, rows], indent=1))
    raw = reference_data.scan_gdp(spark, [str(tmp_path / "gdp.json")])
    assert raw.count() == 4
    found = bronze_gdp(raw)
    assert dict(found.dtypes) == {"year": "bigint", "gdp_usd": "double"}
    assert {tuple(r) for r in found.collect()} == {(2024, 2.9e13), (2023, 27720709000000.0)}


def test_zone_file(spark, tmp_path):
    text = 'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n2,Queens,"The \\"Bay\\"",Boro Zone\nx,,,\n'
    (tmp_path / "zones.csv").write_text(text)
    rows = reference_data.scan_zones(spark, [str(tmp_path / "zones.csv")]).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "EWR", "Newark, Airport", "EWR"), ("2", "Queens", 'The "Bay"', "Boro Zone"), ("x", None, None, None),
    ]


def test_location_pages(spark, tmp_path):
    pages = [
        {"id": 1, "name": "A", "datetimeLast": {"utc": "2024-01-01T00:00:00Z"}, "bounds": [1],
         "sensors": [{"id": 5, "parameter": {"id": 2, "name": "o3"}}]},
        {"id": 2, "name": None, "datetimeLast": None, "sensors": []},
    ]
    (tmp_path / "p1.json").write_text(json.dumps(pages[0]))
    (tmp_path / "p2.json").write_text(json.dumps(pages[1]))
    found = reference_data.scan_locations(spark, [str(tmp_path / "p1.json"), str(tmp_path / "p2.json")])
    assert found.count() == 2
    assert found.filter("id = 1").select("sensors.parameter.name").first()[0] == ["o3"]


def test_listing_files(spark, tmp_path):
    key = "records/csv.gz/locationid=7/year=2024/month=12/location-7-20241201.csv.gz"
    (tmp_path / "a.xml").write_text(f"<R>\n<Contents><Key>{key}</Key></Contents><Contents><Key>other</Key></Contents></R>")
    (tmp_path / "b.xml").write_text("<R></R>")
    listing = reference_data.scan_listings(spark, [str(tmp_path)])
    rows = reference_data.manifest_from_listing(listing, "https://x/").orderBy("file_key").collect()
    assert [tuple(r) for r in rows] == [
        ("other", "https://x/other", None, None, None),
        (key, f"https://x/{key}", 7, 2024, 12),
    ]


def test_weather_file(spark, tmp_path):
    hourly = {
        "time": ["2024-03-10T01:00", "2024-03-10T02:00", "2024-03-10T03:00"],
        "temperature_2m": [1.5, None, 3],
        "rain": [0.5],
        "weather_code": [61, 3, 0, 99, 99],
    }
    (tmp_path / "w.json").write_text(json.dumps({"latitude": 40.7, "hourly": hourly, "hourly_units": {"rain": "mm"}}))
    rows = scan_weather(spark, [str(tmp_path / "w.json")]).orderBy("wall_time").collect()
    assert [(r["wall_time"][-5:], r["temperature_2m"], r["rain"], r["weather_code"], r["snowfall"]) for r in rows] == [
        ("01:00", 1.5, 0.5, 61.0, None),
        ("02:00", None, None, 3.0, None),
        ("03:00", 3.0, None, 0.0, None),
    ]


def test_calendar_and_catalog(spark):
    assert calendar_days(spark).count() == 731
    spark.range(4).selectExpr("id", "id * 2 as twice").write.mode("overwrite").saveAsTable("gold.dimgdp")
    assert tables.read_table(spark, "gold.dimgdp", ["twice"]).columns == ["twice"]
    assert list(tables.model_tables(spark, "gold")) == ["dimgdp"]
    spark.sql("DROP TABLE gold.dimgdp")
