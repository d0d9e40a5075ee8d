import json
import math

import pytest
from pyspark.sql import functions as F

from gridseries.plans import ingest
from gridseries.schema import REQUEST_NAMES, VARIABLES
from gridseries.sources import raw
from gridseries.sources.layouts import describe_files

S = -999.0


def payload(params):
    return json.dumps({"properties": {"parameter": params}})


def test_payload_hours_are_aligned(spark):
    text = payload({"T2M": {"2024010100": 1.0, "2024010101": 2.0}, "PS": {"2024010101": 9.0}})
    rows = raw.parse_point_payload(spark.createDataFrame([(4, text)], "loc_id int, payload string"), "payload", ["loc_id"])
    got = {(r["raw_name"], str(r["time"])): r["value"] for r in rows.collect()}
    assert got == {("T2M", "2024-01-01 00:00:00"): 1.0, ("T2M", "2024-01-01 01:00:00"): 2.0,
                   ("PS", "2024-01-01 00:00:00"): None, ("PS", "2024-01-01 01:00:00"): 9.0}


def test_ingest_point(spark, hours):
    text = payload({"T2M": {"2024010101": 1.0, "2024010201": S, "2024010301": 3.0, "2024010302": S},
                    "XYZ": {"2024010101": 5.0}})
    rows = ingest.ingest_point(spark.createDataFrame([(4, text)], "loc_id int, payload string"))
    got = [(r["var"], r["time"], r["value"]) for r in rows.orderBy("var", "time").collect()]
    # the unknown parameter keeps its name; hours it lacks are null
    assert got[:4] == [("XYZ", hours(1), 5.0), ("XYZ", hours(25), None), ("XYZ", hours(49), None), ("XYZ", hours(50), None)]
    assert got[4:] == [("temperature_2m", hours(1), 1.0), ("temperature_2m", hours(25), 1.0), ("temperature_2m", hours(49), 3.0)]
    assert {(r["source"], r["tier"]) for r in rows.collect()} == {("nasapower", "current")}


GRID = "longitude float, latitude float, valid_time timestamp_ntz, {}"


def test_ingest_grid_converts_and_drops(spark, make_catalogue, hours):
    frame = spark.createDataFrame(
        [(170.25, -45.0, hours(0), 283.15, 1), (170.25, -45.0, hours(1), None, 1), (170.25, -45.0, hours(2), 283.15, None),
         (150.0, -45.0, hours(0), 283.15, 1)], GRID.format("t2m double, expver int"))
    rows = ingest.ingest_grid(frame, make_catalogue([(-45.0, 170.25)], source="era5"), "era5").collect()
    assert [(r["var"], r["loc_id"], r["time"], round(r["value"], 6)) for r in rows] == [("temperature_2m", 0, hours(0), 10.0)]


def test_other_grid_variables_are_not_converted(spark, make_catalogue, hours):
    frame = spark.createDataFrame([(170.25, -45.0, hours(0), 283.15)], GRID.format("tp double"))
    catalogue = make_catalogue([(-45.0, 170.25)], source="era5").unionByName(make_catalogue([(-45.0, 170.25)], "era5_land"))
    assert [(r["var"], r["value"]) for r in ingest.ingest_grid(frame, catalogue, "era5_land").collect()] == [
        ("precipitation", 283.15)]
    assert ingest.ingest_grid(frame, catalogue, "era5").first()["var"] == "total_precipitation"


def test_ambiguous_grid_is_refused(spark, make_catalogue, hours):
    frame = spark.createDataFrame([(170.25, -45.0, hours(0), 1.0, 2.0)], GRID.format("t2m double, tp double"))
    with pytest.raises(ValueError):
        ingest.ingest_grid(frame, make_catalogue([(-45.0, 170.25)], source="era5"), "era5")


def test_grid_extracts_with_different_time_names(spark, tmp_path, hours):
    spark.createDataFrame([(1.0, 2.0, hours(0), 3.0)], GRID.format("tp double")).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(hours(1), 1.0, 2.0, 4.0)], "time timestamp_ntz, latitude float, longitude float, tp double"
                          ).write.parquet(str(tmp_path / "b"))
    both = raw.read_grid_raw(spark, [str(tmp_path / "a"), str(tmp_path / "b")], "era5")
    assert {(r["raw_name"], r["time"], r["value"]) for r in both.collect()} == {("tp", hours(0), 3.0), ("tp", hours(1), 4.0)}


def test_an_auxiliary_column_of_one_file_drops_no_rows_of_others(spark, make_catalogue, tmp_path, hours):
    spark.createDataFrame([(170.0, -45.0, hours(0), 1.0), (170.0, -45.0, hours(3), None)], GRID.format("tp double")
                          ).write.parquet(str(tmp_path / "total_precipitation_2024_1.nc"))
    spark.createDataFrame([(170.0, -45.0, hours(1), 2.0, 7), (170.0, -45.0, hours(2), 2.0, None)], GRID.format("tp double, number int")
                          ).write.parquet(str(tmp_path / "total_precipitation_2024_2.nc"))
    manifest = spark.createDataFrame([("total_precipitation_2024_1.nc",), ("total_precipitation_2024_2.nc",),
                                      ("runoff_2024_1.nc",)], "file_name string")
    catalogue = make_catalogue([(-45.0, 170.0)], source="era5")
    rows = ingest.ingest_grid_files(spark, manifest, str(tmp_path), "total_precipitation", catalogue, "era5")
    assert {(r["var"], r["time"], r["value"]) for r in rows.collect()} == {
        ("total_precipitation", hours(0), 1.0), ("total_precipitation", hours(1), 2.0)}
    assert ingest.ingest_grid_files(spark, manifest, str(tmp_path), "snowfall", catalogue, "era5").isEmpty()


def test_bad_payloads_are_reported(spark, hours):
    rows = [(1, payload({"T2M": {"2024010100": 1.0, "20240101": 2.0, "2024019900": 3.0}})), (2, '{"properties": {"par'), (3, None),
            (4, '{"message": "no data"}')]
    frame = spark.createDataFrame(rows, "loc_id int, payload string")
    assert [(r["loc_id"], r["time"], r["value"]) for r in ingest.ingest_point(frame).collect()] == [(1, hours(0), 1.0)]
    found = {(r["loc_id"], r["reason"]) for r in ingest.point_rejects(frame).collect()}
    assert found == {(1, "bad hour key: 20240101"), (1, "bad hour key: 2024019900"), (2, "no readable parameters"),
                     (3, "no readable parameters"), (4, "no readable parameters")}


STATION = "var string, ref string, latitude double, longitude double, time timestamp_ntz, value double"


def test_ingest_stations(spark, make_catalogue, hours):
    rows = spark.createDataFrame([
        ("temperature_2m", "a", -41.0, 175.0, hours(0), 1.0), ("temperature_2m", "b", -43.0, 172.0, hours(0), 2.0),
        ("wind_speed_2m", "timaru_coastal_hv", 0.0, 0.0, hours(0), 3.0),
        ("temperature_2m", "timaru_coastal_hv", -44.0, 171.0, hours(0), 4.0),
        ("None", "c", -41.0, 175.0, hours(0), 5.0)], STATION)
    obs, catalogue, rejects = ingest.ingest_stations(rows, make_catalogue([(-41.0, 175.0)], source="stations"))
    places = {r["loc_id"]: (r["latitude"], r["longitude"]) for r in catalogue.collect()}
    assert places == {0: (-41.0, 175.0), 1: (-44.30493, 171.22158), 2: (-44.0, 171.0), 3: (-43.0, 172.0)}
    assert {(r["var"], r["loc_id"], r["value"]) for r in obs.collect()} == {
        ("temperature_2m", 0, 1.0), ("temperature_2m", 3, 2.0), ("wind_speed_2m", 1, 3.0), ("temperature_2m", 2, 4.0)}
    assert [r["value"] for r in rejects.collect()] == [5.0]


def test_broken_station_ids_are_refused(spark, make_catalogue, hours):
    rows = spark.createDataFrame([("temperature_2m", "a", -41.0, 175.0, hours(0), 1.0)], STATION)
    broken = make_catalogue([(-41.0, 175.0)], source="stations").withColumn("loc_id", F.lit(7))
    with pytest.raises(ValueError):
        ingest.ingest_stations(rows, broken)


def test_station_files_are_named_by_file(spark, tmp_path, hours):
    import os
    frame = spark.createDataFrame([(hours(0), -41.0, 175.0, "p", 2.0, "x", "n", "i", "r", 7.5)],
                                  "time timestamp_ntz, lat double, lon double, geometry string, height double, "
                                  "externalId string, name string, station_id string, ref string, temperature double")
    frame.coalesce(1).write.parquet(str(tmp_path / "out"))
    (tmp_path / "raw").mkdir()
    part = next(f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet"))
    (tmp_path / "raw" / "temperature_2m_!_akaroa_hv.parquet").write_bytes((tmp_path / "out" / part).read_bytes())
    row = raw.read_station_raw(spark, str(tmp_path / "raw")).first()
    assert (row["var"], row["ref"], row["latitude"], row["value"]) == ("temperature_2m", "akaroa_hv", -41.0, 7.5)


def test_grid_files_of_a_variable(spark):
    manifest = spark.createDataFrame([(n,) for n in (
        "2m_temperature_2024_1.nc", "2m_temperature_2024_2.netcdf.zip", "2m_dewpoint_temperature_2024_1.nc",
        "2m_temperature_2024_1.grib", "total_precipitation_2024_1.nc")], "file_name string")
    names = {r["file_name"] for r in raw.grid_files_of(manifest, "temperature_2m").collect()}
    assert names == {"2m_temperature_2024_1.nc", "2m_temperature_2024_2.netcdf.zip"}


def test_nan_in_a_payload_column_is_dropped_from_grids(spark, make_catalogue, hours):
    frame = spark.createDataFrame([(170.25, -45.0, hours(0), math.nan)], GRID.format("tp double"))
    assert ingest.ingest_grid(frame, make_catalogue([(-45.0, 170.25)], source="era5"), "era5").isEmpty()


def one_file(frame, path):
    import os
    out = f"{path}.written"
    frame.coalesce(1).write.parquet(out)
    part = next(f for f in os.listdir(out) if f.endswith(".parquet"))
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(open(f"{out}/{part}", "rb").read())


STATION_FILE = "time timestamp_ntz, lat double, lon double, {}"


def test_station_files_with_different_value_columns(spark, tmp_path, hours):
    """Each file's value is its own last column: none is lost, as it would be with one schema for all."""
    folder = tmp_path / "raw"
    one_file(spark.createDataFrame([(hours(0), -41.0, 175.0, 7.5)], STATION_FILE.format("air_temperature double")), folder / "temperature_2m_!_a.parquet")
    one_file(spark.createDataFrame([(hours(0), -41.0, 175.0, 80)], STATION_FILE.format("humidity int")), folder / "relative_humidity_2m_!_a.parquet")
    one_file(spark.createDataFrame([("x", -41.0, hours(1), 175.0, "y", 3.0)], "ref string, lat double, time timestamp_ntz, lon double, geometry string, humidity double"),
             folder / "relative_humidity_2m_!_b.parquet")
    one_file(spark.createDataFrame([(1,)], "other int"), folder / "no_station.parquet")
    got = {(r["var"], r["ref"], r["time"], r["value"]) for r in raw.read_station_raw(spark, str(folder)).collect()}
    assert got == {("temperature_2m", "a", hours(0), 7.5), ("relative_humidity_2m", "a", hours(0), 80.0), ("relative_humidity_2m", "b", hours(1), 3.0)}


def test_station_csv_files_differ_too(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "temperature_2m_!_a.csv").write_text('﻿"time",lat,lon,air\r\n2024-01-01,-41,175,7.5\r\n', encoding="utf-8")
    (tmp_path / "raw" / "wind_speed_2m_!_a.csv").write_text("lat,lon,time,wind\n-41,175,2024-01-01,3\n")
    got = {(r["var"], r["latitude"], r["value"]) for r in raw.read_station_raw(spark, str(tmp_path / "raw"), "csv").select("var", F.col("latitude").cast("double"), "value").collect()}
    assert got == {("temperature_2m", -41.0, 7.5), ("wind_speed_2m", -41.0, 3.0)}


def test_station_files_without_a_value_are_refused(spark, tmp_path, hours):
    one_file(spark.createDataFrame([(1.0, hours(0), -41.0, 175.0)], "air double, time timestamp_ntz, lat double, lon double"), tmp_path / "raw" / "temperature_2m_!_a.parquet")
    with pytest.raises(ValueError, match="value"):
        raw.read_station_raw(spark, str(tmp_path / "raw"))


def jobs_of(spark, action):
    """How many Spark jobs an action starts."""
    group = f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_many_files_are_described_by_few_jobs(spark, tmp_path, hours):
    small, large = tmp_path / "small", tmp_path / "large"
    first, second = tmp_path / "a.parquet", tmp_path / "b.parquet"
    one_file(spark.createDataFrame([(1.0, 2.0, hours(0), 3.0)], GRID.format("tp double")), first)
    one_file(spark.createDataFrame([(1.0, 2.0, hours(0), 3.0, 1)], GRID.format("tp double, number int")), second)
    for folder, n in ((small, 50), (large, 1000)):
        folder.mkdir()
        for i in range(n):
            (folder / f"total_precipitation_2024_{i}.nc").write_bytes((first if i % 2 else second).read_bytes())

    def read(folder, n):
        paths = [f"{folder}/total_precipitation_2024_{i}.nc" for i in range(n)]
        assert raw.read_grid_raw(spark, paths, "era5").count() == n

    assert jobs_of(spark, lambda: read(small, 50)) <= jobs_of(spark, lambda: read(large, 1000)) < 15


def test_layouts_can_be_kept_in_the_manifest(spark, make_catalogue, tmp_path, hours):
    one_file(spark.createDataFrame([(170.0, -45.0, hours(0), 1.0)], GRID.format("tp double")), tmp_path / "raw" / "total_precipitation_2024_1.nc")
    one_file(spark.createDataFrame([(170.0, -45.0, hours(0), 283.15, 1)], GRID.format("t2m double, number int")), tmp_path / "raw" / "2m_temperature_2024_1.nc")
    described = describe_files(spark, str(tmp_path / "raw"))
    assert {tuple(r["columns"][3:]) for r in described.collect()} == {("tp",), ("t2m", "number")}
    manifest = described.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "layout")
    catalogue = make_catalogue([(-45.0, 170.0)], source="era5")
    rows = ingest.ingest_grid_files(spark, manifest, str(tmp_path / "raw"), ["total_precipitation", "temperature_2m", "runoff"], catalogue, "era5")
    assert {(r["var"], round(r["value"], 3)) for r in rows.collect()} == {("total_precipitation", 1.0), ("temperature_2m", 10.0)}


def test_rebuild_has_a_branch_for_each_layout(spark, make_catalogue, tmp_path, hours):
    """Fifty variables in two layouts are two scans, not fifty."""
    manifest = []
    for var in sorted(set(VARIABLES["era5"].values())):
        short = next(k for k, v in VARIABLES["era5"].items() if v == var)
        name = f"{REQUEST_NAMES.get(var, var)}_2024_1.nc"
        one_file(spark.createDataFrame([(170.0, -45.0, hours(0), 300.0)], GRID.format(f"{'t2m' if short == 't2m' else 'tp'} double")), tmp_path / "land" / name)
        manifest.append(("era5", name))
    frame = spark.createDataFrame(manifest, "source string, file_name string")
    rows = ingest.ingest_grid_files(spark, frame, str(tmp_path / "land"), sorted(set(VARIABLES["era5"].values())), make_catalogue([(-45.0, 170.0)], source="era5"), "era5")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [longitude") == 2 and rows.count() == len(manifest)
