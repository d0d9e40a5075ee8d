import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridseries.operators import lifecycle
from gridseries.plans import backfill, batch, point, promote, update
from gridseries.plans.ingest import rebuild
from gridseries.schema import OBS_SCHEMA
from gridseries.sinks import files, versions
from gridseries.sinks.versions import laid_out
from gridseries.sinks.writers import write_catalogue, write_obs, write_raw
from gridseries.sources.snapshots import newest
from gridseries.sources.tables import empty_result, path_exists, read_catalogue, scan_obs, scan_series, series_of

T = "temperature_2m"


def rows_of(df):
    return {(r["var"], r["loc_id"], r["time"], r["value"]) for r in df.collect()}


def at(month, day=1, hour=0, year=2024):
    return dt.datetime(year, month, day, hour)


def frame(spark, rows, source="nasapower"):
    return spark.createDataFrame([(source, tier, var, loc, time, value) for tier, var, loc, time, value in rows], OBS_SCHEMA)


@pytest.fixture
def stored(spark, tmp_path):
    """History to March, current from March to mid May; May, April stay provisional for this source."""
    rows = [("historic", T, loc, at(m, 2), float(m)) for loc in (0, 1) for m in (1, 2, 3)]
    rows += [("historic", T, loc, at(12, 31, year=2023), 0.0) for loc in (0, 1)]
    rows += [("current", T, loc, at(m, 2), m + 0.5) for loc in (0, 1) for m in (3, 4, 5)]
    path = str(tmp_path / "obs")
    write_obs(frame(spark, rows), path)
    return path


def test_round_trip_and_pruning(spark, stored):
    found = scan_obs(spark, stored, source="nasapower", tiers=["historic"], variables=[T], locs=[1],
                     start="2024-01-01", end="2024-02-28")
    assert rows_of(found) == {(T, 1, at(1, 2), 1.0), (T, 1, at(2, 2), 2.0)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    head, filters = plan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0], plan.split("PushedFilters: ")[1]
    assert all(column in head for column in ("source", "tier", "var", "year"))
    assert "loc_id" in filters and "time" in filters


def test_time_only_scan_reads_one_column(spark, stored):
    plan = scan_obs(spark, stored).select("time")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<time:timestamp_ntz>" in plan


def test_no_python_in_plans(spark, stored, make_catalogue):
    out = point.point_series(scan_obs(spark, stored), make_catalogue([(-45, 170), (-45.1, 170)]),
                             "nasapower", -45.05, 170.0, [T], "2024-01-01", "2024-12-31")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "In(loc_id" in plan.replace("loc_id IN", "In(loc_id")
    assert out.count() == 5


def test_promote_moves_settled_rows(spark, stored):
    assert promote.promote(spark, stored, "nasapower")
    # newest current row is in May: rows before April are settled
    assert rows_of(scan_obs(spark, stored, tiers=["current"])) == {
        (T, loc, at(m, 2), m + 0.5) for loc in (0, 1) for m in (4, 5)}
    history = rows_of(scan_obs(spark, stored, tiers=["historic"]))
    assert (T, 0, at(3, 2), 3.5) in history and (T, 0, at(3, 2), 3.0) not in history
    assert (T, 1, at(12, 31, year=2023), 0.0) in history and len(history) == 8
    # nothing is older than the cutoff any more
    assert not promote.promote(spark, stored, "nasapower")


def test_forced_promotion_empties_the_current_tier(spark, stored):
    assert promote.promote(spark, stored, "nasapower", force=True)
    assert scan_obs(spark, stored, tiers=["current"]).isEmpty()
    assert scan_obs(spark, stored, tiers=["historic"]).count() == 12
    assert not promote.promote(spark, stored, "nasapower")


def test_mismatch_blocks_promotion(spark, stored):
    write_obs(frame(spark, [("current", "snowfall", 0, at(1, 1), 1.0)]), stored, mode="append")
    with pytest.raises(promote.SeriesMismatch):
        promote.promote(spark, stored, "nasapower")
    assert scan_obs(spark, stored, tiers=["historic"]).count() == 8


def test_mismatches_are_all_reported(spark, stored):
    write_obs(frame(spark, [("current", "snowfall", i, at(1, 1), 1.0) for i in range(30)]), stored, mode="append")
    with pytest.raises(promote.SeriesMismatch) as error:
        promote.promote(spark, stored, "nasapower")
    assert error.value.n == 30 and spark.read.parquet(error.value.report).count() == 30


def everything(spark, path):
    return sorted(map(tuple, scan_obs(spark, path).collect()), key=str)


@pytest.mark.parametrize("change", ["promote", "refresh", "append", "rebuild"])
def test_readers_see_a_change_whole_or_not_at_all(spark, stored, monkeypatch, change):
    """A read between the writing of the rows and their counting, a crash there, and a reader that began before."""
    fresh = frame(spark, [("current", T, 0, at(5, 2), 99.0), ("historic", T, 0, at(1, 2), 98.0)])
    run = {"promote": lambda: promote.promote(spark, stored, "nasapower"), "append": lambda: write_obs(fresh, stored, mode="append"),
           "refresh": lambda: promote.refresh_current(spark, fresh.filter("tier = 'current'"), stored), "rebuild": lambda: rebuild([fresh], stored)}[change]
    before, began = everything(spark, stored), scan_obs(spark, stored)
    real, seen = versions.commit, []

    def failing(spark, path, snapshot):
        seen.append(everything(spark, path))
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "commit", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run()
    assert seen == [before] and everything(spark, stored) == before
    monkeypatch.setattr(versions, "commit", real)
    run()
    after = everything(spark, stored)
    assert after != before and sorted(map(tuple, began.collect()), key=str) == before
    # what the crash and the change left behind goes
    live = {f.split("/")[0] for f in newest(spark, stored).folders}
    write_obs(frame(spark, [("current", T, 7, at(1), 1.0)]), stored, mode="append")
    assert len(everything(spark, stored)) == len(after) + 1
    kept = {f for f in files.folders(spark, stored) if f.startswith("version=")}
    assert live <= kept and len(kept) == len(live) + 1 and not files.folders(spark, f"{stored}/_work")


def listed(spark, path):
    return sorted(map(tuple, scan_series(spark, path).select("source", "tier", "var", "loc_id", "year", "first", "last", "n").collect()))


def test_the_list_of_series_follows_the_rows(spark, stored):
    def check():
        rows = series_of(scan_obs(spark, stored)).select("source", "tier", "var", "loc_id", "year", "first", "last", "n")
        assert listed(spark, stored) == sorted(map(tuple, rows.collect()))

    check()
    promote.refresh_current(spark, frame(spark, [("current", T, 0, at(6, 1), 1.0), ("current", "snowfall", 3, at(6, 1, year=2023), 1.0)]), stored)
    check()
    promote.promote(spark, stored, "nasapower", force=True)
    check()
    write_obs(frame(spark, [("current", T, 9, at(1, 1), 1.0)]), stored, mode="append")
    check()


def test_planning_reads_no_rows(spark, stored, make_catalogue):
    plan = update.plan_update(spark, stored, make_catalogue([(-45, 170)]), "2024-06-01 00:00:00")
    files_read = plan.inputFiles()
    assert files_read and all("/_series/" in f for f in files_read)


def test_planning_after_an_append_reads_no_rows(spark, stored, make_catalogue):
    for i in range(3):
        write_obs(frame(spark, [("current", T, i, at(5, 3 + i), 1.0)]), stored, mode="append")
    plan = update.plan_update(spark, stored, make_catalogue([(-45, 170)]), "2024-06-01 00:00:00")
    assert plan.inputFiles() and all("/_series/" in f for f in plan.inputFiles())
    lists = scan_series(spark, stored).filter("tier = 'current'").collect()
    assert {(r["loc_id"], r["last"], r["n"]) for r in lists} == {(0, at(5, 3), 4), (1, at(5, 4), 4), (2, at(5, 5), 1)}


def test_many_versions_become_one(spark, stored, monkeypatch):
    monkeypatch.setattr(versions, "MOST_VERSIONS", 3)
    for i in range(5):
        write_obs(frame(spark, [("current", T, 10 + i, at(5), 1.0)]), stored, mode="append")
        of_current = [f for f in newest(spark, stored).folders if "tier=current" in f]
        assert len(of_current) <= 3
    assert scan_obs(spark, stored, tiers=["current"]).count() == 11 and scan_obs(spark, stored).count() == 19
    assert scan_series(spark, stored).filter("tier = 'current'").agg(F.sum("n")).first()[0] == 11
    versions.compact(spark, stored)
    assert len(newest(spark, stored).folders) == len({f.split("/", 1)[1] for f in newest(spark, stored).folders})
    assert scan_obs(spark, stored).count() == 19


def test_a_delta_replaces_rows_with_its_keys(spark, stored):
    for value in (50.0, None, 70.0):
        versions.append_rows(frame(spark, [("current", T, 0, at(5, 2), value), ("current", T, 5, at(5, 2), value)]), stored, delta=True)
        got = {(loc, time): v for _, loc, time, v in rows_of(scan_obs(spark, stored, tiers=["current"]))}
        assert got[0, at(5, 2)] == got[5, at(5, 2)] == value and got[1, at(5, 2)] == 5.5 and len(got) == 7
    assert rows_of(scan_obs(spark, stored, tiers=["current"], locs=[5])) == {(T, 5, at(5, 2), 70.0)}
    versions.compact(spark, stored)
    assert {(loc, time): v for _, loc, time, v in rows_of(scan_obs(spark, stored, tiers=["current"]))} == got


def test_tables_from_elsewhere_are_read_but_not_changed(spark, tmp_path):
    path, rows = str(tmp_path / "plain"), frame(spark, [("current", T, 0, at(5), 1.0), ("historic", T, 0, at(1), 1.0)])
    rows.withColumn("year", F.year("time")).write.partitionBy("source", "tier", "var", "year").parquet(path)
    assert scan_obs(spark, path, tiers=["current"]).count() == 1 and scan_series(spark, path).count() == 2
    for change in (lambda: write_obs(rows, path, mode="append"), lambda: promote.refresh_current(spark, rows, path), lambda: promote.promote(spark, path, "nasapower", True)):
        with pytest.raises(ValueError, match="elsewhere"):
            change()
    write_obs(scan_obs(spark, path), path)
    assert scan_obs(spark, path).count() == 2 and promote.promote(spark, path, "nasapower", True)
    assert not [f for f in files.folders(spark, path) if f.startswith("source=")]


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "odd")
    rows = spark.createDataFrame([("a b/c", "current", "x=y %:", 0, None, 1.0), ("a b/c", "current", "x=y %:", 0, at(1), 2.0)], OBS_SCHEMA)
    write_obs(rows, path)
    versions.append_rows(rows, path, delta=True)
    assert sorted(map(tuple, scan_obs(spark, path, source="a b/c", variables=["x=y %:"]).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_only_the_neighbourhoods_of_requests_are_read(spark, tmp_path):
    """Requests at the two ends of the catalogue: the rows between are skipped by row groups."""
    places = [(lat, lon) for lat in range(-47, -33) for lon in range(166, 179)]
    catalogue = spark.createDataFrame([("nasapower", i, lat + 0.5, lon + 0.5) for i, (lat, lon) in enumerate(places)],
                                      "source string, loc_id int, latitude double, longitude double")
    obs = catalogue.select("source", F.lit("historic").alias("tier"), F.lit(T).alias("var"), "loc_id",
                           F.explode(F.expr("sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-10', interval 1 hour)")).alias("time"), F.lit(1.0).alias("value"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 2000)
    try:
        write_obs(obs, str(tmp_path / "near"), catalogue=catalogue)
        write_obs(obs, str(tmp_path / "plain"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    requests = spark.createDataFrame([(i, "nasapower", float(places[k][0]), float(places[k][1]), [T], at(1, 2), at(1, 3), "idw") for i, k in enumerate((0, 1, len(places) - 1, len(places) - 2))],
                                     "req_id int, source string, lat double, lon double, vars array<string>, start_time timestamp_ntz, end_time timestamp_ntz, mode string")

    def scanned(path):
        """The answers, and how many stored rows the scans gave."""
        found = batch.extract_stored(spark, path, requests, catalogue)
        rows, todo, total = sorted(map(tuple, found.collect())), [found._jdf.queryExecution().executedPlan()], 0
        while todo:
            node = todo.pop()
            kind = node.getClass().getSimpleName()
            if kind == "FileSourceScanExec":
                total += node.metrics().apply("numOutputRows").value()
            inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
            todo += [inner] if inner else [node.children().apply(i) for i in range(node.children().size())]
        return rows, total

    near, plain = scanned(str(tmp_path / "near")), scanned(str(tmp_path / "plain"))
    assert near[0] == plain[0] and len(near[0]) == 100
    # both ends are asked for, so a range of ids would leave out nothing
    assert near[1] < 0.4 * plain[1]
    # later versions keep the order without being given the catalogue
    promote.refresh_current(spark, obs.withColumn("tier", F.lit("current")), str(tmp_path / "near"))
    assert spark.read.parquet(*[f"{tmp_path}/near/{f}" for f in newest(spark, str(tmp_path / "near")).folders]).filter("cell is null").isEmpty()


def test_other_sources_are_left_alone(spark, stored):
    write_obs(frame(spark, [("current", T, 0, at(1, 1), 1.0)], "era5"), stored, mode="append")
    promote.promote(spark, stored, "nasapower")
    assert scan_obs(spark, stored, source="era5").count() == 1


def test_promotion_keeps_every_key(spark, stored):
    keys = ["source", "var", "loc_id", "time"]
    before = scan_obs(spark, stored).select(keys).distinct().count()
    promote.promote(spark, stored, "nasapower")
    after = scan_obs(spark, stored).select(keys)
    assert after.count() == after.distinct().count() == before


def test_refresh_replaces_equal_keys(spark, stored):
    promote.refresh_current(spark, frame(spark, [("current", T, 0, at(5, 2), 99.0), ("current", T, 0, at(6, 1), 1.0)]), stored)
    current = rows_of(scan_obs(spark, stored, tiers=["current"]))
    assert (T, 0, at(5, 2), 99.0) in current and len(current) == 7
    assert scan_obs(spark, stored, tiers=["historic"]).count() == 8


def test_update_all_starts_a_table(spark, tmp_path, make_catalogue):
    path = str(tmp_path / "fresh")
    payload = '{"properties": {"parameter": {"T2M": {"2024010100": 1.0}}}}'
    landed = {
        "nasapower": spark.createDataFrame([(0, payload)], "loc_id int, payload string"),
        "era5": [spark.createDataFrame([(170.0, -45.0, at(1, 1), 273.15)],
                                       "longitude double, latitude double, time timestamp_ntz, t2m double")],
    }
    catalogues = make_catalogue([(-45.0, 170.0)]).unionByName(make_catalogue([(-45.0, 170.0)], "era5"))
    update.update_all(spark, landed, catalogues, path)
    assert {(r["source"], r["tier"], r["value"]) for r in scan_obs(spark, path).collect()} == {
        ("nasapower", "current", 1.0), ("era5", "current", 0.0)}
    cover = update.source_coverage(spark, path, catalogues, "era5")
    assert cover.filter("n > 0").count() == 1 and cover.count() == 25


def test_rebuild_replaces_the_table(spark, stored):
    rebuild([frame(spark, [("historic", T, 0, at(1, 1), 1.0)]), frame(spark, [("historic", "snowfall", 0, at(1, 1), 2.0)])],
            stored)
    assert scan_obs(spark, stored).count() == 2


def test_catalogues_are_read_by_name(spark, tmp_path, make_catalogue):
    path = tmp_path / "stations.csv"
    path.write_text("latitude,longitude,loc_id\n-45.5,170.25,0\n")
    row = read_catalogue(spark, str(path), "stations").first()
    assert (row["loc_id"], row["latitude"], row["longitude"]) == (0, -45.5, 170.25)
    write_catalogue(make_catalogue([(-45.5, 170.25)]), str(tmp_path / "out"))
    assert read_catalogue(spark, str(tmp_path / "out"), "nasapower").collect() == make_catalogue([(-45.5, 170.25)]).collect()


def test_raw_landing_and_paths(spark, tmp_path, make_obs):
    assert not path_exists(spark, str(tmp_path / "raw"))
    write_raw(make_obs([(0, 0, 1.0)]), str(tmp_path / "raw"))
    assert path_exists(spark, str(tmp_path / "raw")) and spark.read.parquet(str(tmp_path / "raw")).count() == 1


def test_empty_result(spark):
    assert empty_result(spark, [T]).columns == ["time", T]


def test_preview(spark, stored):
    assert point.preview(scan_obs(spark, stored), "nasapower", T, 0, "2024-03-01", "2024-04-30").count() == 3


def test_resume_is_the_lowest_of_the_latest(spark):
    obs = frame(spark, [("historic", T, 0, at(3), 1.0), ("historic", T, 0, at(2), 1.0), ("historic", T, 1, at(2), 1.0),
                        ("historic", "snowfall", 1, at(6), 1.0)])
    by_var = {r["var"]: r["time"] for r in lifecycle.resume_times(obs, "var", "2024-05-01").collect()}
    assert by_var == {T: at(2), "snowfall": at(5)}


def test_grid_plan_starts_five_months_back(spark):
    obs = frame(spark, [("historic", T, 0, at(7, 15, 5), 1.0)], "era5")
    keys = backfill.collected_variables(spark, "era5")
    assert {r["var"] for r in keys.collect()} == {T, "soil_temperature_level_1"}
    plan = backfill.plan_grid(obs, keys, "2024-08-01 00:00:00", "2024-01-01")
    found = {(r["var"], r["year"], r["month"]) for r in plan.collect()}
    assert found == ({(T, 2024, m) for m in range(2, 9)} |
                     {("soil_temperature_level_1", 2023, m) for m in range(8, 13)} |
                     {("soil_temperature_level_1", 2024, m) for m in range(1, 9)})
    row = plan.filter(f"var = '{T}' and month = 2").first()
    assert row["file_name"] == "2m_temperature_2024_2.nc" and row["days"][-1] == "29" and row["days"][0] == "01"


def test_point_plan_is_clamped_per_year(spark, make_catalogue):
    plan = backfill.plan_point(frame(spark, [("historic", T, 0, at(2, 10, year=2023), 1.0)]),
                               make_catalogue([(-45, 170), (-44, 170)]), "2024-03-05 06:00:00", "2024-02-01")
    found = {(r["loc_id"], r["year"], r["start_date"], r["end_date"]) for r in plan.collect()}
    assert found == {(0, 2023, 20230101, 20231231), (0, 2024, 20240101, 20240305), (1, 2024, 20240101, 20240305)}


def test_station_selection(spark):
    meta = spark.createDataFrame([
        (1, "a", "ME", "atmosphere", "temperature", "2024-07-01T00:00:00"),
        (2, "b", "ME", "atmosphere", "temperature", "2024-05-01T00:00:00"),
        (3, "c", "YOU", "atmosphere", "temperature", "2024-07-01T00:00:00"),
        (4, "d", "ME", "pedosphere", "temperature", "2024-06-01T00:00:00"),
        (5, "e", "ME", "atmosphere", "pressure", "2024-07-01T00:00:00")],
        "station_id int, ref string, owner string, feature string, parameter string, to_date string")
    landed = spark.createDataFrame([("temperature_2m_!_a.h5",)], "file_name string")
    wanted, unknown = backfill.select_stations(meta, landed, "ME", "2024-06-01")
    assert [r["file_name"] for r in wanted.collect()] == ["soil_temperature_level_2_!_d.h5"]
    assert [r["station_id"] for r in unknown.collect()] == [5]


def test_settled_is_judged_per_series(spark):
    current = frame(spark, [("current", T, 0, at(1), 1.0), ("current", T, 0, at(6), 1.0), ("current", T, 1, at(1), 1.0)])
    marked = {(r["loc_id"], r["time"]): r["settled"] for r in lifecycle.mark_settled(current).collect()}
    assert marked == {(0, at(1)): True, (0, at(6)): False, (1, at(1)): False}


def test_sources_without_a_rule_stay_current(spark):
    current = frame(spark, [("current", T, 0, at(1), 1.0), ("current", T, 0, at(12), 1.0)], "stations")
    history, left = promote.promoted(current, current.limit(0))
    assert history.isEmpty() and left.count() == 2


def test_empty_current_is_a_no_op(spark, tmp_path):
    path = str(tmp_path / "obs")
    write_obs(frame(spark, [("historic", T, 0, at(1), 1.0)]), path)
    assert not promote.promote(spark, path, "nasapower")


def test_layout_spreads_one_long_series(spark, tmp_path):
    obs = (spark.range(20000).select(
        F.lit("nasapower").alias("source"), F.lit("historic").alias("tier"), F.lit(T).alias("var"),
        F.lit(0).alias("loc_id"), (F.lit(at(1)) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).cast("timestamp_ntz").alias("time"),
        F.col("id").cast("double").alias("value")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = laid_out(obs).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 10000
