import json

import pytest
from pyspark.sql import functions as F

from gridseries.operators import validate
from gridseries.plans import batch
from gridseries.session import spread

COLUMNS = "req_id int, data_source string, lat string, lon string, var_name string, start_date string, end_date string, interp_mode string"
GOOD = dict(data_source="nasapower", lat="-44.8", lon="170.9", var_name="temperature_2m",
            start_date="2024-01-01", end_date="2024-01-02", interp_mode=None)


def raw(spark, *changes):
    rows = [(i, *({**GOOD, **c}.values())) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, COLUMNS)


def errors(spark, *changes):
    checked = validate.checked_requests(raw(spark, *changes)).orderBy("req_id").collect()
    return [r["error"] for r in checked]


def test_first_problem_wins(spark):
    found = errors(
        spark, {}, {"data_source": None, "lat": None}, {"data_source": "other", "lat": None}, {"lat": None, "var_name": None},
        {"lon": "abc", "var_name": None}, {"var_name": None, "start_date": "x"}, {"var_name": "bogus", "start_date": "x"},
        {"start_date": "2024-02-31"}, {"end_date": None}, {"data_source": "ERA5_Land", "var_name": "precipitation"},
        {"data_source": "era5", "var_name": "precipitation"})
    assert found == [
        None, "data_source is missing", "data_source is unknown", "lat or lon is missing",
        "lat and lon must be finite numbers", "var_name is missing", "unknown var_name: bogus",
        "dates must exist and be written YYYY-MM-DD", "dates must exist and be written YYYY-MM-DD", None,
        "unknown var_name: precipitation"]


def test_unknown_names_keep_order_and_repeats(spark):
    assert errors(spark, {"var_name": "b,temperature_2m,a,b, temperature_2m"}) == [
        "unknown var_name: b, a, b,  temperature_2m"]


@pytest.mark.parametrize("text,ok", [("-44.8", True), (" 1e1 ", True), ("12d", False), ("nan", False), ("inf", False),
                                     ("", False), ("1f", False), (".5", True)])
def test_numbers(spark, text, ok):
    assert (errors(spark, {"lat": text})[0] is None) == ok


def test_parsed_fields(spark):
    row = validate.checked_requests(raw(spark, {
        "data_source": "NASAPOWER", "var_name": "temperature_2m,snowfall,temperature_2m", "interp_mode": "SNAP",
        "start_date": "2024-1-5"})).first()
    assert row["source"] == "nasapower" and row["vars"] == ["temperature_2m", "snowfall"] and row["mode"] == "snap"
    assert (str(row["start_time"]), str(row["end_time"])) == ("2024-01-05 00:00:00", "2024-01-02 23:00:00")


def test_any_other_mode_is_idw(spark):
    rows = validate.checked_requests(raw(spark, {"interp_mode": "nearest"}, {}, {"interp_mode": "Idw"})).collect()
    assert {r["mode"] for r in rows} == {"idw"}


def test_shared_ids_are_refused(spark):
    rows = raw(spark, {}, {}, {}).selectExpr("if(req_id = 2, null, 5) req_id", "* except (req_id)")
    assert {r["error"] for r in validate.checked_requests(rows).collect()} == {"req_id is not unique", "req_id is missing"}


def test_run_requests_reports_every_request_once(spark, make_obs, make_catalogue, tmp_path):
    obs = make_obs([(0, h, float(h)) for h in range(48)])
    catalogue = make_catalogue([(-44.9, 170.9)])
    results, rejected = batch.run_requests(
        raw(spark, {}, {"lat": "10"}, {"lat": "x"}, {"start_date": "2025-01-01", "end_date": "2025-01-02"}), obs, catalogue,
        str(tmp_path / "results"))
    assert {r["req_id"] for r in results.select("req_id").distinct().collect()} == {0} and results.count() == 48
    assert {r["req_id"]: r["error"][:9] for r in rejected.collect()} == {1: "no values", 2: "lat and l", 3: "no values"}


def test_records(spark, make_obs):
    from gridseries.sinks.writers import to_records
    text = to_records(make_obs([(0, 0, None)]).select("loc_id", "time", "value"), "loc_id").first()["record"]
    assert json.loads(text) == {"time": "2024-01-01 00:00:00", "value": None}


def test_fan_out_after_a_join_by_the_same_key_keeps_its_partitions(spark):
    ids = spark.range(1000).withColumnRenamed("id", "req_id")
    joined = ids.join(ids.withColumn("again", F.lit(1)).hint("merge"), "req_id", "left")
    counted = spread(joined, "req_id").groupBy("req_id").count()
    assert counted.select(F.spark_partition_id()).distinct().count() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_observations_from_small_files_are_not_broadcast(spark, make_obs, tmp_path):
    make_obs([(0, h, float(h)) for h in range(24)]).write.parquet(str(tmp_path / "obs"))
    groups = spark.sql("select named_struct('source', 'nasapower', 'stencil', array(0)) as place, 0L as salt, date'2024-01-01' as day")
    found = batch.stencil_values(spark.read.parquet(str(tmp_path / "obs")), groups)
    assert found.count() == 24
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
