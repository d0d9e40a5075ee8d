import datetime as dt
import json

import pytest

from gridseries.plans import answers

T, H = "temperature_2m", "relative_humidity_2m"
REQUESTS = "req_id int, source string, lat double, lon double, vars array<string>, start_time timestamp_ntz, end_time timestamp_ntz, mode string"


@pytest.fixture
def case(spark, make_obs, make_catalogue, hours):
    obs = make_obs([(0, h, h + 0.5) for h in range(60)] + [(0, 70, None)], var=T).unionByName(make_obs([(0, h, 10.0 * h) for h in range(50)], var=H))
    rows = [(1, "nasapower", -45.0, 170.0, [H, T], hours(0), hours(200), "snap"), (2, "nasapower", -45.0, 170.0, [T], hours(55), hours(80), "idw"),
            (3, "nasapower", 10.0, 10.0, [T], hours(0), hours(80), "idw")]
    return spark.createDataFrame(rows, REQUESTS), obs, make_catalogue([(-45, 170)])


@pytest.mark.parametrize("chunk", [1, 7, answers.CHUNK_HOURS])
def test_answers_do_not_depend_on_chunks(case, hours, chunk):
    found = {r["req_id"]: r for r in answers.answer_requests(*case, chunk_hours=chunk).collect()}
    assert set(found) == {1, 2}
    sent = json.loads(found[1]["answer"])
    rows = json.loads(sent["Data"])
    # in order, the variables as they were asked for
    assert [list(r) for r in rows] == [["time", H, T]] * 50 and found[1]["n"] == 50
    assert rows[3] == {"time": "2024-01-01 03:00:00", H: 30.0, T: 3.5} and [r["time"] for r in rows] == sorted(r["time"] for r in rows)
    assert sent["message"].startswith("nasapower series at -45.0,170.0 for relative_humidity_2m, temperature_2m from 2024-01-01 00:00:00")
    second = json.loads(json.loads(found[2]["answer"])["Data"])
    assert second[-1] == {"time": "2024-01-03 22:00:00", T: None} and len(second) == 6


def test_every_request_gets_a_response(spark, case, tmp_path):
    _, obs, catalogue = case
    raw = spark.createDataFrame([(1, "nasapower", "-45", "170", T, "2024-01-01", "2024-01-01", "snap"), (2, "nasapower", "10", "10", T, "2024-01-01", "2024-01-01", None),
                                 (3, "other", "1", "1", T, "2024-01-01", "2024-01-01", None), (4, "nasapower", "1", "1", 'say "x"', "2024-01-01", "2024-01-01", None)],
                                "req_id int, data_source string, lat string, lon string, var_name string, start_date string, end_date string, interp_mode string")
    found = {r["req_id"]: (r["status"], json.loads(r["answer"])) for r in answers.respond(raw, obs, catalogue, str(tmp_path / "sent"), 1).collect()}
    assert {i: s for i, (s, _) in found.items()} == {1: 200, 2: 400, 3: 400, 4: 400}
    assert len(json.loads(found[1][1]["Data"])) == 24
    assert found[2][1] == {"error": "no values near the point in the date range"} and found[4][1]["error"] == 'unknown var_name: say "x"'
