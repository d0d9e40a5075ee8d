import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridseries.operators import series, shape
from gridseries.plans import batch, point

T, H = "temperature_2m", "relative_humidity_2m"
LAST = "2024-12-31"


def ask(obs, catalogue, variables=(T,), mode="idw", lat=-45.0, lon=170.0, start="2024-01-01", end=LAST):
    return point.point_series(obs, catalogue, "nasapower", lat, lon, list(variables), start, end, mode)


def test_weighted_mean_of_four(make_obs, make_catalogue):
    # distances 0.1 0.2 0.4 0.4: weights 10 5 2.5 2.5 over 20
    catalogue = make_catalogue([(-45.1, 170), (-45.2, 170), (-45.4, 170), (-44.6, 170), (-45.9, 170)])
    obs = make_obs([(0, 0, 1.0), (1, 0, 2.0), (2, 0, 4.0), (3, 0, 8.0), (4, 0, 100.0)])
    assert ask(obs, catalogue).first()[T] == pytest.approx(0.5 * 1 + 0.25 * 2 + 0.125 * 4 + 0.125 * 8)


def test_snap_is_the_nearest_series(make_obs, make_catalogue):
    catalogue = make_catalogue([(-45.1, 170), (-45.2, 170)])
    assert ask(make_obs([(0, 0, 1.0), (1, 0, 2.0)]), catalogue, mode="SNAP").first()[T] == 1.0


def test_on_top_of_a_location(make_obs, make_catalogue):
    catalogue = make_catalogue([(-45.0, 170.0), (-45.2, 170)])
    assert ask(make_obs([(0, 0, 3.0), (1, 5, 2.0)]), catalogue).first()[T] == 3.0


def test_no_neighbour_gives_an_empty_result(make_obs, make_catalogue):
    out = ask(make_obs([(0, 0, 1.0)]), make_catalogue([(-30.0, 170.0)]))
    assert out.isEmpty() and out.columns == ["time", T]


def test_three_neighbours_are_enough(make_obs, make_catalogue):
    catalogue = make_catalogue([(-45.5, 170), (-44.5, 170), (-45.0, 170.5)])
    assert ask(make_obs([(i, 0, 3.0) for i in range(3)]), catalogue).first()[T] == pytest.approx(3.0)


def test_time_missing_at_one_neighbour_is_dropped(make_obs, make_catalogue):
    catalogue = make_catalogue([(-45.5, 170), (-44.5, 170)])
    obs = make_obs([(0, 0, 1.0), (1, 0, 1.0), (0, 1, 1.0), (0, 2, 1.0), (1, 2, -999.0)])
    assert ask(obs, catalogue).count() == 1


def test_null_at_a_neighbour_keeps_the_time(make_obs, make_catalogue, hours):
    catalogue = make_catalogue([(-45.5, 170), (-44.5, 170)])
    rows = ask(make_obs([(0, 0, None), (1, 0, 1.0)]), catalogue).collect()
    assert [(r["time"], r[T]) for r in rows] == [(hours(0), None)]


def test_history_wins_and_tiers_do_not_complete_each_other(make_obs, make_catalogue, hours):
    catalogue = make_catalogue([(-45.5, 170), (-44.5, 170)])
    obs = make_obs([(0, 0, 1.0, "historic"), (1, 0, 1.0, "historic"), (0, 0, 9.0, "current"), (1, 0, 9.0, "current"),
                    (0, 1, 1.0, "historic"), (1, 1, 9.0, "current"), (0, 2, 9.0, "current"), (1, 2, 9.0, "current")])
    assert [(r["time"], r[T]) for r in ask(obs, catalogue).collect()] == [(hours(0), 1.0), (hours(2), 9.0)]


def test_all_variables_are_needed_and_repeats_are_ignored(make_obs, make_catalogue):
    catalogue = make_catalogue([(-45.5, 170)])
    obs = make_obs([(0, 0, 1.0), (0, 1, 2.0), (0, 1, 50.0, "historic", H)])
    out = ask(obs, catalogue, [T, H, T])
    assert out.columns == ["time", T, H] and out.count() == 1


def test_range_is_inclusive(make_obs, make_catalogue):
    obs = make_obs([(0, h, 1.0) for h in range(48)])
    out = ask(obs, make_catalogue([(-45.5, 170)]), start="2024-01-01", end="2024-01-01 23:00:00")
    assert out.count() == 24


def test_start_after_end_is_empty(make_obs, make_catalogue):
    out = ask(make_obs([(0, 0, 1.0)]), make_catalogue([(-45.5, 170)]), start="2024-02-01", end="2024-01-01")
    assert out.isEmpty()


def test_routing(spark, hours, make_obs):
    obs = make_obs([(0, 0, 1.0), (0, 10, 1.0), (0, 20, 1.0, "current"), (0, 30, 1.0, "current")])
    rows = [(1, "nasapower", hours(5), hours(8)), (2, "nasapower", hours(5), hours(25)),
            (3, "nasapower", hours(15), hours(25)), (4, "nasapower", hours(21), hours(25)), (5, "era5", hours(0), hours(1))]
    requests = spark.createDataFrame(rows, "req_id int, source string, start_time timestamp_ntz, end_time timestamp_ntz")
    routed = series.route_tiers(requests, series.tier_bounds(obs)).orderBy("req_id").collect()
    assert [(r["read_historic"], r["read_current"]) for r in routed] == [
        (True, False), (True, True), (False, False), (False, True), (False, False)]


def test_union_priority_keeps_first(make_obs):
    first, second = make_obs([(0, 0, None), (0, 1, 2.0)]), make_obs([(0, 0, 5.0), (0, 2, 6.0)])
    merged = series.union_priority(first, second, ["source", "tier", "var", "loc_id", "time"])
    assert [r["value"] for r in merged.orderBy("time").collect()] == [None, 2.0, 6.0]


def test_unpivot_after_pivot_is_the_identity(make_obs):
    obs = make_obs([(loc, h, float(loc + h), "historic", v) for loc in range(3) for h in range(5) for v in (T, H)])
    wide = shape.series_to_wide(obs, ["loc_id", "time"], [T, H])
    back = shape.wide_to_long(wide, ["loc_id", "time"])
    want = obs.select("loc_id", "time", "var", "value")
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


NEAR = "req_id int, source string, lat double, lon double, loc_id int, weight double"


def test_interpolated_rows_are_not_shuffled(spark, make_obs):
    near = spark.createDataFrame([(i, "nasapower", -45.0, 170.0, loc, 0.5) for i in range(20) for loc in (0, 1)], NEAR)
    out = series.interpolate(make_obs([(loc, h, 1.0) for loc in (0, 1) for h in range(5)]), near)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan.split("Join")[0]
    assert out.count() == 100


@pytest.mark.parametrize("block", [None, 3])
def test_interpolated_rows_equal_a_loop_with_odd_rows(spark, hours, block):
    rng = random.Random(8)
    names = ("nasapower", "era5")
    # nulls, repeated rows, missing rows, times 40 days apart
    obs = [(rng.choice(names), rng.choice(["historic", "current", None]), rng.choice([T, H, None]), rng.choice([*range(12), None]),
            rng.choice([hours(0), hours(1), hours(960), None]), rng.choice([None, rng.uniform(0, 30), rng.uniform(0, 30)])) for _ in range(900)]
    near = []
    for i in range(60):
        lat, lon = rng.uniform(-46, -44), rng.uniform(169, 171)
        locs = [rng.choice([*range(14), None]) if rng.random() < 0.1 else x for x in rng.sample(range(12), rng.randrange(1, 5))]
        # ids that come twice, at two places or in two sources; one is null
        near += [(None if i == 50 else i % 55, rng.choice(names) if i % 7 == 0 else names[0], lat, lon, loc,
                  None if rng.random() < 0.1 else rng.random()) for loc in locs]
    schema = "source string, tier string, var string, loc_id int, time timestamp_ntz, value double"
    got = series.interpolate(spark.createDataFrame(obs, schema), spark.createDataFrame(near, NEAR), *([block] if block else []))

    hits = {}
    for req_id, source, _, _, loc_id, weight in near:
        for o in obs:
            if req_id is not None and loc_id is not None and o[0] == source and o[3] == loc_id:
                hits.setdefault((req_id, o[1], o[2], o[4]), []).append((o[5], weight))
    k = {r: sum(n[0] == r for n in near) for r in range(55)}
    want = {}
    for key, pairs in hits.items():
        if len(pairs) == k[key[0]]:
            products = [v * w for v, w in pairs if v is not None and w is not None]
            want[key] = sum(products) if products and all(v is not None for v, _ in pairs) else None
    assert any(v is None for v in want.values()) and any(len(hits[x]) > 1 and want[x] is not None for x in want)
    rows = got.collect()
    assert len(rows) == len(want)
    close({(r["req_id"], r["tier"], r["var"], r["time"]): r["value"] for r in rows}, want)


def test_interpolation_without_requests_is_empty(spark, make_obs):
    out = series.interpolate(make_obs([(0, 0, 1.0)]), spark.createDataFrame([], NEAR))
    assert out.isEmpty() and out.columns == ["req_id", "tier", "var", "time", "value"]


@pytest.fixture(scope="module")
def world(spark, make_obs, make_catalogue):
    rng = random.Random(5)
    points = [(rng.uniform(-46, -44), rng.uniform(169, 171)) for _ in range(25)]
    rows = []
    for loc in range(25):
        for h in range(60):
            for v in (T, H):
                if rng.random() < 0.05:
                    continue
                value = -999.0 if rng.random() < 0.05 else (None if rng.random() < 0.02 else rng.uniform(0, 30))
                if h < 40:
                    rows.append((loc, h, value, "historic", v))
                if h >= 30:
                    rows.append((loc, h, value if value in (None, -999.0) else value + 1, "current", v))
    asked = []
    for i in range(40):
        # a third of the requests sit at one spot
        lat, lon = (-45.01, 170.01) if i % 3 == 0 else (rng.uniform(-46.5, -43.5), rng.uniform(168.5, 171.5))
        start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(50))
        asked.append((i, "nasapower", lat, lon, rng.choice([[T], [H], [T, H]]), start,
                      start + dt.timedelta(hours=rng.randrange(-2, 30)), rng.choice(["idw", "snap"])))
    schema = ("req_id int, source string, lat double, lon double, vars array<string>, "
              "start_time timestamp_ntz, end_time timestamp_ntz, mode string")
    return make_obs(rows).cache(), make_catalogue(points).cache(), spark.createDataFrame(asked, schema), asked


def one_by_one(obs, catalogue, asked):
    """What a loop over single-point queries gives."""
    want = {}
    for req_id, source, lat, lon, variables, start, end, mode in asked:
        for row in point.point_series(obs, catalogue, source, lat, lon, variables, start, end, mode).collect():
            for v in variables:
                want[req_id, row["time"], v] = row[v]
    return want


def close(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (value if value is None else pytest.approx(value)), key


@pytest.mark.parametrize("limit", [20_000, 3])
def test_batch_equals_single_queries(world, limit):
    obs, catalogue, requests, asked = world
    got = {(r["req_id"], r["time"], r["var"]): r["value"]
           for r in batch.extract_series(requests, obs, catalogue, group_limit=limit).collect()}
    assert len(got) > 300
    close(got, one_by_one(obs, catalogue, asked))


def test_crowded_stencils_are_split(world):
    _, catalogue, requests, _ = world
    salted = batch.with_salt(batch.with_stencils(requests, catalogue), 3)
    assert salted.select("salt").distinct().count() > 1
    assert salted.count() == batch.with_stencils(requests, catalogue).count()


def test_batch_values_lie_between_their_neighbours(world):
    obs, catalogue, requests, _ = world
    low, high = obs.filter("value <> -999").agg(F.min("value"), F.max("value")).first()
    outside = batch.extract_series(requests, obs, catalogue).filter(~F.col("value").between(low, high))
    assert outside.isEmpty()


def test_batch_without_requests_is_empty(world):
    obs, catalogue, requests, _ = world
    assert batch.extract_points(requests.limit(0), obs, catalogue).isEmpty()
    assert batch.extract_series(requests.limit(0), obs, catalogue).columns == ["req_id", "time", "var", "value"]


def test_stored_tables_give_the_same(spark, world, tmp_path):
    from gridseries.sinks.writers import write_obs
    obs, catalogue, requests, asked = world
    path = str(tmp_path / "obs")
    write_obs(obs, path)
    columns = ["req_id", "time", T, H]
    got = batch.extract_stored(spark, path, requests, catalogue).select(columns)
    want = batch.extract_points(requests, obs, catalogue, [T, H]).select(columns)
    assert got.count() == want.count() and got.select("req_id", "time").exceptAll(want.select("req_id", "time")).isEmpty()
    one = point.point_stored(spark, path, catalogue, "nasapower", -45.01, 170.01, [T], "2024-01-01", "2024-01-02")
    here = point.point_series(obs, catalogue, "nasapower", -45.01, 170.01, [T], "2024-01-01", "2024-01-02")
    assert one.collect() == here.collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: ")[1].split("]")[0]
    plan = batch.extract_stored(spark, path, requests, catalogue)._jdf.queryExecution().executedPlan().toString()
    scans = [x.split("]")[0] for x in plan.split("PushedFilters: ")[1:]]
    assert scans and all("loc_id" in x for x in scans), plan


def test_repeated_request_ids_are_refused(world):
    obs, catalogue, requests, _ = world
    with pytest.raises(ValueError):
        batch.extract_points(requests.unionByName(requests.limit(1)), obs, catalogue)


def test_replacing_rows_shuffles_before_it_groups(make_obs):
    keys = ["source", "tier", "var", "loc_id", "time"]
    merged = series.union_priority(make_obs([(0, 0, 1.0)]), make_obs([(0, 0, 2.0), (0, 1, 3.0)]), keys, ["loc_id", "time"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_min_by") < plan.index("Exchange")
    assert sorted(r["value"] for r in merged.collect()) == [1.0, 3.0]
