import math

from pyspark.sql import functions as F

from gridseries.operators import quality
from gridseries.plans.ingest import clean_point

S = -999.0


def series_of(df):
    return [(r["time"], r["value"]) for r in df.orderBy("time").collect()]


def test_sentinel_filter_keeps_null_and_nan(make_obs):
    left = quality.drop_sentinel(make_obs([(0, 0, S), (0, 1, None), (0, 2, math.nan), (0, 3, 1.0)]))
    assert left.count() == 3


def test_trim_counts_null_as_seen(make_obs, hours):
    obs = make_obs([(0, 0, 1.0), (0, 1, S), (0, 2, None), (0, 3, S), (0, 4, S)])
    assert series_of(quality.trim_trailing(obs)) == [(hours(0), 1.0), (hours(1), S), (hours(2), None)]


def test_trim_drops_a_series_of_sentinels(make_obs):
    assert quality.trim_trailing(make_obs([(0, 0, S), (0, 1, S)])).isEmpty()


def test_trim_sees_the_whole_series_across_months(make_obs):
    obs = make_obs([(0, 0, S), (0, 24 * 40, 5.0), (0, 24 * 80, S)])
    assert quality.trim_trailing(obs).count() == 2


def test_fill_takes_previous_value_at_the_same_hour(make_obs, hours):
    obs = make_obs([(0, 1, 10.0), (0, 2, 20.0), (0, 25, S), (0, 26, 21.0), (0, 49, 30.0)])
    filled = dict(series_of(quality.fill_by_hour(obs)))
    assert filled[hours(25)] == 10.0


def test_fill_falls_back_to_the_next_value(make_obs, hours):
    obs = make_obs([(0, 1, S), (0, 25, S), (0, 49, 7.0), (0, 73, 8.0)])
    filled = dict(series_of(quality.fill_by_hour(obs)))
    assert (filled[hours(1)], filled[hours(25)]) == (7.0, 7.0)


def test_fill_crosses_quarters(make_obs, hours):
    long = 24 * 400
    obs = make_obs([(0, 0, 3.0), (0, long, S), (0, 5, S), (0, long + 5, 9.0)])
    filled = dict(series_of(quality.fill_by_hour(obs)))
    assert filled[hours(long)] == 3.0 and filled[hours(5)] == 9.0


def test_hour_without_any_value_becomes_null(make_obs, hours):
    obs = make_obs([(0, 1, S), (0, 2, 5.0), (0, 26, 6.0)])
    cleaned = dict(series_of(clean_point(obs)))
    assert hours(1) in cleaned and cleaned[hours(1)] is None


def test_nulls_are_filled_only_beside_a_sentinel(make_obs, hours):
    with_gap = make_obs([(0, 1, 1.0), (0, 25, None), (0, 26, S), (0, 27, 4.0)])
    without = make_obs([(0, 1, 1.0), (0, 25, None), (0, 27, 4.0)])
    assert dict(series_of(quality.fill_by_hour(with_gap)))[hours(25)] == 1.0
    assert dict(series_of(quality.fill_by_hour(without)))[hours(25)] is None


def test_trailing_sentinels_do_not_make_a_series_gappy(make_obs, hours):
    obs = make_obs([(0, 1, 1.0), (0, 25, None), (0, 30, S)])
    assert series_of(clean_point(obs)) == [(hours(1), 1.0), (hours(25), None)]


def test_nan_is_treated_as_null(make_obs, hours):
    obs = make_obs([(0, 1, 1.0), (0, 25, math.nan), (0, 26, S), (0, 27, 4.0)])
    assert dict(series_of(quality.fill_by_hour(obs)))[hours(25)] == 1.0


def test_one_series_holding_most_rows(make_obs, spark):
    """Brute force over a long series beside many short ones."""
    import random
    rng = random.Random(3)
    rows = [(0, h, S if rng.random() < 0.2 else float(h)) for h in range(24 * 200)]
    rows += [(loc, h, S if rng.random() < 0.3 else float(h)) for loc in range(1, 20) for h in range(48)]
    got = {(r["loc_id"], r["time"]): r["value"] for r in clean_point(make_obs(rows)).collect()}

    import datetime as dt
    base, want, by_loc = dt.datetime(2024, 1, 1), {}, {}
    for loc, h, v in rows:
        by_loc.setdefault(loc, []).append((h, v))
    for loc, points in by_loc.items():
        last = max((h for h, v in points if v != S), default=-1)
        points = [(h, v) for h, v in points if h <= last]
        for h, v in points:
            if v == S:
                same = [(g, w) for g, w in points if g % 24 == h % 24 and w != S]
                before = [w for g, w in same if g < h]
                v = before[-1] if before else (same[0][1] if same else None)
            want[loc, base + dt.timedelta(hours=h)] = v
    assert got == want


def test_filling_shuffles_rows_once(spark, make_obs, tmp_path):
    make_obs([(0, h, S if h % 5 == 0 else float(h)) for h in range(96)]).drop("source").write.parquet(str(tmp_path / "obs"))
    filled = quality.fill_by_hour(spark.read.parquet(str(tmp_path / "obs")).selectExpr("'nasapower' as source", "var", "loc_id", "time", "value"))
    assert len(filled.collect()) == 96
    assert "ReusedExchange" in filled._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_not_filled(make_obs, hours):
    obs = make_obs([(0, 1, 1.0), (0, 25, S), (None, 1, S), (None, 2, 3.0)])
    assert series_of(quality.fill_by_hour(obs)) == [(hours(1), 1.0), (hours(25), 1.0)]


def test_statistics_have_one_row_for_each_series(make_obs):
    obs = make_obs([(loc, 24 * day, float(day)) for loc in range(3) for day in range(200)] + [(0, 24 * 300, S)])
    plan = quality.trim_trailing(obs)._jdf.queryExecution().optimizedPlan().toString()
    assert "_month" not in plan
    assert quality.series_stats(obs, {"n": F.count("*")}).count() == 3


def test_unique_violations(make_obs):
    found = quality.unique_violations(make_obs([(0, 0, 1.0), (0, 0, 2.0), (0, 1, 1.0)])).collect()
    assert [r["n"] for r in found] == [2]


def test_coverage_lists_locations_without_data(make_obs, make_catalogue):
    cover = quality.coverage(make_obs([(0, 0, 1.0)]), make_catalogue([(-45, 170), (-44, 170)]), ["temperature_2m"])
    assert {(r["loc_id"], r["n"]) for r in cover.collect()} == {(0, 1), (1, 0)}


def test_series_mismatch_names_the_side(make_obs):
    found = quality.series_mismatch(make_obs([(0, 0, 1.0), (1, 0, 1.0)]), make_obs([(0, 0, 1.0), (2, 0, 1.0)]))
    assert {(r["loc_id"], r["only_in"]) for r in found.collect()} == {(1, "current"), (2, "historic")}
