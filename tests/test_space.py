import math
import random

import pytest
from pyspark.sql import functions as F

from gridseries.functions import values
from gridseries.operators import space


def brute_force(requests, points, k=4, radius=1.0):
    want = set()
    for req_id, lat, lon in requests:
        near = sorted((math.sqrt((lat - a) ** 2 + (lon - b) ** 2), i) for i, (a, b) in enumerate(points))
        near = [x for x in near if x[0] < radius][:k]
        want |= {(req_id, i, rank + 1) for rank, (_, i) in enumerate(near)}
    return want


@pytest.fixture(scope="module")
def crowded():
    """A third of all locations in one spot, exact copies among them."""
    rng = random.Random(11)
    points = [(rng.uniform(-47, -42), rng.uniform(168, 173)) for _ in range(300)]
    points += [(-44.5 + rng.uniform(0, 0.02), 170.5 + rng.uniform(0, 0.02)) for _ in range(130)]
    points += [(-44.49, 170.49)] * 20
    requests = [(i, rng.uniform(-47.5, -41.5), rng.uniform(167.5, 173.5)) for i in range(80)]
    requests += [(100 + i, -44.5 + rng.uniform(-0.01, 0.03), 170.5 + rng.uniform(-0.01, 0.03)) for i in range(40)]
    return requests, points


def as_frame(spark, requests):
    rows = [(i, "nasapower", lat, lon) for i, lat, lon in requests]
    return spark.createDataFrame(rows, "req_id int, source string, lat double, lon double")


@pytest.mark.parametrize("levels,target", [(None, space.CELL_TARGET), (0, 1), (1, 1), (4, 4), (None, 4)])
def test_knn_is_brute_force_at_any_level(spark, make_catalogue, crowded, levels, target):
    requests, points = crowded
    found = space.knn(as_frame(spark, requests), make_catalogue(points), levels=levels, target=target)
    got = {(r["req_id"], r["loc_id"], r["rank"]) for r in found.collect()}
    assert got == brute_force(requests, points)


def test_crowded_catalogue_is_descended(crowded, make_catalogue):
    points = make_catalogue(crowded[1])
    # 130 locations within 0.02 degrees need cells below that size
    assert space.levels_needed(points) in (3, 4)
    assert space.levels_needed(points.limit(60)) == 0


def test_cells_are_deep_only_where_the_catalogue_is_dense(crowded, make_catalogue):
    catalogue = make_catalogue(crowded[1])
    levels = space.levels_needed(catalogue, target=8)
    points = space._points(catalogue, 4)
    leaves = [r for r in space.cell_tree(points, levels, target=8).collect() if not r["split"]]
    # no leaf is crowded, every point is in one, and depths differ
    assert max(r["n"] for r in leaves) <= 8 and sum(r["n"] for r in leaves) == points.count()
    assert min(r["level"] for r in leaves) <= 1 and max(r["level"] for r in leaves) == levels >= 4
    assert len(leaves) < 300


def test_knn_respects_sources_and_radius(spark, make_catalogue):
    other = make_catalogue([(-45, 170)], source="era5")
    mine = make_catalogue([(-45, 171.0), (-45, 170.5)])
    found = space.knn(as_frame(spark, [(1, -45.0, 170.0)]), mine.unionByName(other))
    # a distance of exactly 1 degree is outside
    assert [(r["loc_id"], r["source"]) for r in found.collect()] == [(1, "nasapower")]


def test_k_may_differ_per_request(spark, make_catalogue):
    asked = as_frame(spark, [(1, -45.0, 170.0), (2, -45.0, 170.0)]).withColumn(
        "k", F.when(F.col("req_id") == 1, 1).otherwise(4))
    found = space.knn(asked, make_catalogue([(-45.1, 170), (-45.2, 170), (-45.3, 170)]))
    assert sorted(r["req_id"] for r in found.collect()) == [1, 2, 2, 2]


def test_non_finite_requests_have_no_neighbours(spark, make_catalogue):
    asked = as_frame(spark, [(1, float("nan"), 170.0), (2, float("inf"), 170.0)])
    assert space.knn(asked, make_catalogue([(-45, 170)])).isEmpty()


def test_weights_sum_to_one(spark, make_catalogue, crowded):
    requests, points = crowded
    weighted = space.idw_weights(space.knn(as_frame(spark, requests), make_catalogue(points)))
    for row in weighted.groupBy("req_id").agg(F.sum("weight").alias("w")).collect():
        assert row["w"] == pytest.approx(1.0)


def test_request_on_a_location_takes_it_alone(spark, make_catalogue):
    found = space.idw_weights(space.knn(as_frame(spark, [(1, -45.0, 170.0)]),
                                        make_catalogue([(-45.1, 170), (-45.0, 170.0)])))
    assert [(r["loc_id"], r["weight"]) for r in found.collect()] == [(1, 1.0)]


def test_locate_cells_absorbs_float32_noise(spark, make_catalogue):
    grid = spark.createDataFrame([("nasapower", 166.63999938964844, -45.7400016784668, 1.0),
                                  ("nasapower", 150.0, -45.74, 2.0)],
                                 "source string, longitude double, latitude double, value double")
    located = space.locate_cells(grid, make_catalogue([(-45.74, 166.64)]))
    assert [(r["loc_id"], r["value"]) for r in located.collect()] == [(0, 1.0)]


def test_extend_keeps_old_ids_and_orders_new_ones(spark, make_catalogue):
    old = make_catalogue([(-41.0, 175.0), (-40.0, 175.0)])
    seen = spark.createDataFrame([(-40.0, 175.0), (-45.0, 170.0), (-46.0, 169.0), (-45.0, 169.0), (-46.0, 169.0)],
                                 "latitude double, longitude double")
    got = {(r["loc_id"], r["latitude"], r["longitude"]) for r in space.extend_catalogue(old, seen).collect()}
    assert got == {(0, -41.0, 175.0), (1, -40.0, 175.0), (2, -46.0, 169.0), (3, -45.0, 169.0), (4, -45.0, 170.0)}


def test_extend_numbers_many_rows_without_gaps(spark, make_catalogue):
    seen = spark.range(5000).selectExpr("cast(-40 - (id * 37 % 5000) / 1000 as double) as latitude",
                                        "cast(170 as double) as longitude")
    grown = space.extend_catalogue(make_catalogue([(-30, 170)]), seen)
    assert space.check_dense_ids(grown).isEmpty()
    first = grown.filter("loc_id = 1").first()
    assert first["latitude"] == grown.agg(F.min("latitude")).first()[0]


@pytest.mark.parametrize("ids,want", [
    ([0, 1, 2], set()),
    ([0, 2, 3], {(2, 1), (3, 2)}),
    ([0, 0, 1], {(0, 1), (1, 2)}),
    ([5], {(5, 0)}),
    ([0, 70000, 140000], {(70000, 1), (140000, 2)}),
])
def test_dense_ids(spark, ids, want):
    frame = spark.createDataFrame([(i,) for i in ids], "loc_id int")
    assert {(r["loc_id"], r["position"]) for r in space.check_dense_ids(frame).collect()} == want


def test_curve_place_takes_bits_in_turn(spark):
    points = [(-45.0, 170.0), (-45.0, 170.0000005), (-44.9, 170.0), (0.0, 0.0), (-90.0, -180.0), (95.0, 200.0)]
    got = spark.createDataFrame(points, "lat double, lon double").select(
        "lat", "lon", values.curve_place(F.col("lat"), F.col("lon")).alias("n")).collect()

    def number(lat, lon):
        y, x = (min((most << 22) - 1, max(0, math.floor(v * 2 ** 22))) for v, most in ((lat + 90, 180), (lon + 180, 360)))
        return sum((y >> i & 1) << 2 * i + 1 | (x >> i & 1) << 2 * i for i in range(31))

    assert [r["n"] for r in got] == [number(r["lat"], r["lon"]) for r in got]
    assert len({r["n"] for r in got}) == len(points)
