import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import negatives as op

SCHEMA = "vec_id long, embedding array<double>, label int, score double"


def brute_force(rows, positives=5, negatives=10):
    sound = {}
    for i, v, label, _ in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            sound[i] = min((v, label), sound.get(i, (v, label)))
    whole = {i: ([math.floor(256 * x) for x in v], label) for i, (v, label) in sound.items()}
    out = set()
    for a, (own, label) in whole.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, kind) for i, (v, kind) in whole.items() if i != a and len(v) == len(own))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out |= {(a, i, rank + 1, j, -p, -n) for rank, (n, j, _) in enumerate(fits[:negatives])}
    return out


def made(n=400, dimension=9, seed=2, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dimension))
    # a third of all rows has one label
    return [(i, (scale * (centres[i % 4] + 0.6 * rng.normal(size=dimension))).tolist(), 7 if i % 3 == 0 else i % 5, 0.0) for i in range(n)]


def mined(spark, rows, **given):
    found = op.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0, **given)
    return {tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


def test_small_blocks_give_the_same_as_brute_force(spark):
    rows = made()
    want = brute_force(rows)
    assert len(want) > 500
    assert mined(spark, rows) == want
    assert mined(spark, rows, anchor_rows=7, stripe_rows=50) == want


def test_ties_repeats_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(90, 3) + [(1000 + i, [0.5, 0.5, 0.5], i % 2, 0.0) for i in range(60)]
    rows += [(1000, [9.0, 9.0, 9.0], 1, 0.0), (10, rows[10][1], 9, 0.0), *rows[:20]]
    rows += [(None, [1.0, 1.0, 1.0], 1, 0.0), (2000, None, 1, 0.0), (2010, [1.0, 1.0, 1.0], None, 0.0), (2020, [1.0, None, 1.0], 1, 0.0),
             (2030, [nan, 1.0, 1.0], 1, 0.0), (2040, [inf, 1.0, 1.0], 1, 0.0), (3000, [], 1, 0.0), (3001, [], 1, 0.0), (3002, [], 2, 0.0),
             (4000, [1.0, 2.0], 1, 0.0), (4001, [1.0, 2.0], 1, 0.0), (4002, [0.5, 0.9], 2, 0.0), (-10, [1.0, 2.0], 2, 0.0)]
    want = brute_force(rows)
    assert {r[0] for r in want} >= {3000, 4000, 1000}
    assert mined(spark, rows) == want


def test_empty_tables_and_refused_scores(spark):
    rows = made(30)
    assert op.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).isEmpty()
    assert op.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") > 1000).isEmpty()
    with pytest.raises(ValueError, match="do not fit"):
        op.hard_negatives(spark.createDataFrame([(0, [1e200], 0, 0.0)], SCHEMA), F.col("vec_id") == 0)


def test_large_components_need_more_primes(spark):
    rows = made(120, 5, scale=1e5)
    want = brute_force(rows)
    assert max(r[4] for r in want) > 1 << 45
    assert mined(spark, rows) == want


@pytest.mark.parametrize("most,dimension", [(1, 1), (300, 64), (10 ** 6, 3000), (2 ** 26, 130)])
def test_products_are_exact(most, dimension):
    rng = np.random.default_rng(dimension)
    left, right = rng.integers(-most, most + 1, (7, dimension)), rng.integers(-most, most + 1, (9, dimension))
    left[0], right[0], right[1] = most, most, -most
    exact = left.astype(object) @ right.T.astype(object)
    primes = op.primes_for(most * most * dimension)
    assert math.prod(primes) > 2 * most * most * dimension
    got = op.products(op.residues(left.astype(float), primes), op.residues(right.astype(float), primes), primes)
    assert (got == exact).all()
