import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import neighbours as op

GIVEN = Path("/root/testdata/sf0.1/embeddings.parquet")
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k=20):
    sound = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = tuple(float(np.float32(x)) for x in v)
            sound[i] = min(v, sound.get(i, v))
    out = set()
    for q, a in sound.items():
        if q % 20 == 0:
            near = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound.items() if i != q and len(a) == len(b))
            out |= {(q, rank + 1, i) for rank, (_, i) in enumerate(near[:k])}
    return out


def made(seed=0, n=700, dimension=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dimension))
    rows = [(i, (centres[i % 5] + rng.normal(size=dimension) * (0.2 if i % 2 else 2)).tolist(), 0) for i in range(n)]
    # one vector that many rows share
    rows += [(1000 + i, rows[40][1], 0) for i in range(60)]
    return rows


def test_nearly_all_neighbours_are_found(spark):
    rows = made()
    got = op.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=150).collect()
    want = brute_force(rows)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == len(want) and len(found & {(q, i) for q, _, i in want}) >= 0.95 * len(want)
    vectors = {i: [float(np.float32(x)) for x in v] for i, v, _ in rows}
    for r in got:
        assert r["score"] == pytest.approx(math.sumprod(vectors[r["query_id"]], vectors[r["vec_id"]]), rel=1e-12)
    for q in {r["query_id"] for r in got}:
        own = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [x[0] for x in own] == list(range(1, 21)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
        assert all(x[2] != q for x in own)


def test_full_certainty_is_exact(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(1, 160, 5) + [(2000, None, 0), (2020, [], 0), (2040, [0.0] * 5, 0), (2060, [1.0, None, 1.0, 1.0, 1.0], 0), (2080, [nan] * 5, 0),
                              (2100, [inf] * 5, 0), (None, [1.0] * 5, 0), (20, [9.0] * 5, 0), (3000, [1.0, 2.0], 0), (3001, [2.0, 1.0], 0),
                              (3020, [3.0], 0)]
    got = op.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, certainty=1 - 1e-12, shard_rows=64, query_rows=7, stripe_rows=90)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()} == brute_force(rows)


def test_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (20, [0.0, 1.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in op.nearest(frame, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 1), (0, 2, 2), (0, 3, 20), (20, 1, 0), (20, 2, 1), (20, 3, 2)}
    assert op.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).isEmpty()
    assert op.nearest(frame, F.col("vec_id") > 50).isEmpty()


def test_quantile():
    assert op.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    # all dimensions kept: projected distances are the true ones
    assert op.stopping_ratio(0.9, 5) == pytest.approx(6) and op.stopping_ratio(0.9, 10 ** 6) == pytest.approx(op.chi_square_quantile(0.9, 32), abs=0.01)


def verified_and_found(vectors, queries, k, shard):
    longest = float(np.sqrt((vectors ** 2).sum(axis=1).max()))
    asked = op.Queries(queries, vectors[queries], longest, k)
    verified = 0
    for at in range(0, len(vectors), shard):
        tree = op.Tree(np.arange(at, min(at + shard, len(vectors))), vectors[at:at + shard], longest)
        verified += sum(tree.search(asked, slice(i, i + op.LANES), op.stopping_ratio(op.CERTAINTY, vectors.shape[1])) for i in range(0, len(queries), op.LANES))
    exact = vectors[queries] @ vectors.T
    exact[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-exact, axis=1)[:, :k]
    return verified / len(queries) / len(vectors), np.mean([len(set(a) & set(b)) / k for a, b in zip(asked.found, want)])


def test_the_stopping_test_prunes():
    rng = np.random.default_rng(3)
    grouped = rng.normal(size=(4000, 48)) * 0.05 + np.eye(48)[rng.integers(0, 16, 4000)] * 5
    share, recall = verified_and_found(grouped, np.arange(0, 4000, 20), 5, 1000)
    assert share < 0.15 and recall >= 0.9
    # without any structure, the hardest case
    even = rng.normal(size=(10_000, 64))
    even /= np.sqrt((even ** 2).sum(axis=1))[:, None]
    share, recall = verified_and_found(even, np.arange(0, 10_000, 20), 20, 8192)
    assert share < 0.3 and recall >= 0.9


@pytest.mark.skipif(not GIVEN.exists(), reason="the generated tables are not here")
def test_given_vectors_are_found_without_reading_most(spark):
    rows = spark.read.parquet(str(GIVEN)).select("vec_id", "embedding").toPandas()
    vectors = np.stack(rows["embedding"]).astype(float)
    share, recall = verified_and_found(vectors, np.flatnonzero(rows["vec_id"] % 20 == 0), 20, op.SHARD_ROWS)
    print(f"verified {share:.3f} of all pairs, recall {recall:.3f}")
    assert share < 0.3 and recall >= 0.9
