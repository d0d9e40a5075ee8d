"""Largest inner products by low-dimensional stable projections and kd-trees.

With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0); then the
largest inner product is the smallest Euclidean distance. Vectors are projected to `PROJECTED` dimensions, or as
many as they have, by Gaussian (2-stable) directions made orthogonal, so that a squared projected distance is about
the true one times a chi-square variable, with the smaller spread that so many of the dimensions leave.

Rows are dealt to stripes, queries to groups; a task takes one group and one stripe and indexes the stripe shard by
shard, each by a kd-tree over its projections. Projected neighbours are verified on the original values in double
precision, nearest first, until the test holds: if the next one's projected distance exceeds the true distance of the
k-th best so far times the quantile for `CERTAINTY`, a better vector has been passed over with a chance of at most
1 - CERTAINTY. Leaves whose boxes lie beyond are not looked into. Nothing else ends a search, and the best so far is
carried from shard to shard.

Sums run over the components in order, so equal vectors have equal scores.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without vec_id; of rows that repeat a vec_id the least vector counts; vectors of different
length are never compared; ties go to the smaller vec_id; fewer candidates than k give as many rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridseries.llm.grouped import beside, key_runs
from gridseries.llm.tables import stored

NEAREST = 20
PROJECTED = 32
CERTAINTY = 0.84
SHARD_ROWS = 8192
LEAF_ROWS = 64
QUERY_ROWS = 16_384
STRIPE_ROWS = 1 << 18
LANES = 256
# a query's nearest projected neighbours of a shard are verified in rounds of growing size
ROUNDS = (64, 512)
NO_ID = (1 << 63) - 1


def chi_square_quantile(share: float, freedom: int) -> float:
    """For an even number of degrees of freedom, by bisection of the closed form."""
    def below(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


def projected_dimensions(dimension: int) -> int:
    """An even number, for the closed form above."""
    return min(PROJECTED, (dimension + 1) // 2 * 2)


def projection(dimension: int) -> np.ndarray:
    """Orthogonal directions, scaled so that each adds the squared distance on average."""
    chosen = np.random.default_rng(dimension).normal(size=(dimension + 1, projected_dimensions(dimension)))
    return np.linalg.qr(chosen)[0] * math.sqrt(dimension + 1)


def stopping_ratio(certainty: float, dimension: int) -> float:
    """The chi-square quantile, its spread less by the share of dimensions that the projection keeps."""
    m = projected_dimensions(dimension)
    return m + (chi_square_quantile(certainty, m) - m) * math.sqrt(1 - m / (dimension + 1))


class Queries:
    """Some queries of one dimension and the best found for them so far: largest score, then smallest id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, k: int):
        self.ids, self.vectors, self.longest = ids, vectors, longest
        self.points = np.column_stack([vectors, np.zeros(len(ids))]) @ projection(vectors.shape[1])
        self.base = (vectors ** 2).sum(axis=1) + longest ** 2
        self.scores, self.found = np.full((len(ids), k), -np.inf), np.full((len(ids), k), NO_ID)

    def distance(self, some: slice) -> np.ndarray:
        """Squared distance of the k-th best."""
        return np.maximum(self.base[some] - 2 * self.scores[some, -1], 0)

    def keep(self, lanes: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        better = (scores > self.scores[lanes, -1]) | ((scores == self.scores[lanes, -1]) & (ids < self.found[lanes, -1]))
        lanes, scores, ids = lanes[better], scores[better], ids[better]
        touched, k = np.unique(lanes), self.scores.shape[1]
        owner = np.concatenate([np.repeat(touched, k), lanes])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        ids = np.concatenate([self.found[touched].ravel(), ids])
        order = np.lexsort((ids, -scores, owner))
        kept = order[np.searchsorted(owner[order], touched)[:, None] + np.arange(k)]
        self.scores[touched], self.found[touched] = scores[kept], ids[kept]


class Tree:
    """A shard in the order of its leaves, their boxes in the projection, vectors by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float):
        rest = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        points = np.column_stack([vectors, rest]) @ projection(vectors.shape[1])
        leaves, open_ = [], [np.arange(len(ids))]
        while open_:
            rows = open_.pop()
            if len(rows) <= LEAF_ROWS:
                leaves.append(rows)
                continue
            own = points[rows]
            axis = np.argmax(own.max(axis=0) - own.min(axis=0))
            order = np.argpartition(own[:, axis], len(rows) // 2)
            open_ += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        self.low = np.array([points[rows].min(axis=0) for rows in leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in leaves])
        self.leaf = np.repeat(np.arange(len(leaves)), [len(rows) for rows in leaves])
        order = np.concatenate(leaves)
        self.ids, self.points = ids[order], points[order]
        self.components = np.ascontiguousarray(vectors[order].T)

    def search(self, queries: Queries, some: slice, ratio: float) -> int:
        """Improve the best of some queries; returns how many vectors were verified."""
        points, verified = queries.points[some], 0
        gap = np.maximum(0, np.maximum(self.low - points[:, None], points[:, None] - self.high))
        reached = (gap ** 2).sum(axis=2) <= ratio * queries.distance(some)[:, None]
        rows = np.flatnonzero(reached.any(axis=0)[self.leaf])
        if not len(rows):
            return 0
        near = self.points[rows]
        distance = (points ** 2).sum(axis=1)[:, None] + (near ** 2).sum(axis=1) - 2 * points @ near.T
        distance[queries.ids[some, None] == self.ids[rows]] = np.inf
        # rounding must not lose a leaf's rows
        distance = np.maximum(distance, 0)
        for size in (*ROUNDS, len(rows)):
            if size > len(rows):
                continue
            limit = np.partition(distance, size - 1, axis=1)[:, size - 1]
            lane, at = np.nonzero(distance <= np.minimum(limit, ratio * queries.distance(some))[:, None])
            lane, at = (x[np.isfinite(distance[lane, at])] for x in (lane, at))
            distance[lane, at] = np.inf
            own, place = lane + (some.start or 0), rows[at]
            sums = np.zeros(len(lane))
            for values, q in zip(self.components, queries.vectors.T):
                sums += values[place] * q[own]
            verified += len(lane)
            queries.keep(own, sums, self.ids[place])
        return verified


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles), dimension, squared norm of the rows that take part, one for each vec_id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select("vec_id", "vector", F.size("vector").alias("dimension"), norm.alias("norm")).where("norm > 0")


def nearest(vectors: DataFrame, queries_where, k: int = NEAREST, certainty: float = CERTAINTY, shard_rows: int = SHARD_ROWS,
            query_rows: int = QUERY_ROWS, stripe_rows: int = STRIPE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row where `queries_where` holds."""
    rows = stored(usable(vectors), "vectors")
    longest = rows.groupBy("dimension").agg(F.sqrt(F.max("norm")).alias("longest"))
    rows = rows.drop("norm")
    asked = rows.where(F.coalesce(queries_where, F.lit(False))).join(longest, "dimension")
    dealt = beside(asked, rows, ["dimension"], rows.count(), query_rows, stripe_rows, shard_rows)

    def matrix(parts: list[pa.RecordBatch], dimension: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([p.column("vec_id").to_numpy() for p in parts])
        flat = np.concatenate([p.column("vector").flatten().to_numpy() for p in parts])
        return ids, flat.reshape(len(ids), dimension)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, queries, held, size = None, [], None, [], 0

        def shard() -> None:
            tree, ratio = Tree(*matrix(held, now[0]), queries.longest), stopping_ratio(certainty, now[0])
            for at in range(0, len(queries.ids), LANES):
                tree.search(queries, slice(at, at + LANES), ratio)

        def out() -> Iterator[pa.RecordBatch]:
            lane, place = np.nonzero(queries.found != NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(queries.ids[lane]), pa.array(queries.found[lane, place]), pa.array(queries.scores[lane, place])],
                                             ["query_id", "vec_id", "score"])

        for key, part in key_runs(batches, ["dimension", "part", "stripe", "kind"]):
            if key[:-1] != now:
                if held:
                    shard()
                if queries:
                    yield from out()
                now, asked, queries, held, size = key[:-1], [], None, [], 0
            if key[-1] == 0:
                asked.append(part)
                continue
            queries = queries or Queries(*matrix(asked, now[0]), asked[0].column("longest")[0].as_py(), k)
            for at in range(0, part.num_rows, shard_rows):
                held.append(part.slice(at, shard_rows))
                size += held[-1].num_rows
                if size >= shard_rows:
                    shard()
                    held, size = [], 0
        if held:
            shard()
        if queries:
            yield from out()

    found = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
