"""Hard negatives: rows of another label whose exact integer score lies in a window below a positive's.

Components are made whole, floor(256 x). Inner products of whole vectors are computed in a residue number
system: for each of several primes below 256 the components are reduced to balanced residues, which are
multiplied as float32 matrices. A sum of at most `CHUNK` products of residues stays under 2^24, so it is
exact. The digits of the score in the mixed radix of the primes follow from the residues by Chinese
remaindering; as many primes are taken as the largest possible score needs, by the Cauchy-Schwarz bound
over the whole table.

Two passes. The first meets anchors with the rows of their label and keeps each anchor's best positives;
the second meets anchors with all rows and keeps, for every positive, the best rows of other labels inside
its window. Anchors form groups of about `ANCHOR_ROWS`, rows form stripes of at most about `STRIPE_ROWS`;
a task takes one group and one stripe, anchors first, streams the rows past them and holds only the best
of each window. The best of the stripes are ranked by a window function. A hot label is just more stripes.

Defined cases: rows with a null vec_id, label or vector, or with any null or non-finite component, take no
part; of rows that repeat a vec_id the least (vector, label) counts; vectors of different length never meet;
vectors without components score 0; equal scores go to the smaller vec_id; an anchor without positives and a
positive without rows in its window give no rows; scores beyond 2^62 are refused with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.llm.grouped import beside, key_runs
from gridseries.llm.tables import stored

SCALE = 256
CHUNK = 1024
ANCHOR_ROWS = 16_384
STRIPE_ROWS = 1 << 18
LEAST_STRIPE = 8192
TILE = 1024
NOTHING = -(1 << 63) + 1
NO_ID = (1 << 63) - 1


def primes_for(bound: int) -> list[int]:
    """The largest primes below 256 whose product exceeds twice the bound."""
    found, product = [], 1
    for n in range(255, 1, -1):
        if product > 2 * bound + 1 and found:
            return found
        if all(n % q for q in range(2, math.isqrt(n) + 1)):
            found.append(n)
            product *= n
    return found


def balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """The residues between -prime/2 and prime/2."""
    return values - prime * np.rint(values / values.dtype.type(prime))


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64))


def residues(integers: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    large = bool(len(integers)) and integers.size and np.abs(integers).max() >= 2.0 ** 50
    return [balanced(np.fmod(integers, p) if large else integers, p).astype(np.float32) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of left with all rows of right, from their residues."""
    digits: list[np.ndarray] = []
    for i, prime in enumerate(primes):
        digit = np.zeros((len(left[i]), len(right[i])), np.float32)
        for at in range(0, left[i].shape[1], CHUNK):
            part = left[i][:, at:at + CHUNK] @ right[i][:, at:at + CHUNK].T
            digit = balanced(digit + balanced(balanced(part, prime), prime), prime)
        for known, p in zip(digits, primes):
            digit = balanced((digit - known) * np.float32(pow(p, -1, prime)), prime)
        digits.append(digit)
    score = digits[-1].astype(np.int64)
    for digit, prime in zip(digits[-2::-1], primes[-2::-1]):
        score = score * prime + digit.astype(np.int64)
    return score


class Best:
    """For each anchor and each of its windows, the best rows seen: largest score, then smallest id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], low: np.ndarray, high: np.ndarray, most: int):
        self.ids, self.labels, self.vectors, self.low, self.high = ids, labels, vectors, low, high
        self.scores = np.full((*low.shape, most), NOTHING, np.int64)
        self.found = np.full((*low.shape, most), NO_ID, np.int64)
        self.step = 64

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], primes: list[int], same_label: bool) -> None:
        first = 0
        while first < len(ids):
            rows = slice(first, first + self.step)
            first, self.step = first + self.step, min(TILE, 2 * self.step)
            for at in range(0, len(self.ids), TILE):
                some = slice(at, at + TILE)
                score = products([v[some] for v in self.vectors], [v[rows] for v in vectors], primes)
                fits = self.labels[some, None] == labels[rows]
                fits = fits & (self.ids[some, None] != ids[rows]) if same_label else ~fits
                for window in range(self.low.shape[1]):
                    least = np.maximum(self.low[some, window], self.scores[some, window, -1])
                    at_anchor, at_row = np.nonzero(fits & (score >= least[:, None]) & (score <= self.high[some, window, None]))
                    if len(at_anchor):
                        self._merge(at + at_anchor, window, score[at_anchor, at_row], ids[rows][at_row])

    def _merge(self, anchors: np.ndarray, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, most = np.unique(anchors), self.scores.shape[2]
        owner = np.concatenate([np.repeat(touched, most), anchors])
        scores = np.concatenate([self.scores[touched, window].ravel(), scores])
        ids = np.concatenate([self.found[touched, window].ravel(), ids])
        order = np.lexsort((ids, -scores, owner))
        starts = np.searchsorted(owner[order], touched)
        kept = order[starts[:, None] + np.arange(most)]
        self.scores[touched, window], self.found[touched, window] = scores[kept], ids[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, window, score and id of everything found."""
        anchor, window, place = np.nonzero(self.found != NO_ID)
        return anchor, window, self.scores[anchor, window, place], self.found[anchor, window, place]


def _matrix(part: pa.RecordBatch, dimension: int) -> np.ndarray:
    flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
    return whole(flat.reshape(part.num_rows, dimension))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector, dimension of the rows that take part, one for each vec_id."""
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    vector = F.col("embedding") if kind == "float" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    return rows.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("dimension"))


def _searched(dealt: DataFrame, keys: list[str], primes: list[int], most: int, same_label: bool, low: int, high: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, vec_id, score: the best of each stripe."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, best = None, [], None

        def gathered() -> Best:
            ids, labels = (np.concatenate([p.column(c).to_numpy() for p in asked]) for c in ("vec_id", "label"))
            vectors = np.concatenate([_matrix(p, now[0]) for p in asked])
            if same_label:
                bottom, top = np.full((len(ids), 1), NOTHING, np.int64), np.full((len(ids), 1), NO_ID, np.int64)
            else:
                held = [s for p in asked for s in p.column("positive_scores").to_pylist()]
                width = max(map(len, held))
                bottom, top = np.ones((len(ids), width), np.int64), np.zeros((len(ids), width), np.int64)
                for i, scores in enumerate(held):
                    bottom[i, :len(scores)] = [-(-low * s // 100) for s in scores]
                    top[i, :len(scores)] = [high * s // 100 for s in scores]
            return Best(ids, labels, residues(vectors, primes), bottom, top, most)

        def out() -> Iterator[pa.RecordBatch]:
            anchor, window, score, found = best.rows()
            if same_label:
                positive = positive_score = pa.nulls(len(anchor), pa.int64())
            else:
                positives = [list(zip(*x)) for p in asked for x in zip(p.column("positive_ids").to_pylist(), p.column("positive_scores").to_pylist())]
                pairs = [positives[a][w] for a, w in zip(anchor.tolist(), window.tolist())]
                positive, positive_score = (pa.array([x[c] for x in pairs], pa.int64()) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(best.ids[anchor]), positive, positive_score, pa.array(found), pa.array(score)],
                                             ["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

        for key, part in key_runs(batches, [*keys, "kind"]):
            if key[:-1] != now:
                if best:
                    yield from out()
                now, asked, best = key[:-1], [], None
            if key[-1] == 0:
                asked.append(part)
                continue
            best = best or gathered()
            ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
            for at in range(0, len(ids), 8 * TILE):
                some = slice(at, at + 8 * TILE)
                best.add(ids[some], labels[some], residues(_matrix(part.slice(at, 8 * TILE), now[0]), primes), primes, same_label)
        if best:
            yield from out()

    return dealt.mapInArrow(search, "anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def hard_negatives(vectors: DataFrame, anchors_where: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   anchor_rows: int = ANCHOR_ROWS, stripe_rows: int = STRIPE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors has vec_id, embedding and label (whole numbers); an anchor is a row where `anchors_where` holds.
    A negative's score lies between `low` and `high` hundredths of its positive's, both ends included.
    """
    rows = stored(usable(vectors), "mined")
    is_anchor = F.coalesce(anchors_where, F.lit(False))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.abs(x.cast("double")) * SCALE + 1, F.lit(2.0)))
    size = rows.agg(F.count("*").alias("n"), F.max(square).alias("longest"), F.max(F.when(is_anchor, square)).alias("asked")).first()
    bound = math.sqrt(size["longest"] or 0) * math.sqrt(size["asked"] or 0) * (1 + 1e-9) + 1
    if bound >= 2 ** 62:
        raise ValueError("the scores of these vectors do not fit a long")
    primes = primes_for(int(bound))
    anchors = rows.where(is_anchor)

    dealt = beside(anchors, rows, ["dimension", "label"], size["n"], anchor_rows, stripe_rows, LEAST_STRIPE)
    near = _searched(dealt, ["dimension", "label", "part", "stripe"], primes, positives, True, low, high)
    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= positives)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score"))).alias("near"))
    asked = stored(anchors.join(near, "vec_id").select("*", F.col("near.id").alias("positive_ids"), F.col("near.score").alias("positive_scores")).drop("near"), "anchors")

    dealt = beside(asked, rows, ["dimension"], size["n"], anchor_rows, stripe_rows, LEAST_STRIPE)
    far = _searched(dealt, ["dimension", "part", "stripe"], primes, negatives, False, low, high)
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
