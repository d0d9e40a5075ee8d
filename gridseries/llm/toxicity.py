"""Toxicity scores from a factorization machine over hashed terms.

Terms are lower-cased words and word beginnings (the first `STEM_BYTES` bytes of longer words),
hashed to `HASH_BITS` bits; a document is the set of its terms. The score is the logistic of bias,
linear weights and all pairwise interactions <v_i, v_j>, which are summed in linear time as
(|sum v|^2 - sum |v|^2) / 2. Weights are learned by stochastic gradients from at most `MOST_ROWS`
labelled rows, toxic and clean alike chosen by a hash. The model holds the terms that are in at least
`LEAST_ROWS` of them and that tell something, alone or together: a term whose share differs between the labels
beyond chance, and the terms of any pair whose rows are labelled otherwise than the two terms add up to (chi-square
tests; pairs of the `MOST_PAIRED` terms with the most rows). So the many words of a long text that say nothing
add nothing. Whole texts are read in training and scoring.

Defined cases: null and empty texts have no terms and get the bias alone; without labels of both
kinds every score is 0; labels that are null are not used; of several labels of one document the
largest counts; repeated rows are scored alike; extra columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.flat import LOWER, flatten, prefix_hash, slices, span_hash, word_spans

HASH_BITS = 22
STEM_BYTES = 4
RANK = 4
MOST_ROWS = 8_000
LEAST_ROWS = 8
CHI_SQUARE = 15.0
# half a million pairs are tested, so their test is stricter
PAIR_CHI_SQUARE = 30.0
MOST_PAIRED = 1024
THRESHOLD = 0.7
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) pairs, each once, ordered by row."""
    data, offsets = flatten(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTE)
    sums = prefix_hash(low)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    longer = ends - starts > STEM_BYTES
    keys = np.concatenate([span_hash(sums, starts, ends),
                           span_hash(sums, starts[longer], starts[longer] + STEM_BYTES) ^ np.uint64(0x5DEECE66D)])
    rows = np.concatenate([row, row[longer]])
    packed = np.unique((rows << HASH_BITS) | (keys & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64))
    return packed >> HASH_BITS, packed & ((1 << HASH_BITS) - 1)


@dataclass
class Machine:
    """Slot of each hashed term (0: not in the model), weights and factors by slot."""

    slot: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, n: int, rows: np.ndarray, slots: np.ndarray) -> np.ndarray:
        line = np.bincount(rows, self.linear[slots], n)
        crossed = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[slots, f].astype(np.float64)
            crossed += np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + line + 0.5 * crossed, -30, 30)))

    def of(self, column: pa.Array) -> np.ndarray:
        rows, keys = terms(column)
        slots = self.slot[keys]
        used = slots > 0
        return self.score(len(column), rows[used], slots[used])


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms in enough rows whose share differs between the labels, or that do in a pair."""
    size = 1 << HASH_BITS
    toxic = [r for r, y in zip(rows, labels) if y]
    clean = [r for r, y in zip(rows, labels) if not y]
    a, b = (np.bincount(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64), minlength=size) for x in (toxic, clean))
    n, both = len(rows), a + b
    often = np.flatnonzero(both >= LEAST_ROWS)
    a, both = a[often].astype(float), both[often].astype(float)
    expected = both * len(toxic) / n
    spread = expected * (len(clean) / n) * (1 - both / n)
    alone = often[(a - expected) ** 2 > CHI_SQUARE * np.maximum(spread, 1e-9)]
    return np.union1d(alone, telling_pairs(rows, labels, often[np.argsort(-both, kind="stable")[:MOST_PAIRED]]))


def telling_pairs(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Those of some terms that have a partner with which they tell more, or less, than the two add up to.

    Added up are the log odds of the terms over those of all rows, as a model without pairs would.
    """
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    met, toxic = np.zeros((2, len(terms), len(terms)))
    for first in range(0, len(rows), 1024):
        some = rows[first:first + 1024]
        held = np.zeros((len(some), len(terms)), np.float32)
        for line, keys in zip(held, some):
            own = place[keys]
            line[own[own >= 0]] = 1
        met += held.T @ held
        toxic += held.T @ (held * labels[first:first + len(some), None].astype(np.float32))

    def odds(hits, of):
        share = (hits + 0.5) / (of + 1)
        return np.log(share / (1 - share))

    own = odds(np.diag(toxic), np.diag(met)) - odds(labels.sum(), len(labels))
    added = 1 / (1 + np.exp(-(own[:, None] + own + odds(labels.sum(), len(labels)))))
    spread = np.maximum(met * added * (1 - added), 1e-9)
    tells = (met >= LEAST_ROWS) & ((toxic - met * added) ** 2 > PAIR_CHI_SQUARE * spread)
    np.fill_diagonal(tells, False)
    return terms[tells.any(axis=1)]


def train(rows: list[np.ndarray], labels: np.ndarray, rank: int = RANK, epochs: int = 40, seed: int = 3) -> Machine:
    """Adaptive stochastic gradients over single rows, with weight decay on the terms a row has."""
    rng = np.random.default_rng(seed)
    kept = telling(rows, labels)
    slot = np.zeros(1 << HASH_BITS, np.int32)
    slot[kept] = np.arange(1, len(kept) + 1)
    linear = np.zeros(len(kept) + 1)
    factors = rng.normal(0, 0.01, (len(kept) + 1, rank))
    seen_linear, seen_factors = np.full(len(linear), 1e-2), np.full(factors.shape, 1e-2)
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6) if len(labels) else 0.5
    bias, seen_bias = float(np.log(share / (1 - share))), 1.0
    own = [s[s > 0] for s in (slot[r] for r in rows)]
    for _ in range(epochs):
        for i in rng.permutation(len(own)):
            s = own[i]
            v = factors[s]
            total = v.sum(axis=0)
            z = bias + linear[s].sum() + 0.5 * float((total ** 2).sum() - (v ** 2).sum())
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]
            seen_bias += error * error
            bias -= 0.1 * error / np.sqrt(seen_bias)
            g = error + 1e-4 * linear[s]
            seen_linear[s] += g * g
            linear[s] -= 0.3 * g / np.sqrt(seen_linear[s])
            g = np.clip(error * (total - v), -1, 1) + 1e-3 * v
            seen_factors[s] += g * g
            factors[s] -= 0.02 * g / np.sqrt(seen_factors[s])
    linear[0], factors[0] = 0, 0
    return Machine(slot, bias, linear.astype(np.float32), factors.astype(np.float32))


def training_rows(documents: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Term sets and labels of at most `most_rows` rows, half of them from either label at most."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return [], np.zeros(0)
    each = most_rows // 2
    draw = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, 1.2 * each / counts[1]).otherwise(1.2 * each / counts[0])
    # about 1.2 * most_rows rows at any size of the input, so the texts need no shuffle
    drawn = F.broadcast(known.where(draw < share))
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text").join(drawn, "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            row, key = terms(batch.column("text"))
            packed = [k.astype(np.int32).tobytes() for k in np.split(key, np.searchsorted(row, np.arange(1, batch.num_rows)))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(packed, pa.binary())], ["toxic", "terms"])

    sets = rows.select("text", F.col("toxic").cast("int")).mapInArrow(hashed, "toxic int, terms binary")
    ordered = sets.orderBy(F.xxhash64("terms"), "toxic").limit(most_rows).collect()
    return [np.frombuffer(r["terms"], np.int32).astype(np.int64) for r in ordered], np.array([r["toxic"] for r in ordered], float)


def fit(documents: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Machine | None:
    rows, marks = training_rows(documents, labels, most_rows)
    return train(rows, marks) if 0 < marks.sum() < len(marks) else None


def with_toxicity(documents: DataFrame, machine: Machine | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add `score` and `predicted`; columns of those names are replaced. Only the text is read."""
    documents = documents.drop("score", "predicted")
    if machine is None:
        return documents.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    model = documents.sparkSession.sparkContext.broadcast(machine)
    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]):
        own = model.value
        for batch in slices(batches, "text"):
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own.of(batch.column("text")))], [*batch.schema.names, "score"])

    scored = documents.mapInArrow(apply, schema)
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
