"""Language identification with a bidirectional gated recurrent network over bytes.

Whole texts are cut into consecutive windows of `STEPS` bytes. A forward and a backward recurrence
with reset and update gates run over each window, a softmax labels every byte position, and a
document's probabilities are the mean of its positions' log-probabilities, normalised. All bytes of
all texts are read. The network is trained in numpy by backpropagation through time on at most
`per_language` different texts for each label, of each text windows from all over it, `windows_each` at most; every
label that has a row is learned. The score counts at most `EVIDENCE` positions, however long a text is, so that
it stays apart from 0 and 1; the label does not depend on that.

Defined cases: a null text or one without a letter is `und` with score 0; without any labelled row
everything is `und`; repeated rows are scored alike; extra columns stay untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.flat import flatten, slices

STEPS = 48
HIDDEN = 8
PER_LANGUAGE = 400
WINDOWS_EACH = 12
MOST_TEXTS = 80_000
EVIDENCE = 10
ROUNDS = 700
ROUNDS_EACH = 10
UNKNOWN = "und"
LANES = 2048


def training_windows(labelled: DataFrame, per_language: int = PER_LANGUAGE, windows_each: int = WINDOWS_EACH, steps: int = STEPS) -> list[tuple[str, bytes]]:
    """Windows of at most `per_language` texts for each label that has a row, chosen by a hash of the text.

    Copies of a text under one label are one text. A first filter by hash keeps about twice what is
    wanted of each label, so that none is ranked whole. With so many labels that all texts would be
    more than MOST_TEXTS, each label has fewer, but one at least. A text of up to `windows_each` windows is taken whole;
    of a longer one as many windows, one at a place chosen by a hash in each of as many equal parts, so no part of a
    text is left out. The model's driver thus holds a bounded number of bytes, whatever the texts' lengths.
    """
    draw = F.xxhash64("text", F.lit(7))
    rows = (labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .select("lang", "text", draw.alias("draw")))
    counts = rows.select("lang", "draw").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return []
    per_language = max(1, min(per_language, MOST_TEXTS // len(counts)))
    # so many that the filter hardly leaves too few; the model has all labels in one place too
    keep = max(2.0 * per_language, 40.0)
    share = labelled.sparkSession.createDataFrame([(r["lang"], keep / r["n"]) for r in counts], "lang string, share double")
    unit = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(F.broadcast(share), "lang").where(unit < F.col("share"))
    data = F.col("text").cast("binary")
    n = F.octet_length("text")
    part = n / windows_each

    def window(i):
        shift = F.pmod(F.xxhash64("draw", i), F.greatest(F.lit(1), F.floor(part - steps + 1).cast("long")))
        return F.substring(data, F.floor(i * part).cast("int") + shift.cast("int") + 1, F.lit(steps))

    cut = F.when(n <= windows_each * steps, F.array(data)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(windows_each - 1)), window))
    once = drawn.select("lang", "draw", cut.alias("windows")).groupBy("lang", "draw").agg(F.min("windows").alias("windows"))
    ranked = once.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    chosen = ranked.where(F.col("place") <= per_language).orderBy("lang", "place").collect()
    return [(r["lang"], bytes(w)) for r in chosen for w in r["windows"]]


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Gru:
    """Weights of one direction; gate columns are update, reset, candidate."""

    table: np.ndarray
    inner: np.ndarray
    bias: np.ndarray

    @staticmethod
    def new(rng, hidden: int) -> Gru:
        return Gru(rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
                   rng.normal(0, 0.4, (hidden, 3 * hidden)).astype(np.float32), np.zeros(3 * hidden, np.float32))

    def run(self, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step; `steps` is (time, lane)."""
        hidden = self.inner.shape[0]
        table = self.table + self.bias
        gates_in, candidate_in = np.ascontiguousarray(self.inner[:, :2 * hidden]), np.ascontiguousarray(self.inner[:, 2 * hidden:])
        h = np.zeros((steps.shape[1], hidden), np.float32)
        out = np.empty((*steps.shape, hidden), np.float32)
        for t, column in enumerate(steps):
            x = table.take(column, axis=0)
            gates = h @ gates_in
            gates += x[:, :2 * hidden]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:, :hidden], gates[:, hidden:]
            before = h
            candidate = (reset * before) @ candidate_in
            candidate += x[:, 2 * hidden:]
            np.tanh(candidate, out=candidate)
            h = before + update * (candidate - before)
            out[t] = h
            if keep is not None:
                keep.append((before, update, reset, candidate))
        return out

    def back(self, steps: np.ndarray, kept: list, upstream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of table, inner and bias from those of the states, backwards through time."""
        hidden = self.inner.shape[0]
        d_table, d_inner = np.zeros_like(self.table), np.zeros_like(self.inner)
        flow = np.zeros(upstream.shape[1:], np.float32)
        for t in range(len(steps) - 1, -1, -1):
            before, update, reset, candidate = kept[t]
            flow = flow + upstream[t]
            d_candidate = flow * update * (1 - candidate ** 2)
            d_update = flow * (candidate - before) * update * (1 - update)
            through = d_candidate @ self.inner[:, 2 * hidden:].T
            d_reset = through * before * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset], axis=1)
            d_inner[:, :2 * hidden] += before.T @ d_gates
            d_inner[:, 2 * hidden:] += (reset * before).T @ d_candidate
            np.add.at(d_table, steps[t], np.concatenate([d_gates, d_candidate], axis=1))
            flow = flow * (1 - update) + through * reset + d_gates @ self.inner[:, :2 * hidden].T
        return d_table, d_inner, d_table.sum(axis=0)


@dataclass
class Network:
    languages: list[str]
    ahead: Gru
    behind: Gru
    out: np.ndarray
    out_bias: np.ndarray
    steps: int = STEPS
    losses: list = field(default_factory=list)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(time, lane, language) for windows given as (lane, time)."""
        steps = np.ascontiguousarray(windows.T)
        states = np.concatenate([self.ahead.run(steps), self.behind.run(steps[::-1])[::-1]], axis=2)
        logits = states @ self.out + self.out_bias
        logits -= logits.max(axis=2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return logits


def train(examples: list[tuple[str, bytes]], steps: int = STEPS, hidden: int = HIDDEN, rounds: int = ROUNDS,
          lanes: int = 96, seed: int = 5) -> Network:
    """Fit by Adam; each round draws windows evenly over the languages."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in examples})
    net = Network(languages, Gru.new(rng, hidden), Gru.new(rng, hidden),
                  rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32),
                  np.zeros(len(languages), np.float32), steps)
    if len(languages) < 2:
        return net
    by = [[np.frombuffer(text.ljust(steps), np.uint8) for lang, text in examples if lang == want] for want in languages]
    weights = [net.ahead.table, net.ahead.inner, net.ahead.bias, net.behind.table, net.behind.inner, net.behind.bias,
               net.out, net.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for turn in range(1, rounds + 1):
        label = rng.integers(0, len(languages), lanes)
        texts = [by[k][rng.integers(0, len(by[k]))] for k in label]
        begin = [rng.integers(0, len(x) - steps + 1) for x in texts]
        windows = np.stack([x[b:b + steps] for x, b in zip(texts, begin)], axis=1)
        kept_ahead, kept_behind = [], []
        ahead = net.ahead.run(windows, kept_ahead)
        behind = net.behind.run(windows[::-1], kept_behind)
        states = np.concatenate([ahead, behind[::-1]], axis=2)
        logits = states @ net.out + net.out_bias
        chance = np.exp(logits - logits.max(axis=2, keepdims=True))
        chance /= chance.sum(axis=2, keepdims=True)
        picked = chance[:, np.arange(lanes), label]
        net.losses.append(float(-np.log(np.maximum(picked, 1e-9)).mean()))
        error = chance
        error[:, np.arange(lanes), label] -= 1
        error /= lanes * steps
        d_states = error @ net.out.T
        grads = [*net.ahead.back(windows, kept_ahead, d_states[:, :, :hidden]),
                 *net.behind.back(windows[::-1], kept_behind, d_states[::-1, :, hidden:]),
                 np.einsum("tlh,tlc->hc", states, error), error.sum(axis=(0, 1))]
        size = np.sqrt(sum(float((g ** 2).sum()) for g in grads))
        rate = 0.02 * min(1.0, 1.5 * (1 - turn / (rounds + 1)))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(row, language): mean log-probability over all positions of each row."""
    lengths = np.diff(offsets)
    total = np.zeros((len(lengths), len(net.languages)))
    windows_each = -(-lengths // net.steps)
    row = np.repeat(np.arange(len(lengths)), windows_each)
    if not len(row):
        return total
    number = np.arange(len(row)) - np.repeat(np.cumsum(windows_each) - windows_each, windows_each)
    start = offsets[row] + number * net.steps
    held = np.minimum(offsets[row + 1] - start, net.steps)
    padded = np.append(data, np.full(net.steps, 32, np.uint8))
    inner = np.arange(net.steps)
    for at in range(0, len(row), LANES):
        some = slice(at, at + LANES)
        windows = padded[start[some, None] + inner]
        inside = inner < held[some, None]
        windows[~inside] = 32
        chances = net.log_probabilities(windows)
        chances *= inside.T[:, :, None]
        sums = chances.sum(axis=0, dtype=np.float64)
        edges = np.flatnonzero(np.append(True, np.diff(row[some]) > 0))
        total[row[some][edges]] += np.add.reduceat(sums, edges, axis=0)
    return total / np.maximum(lengths, 1)[:, None]


def fit(documents: DataFrame, labelled: DataFrame | None = None, per_language: int = PER_LANGUAGE, windows_each: int = WINDOWS_EACH) -> Network | None:
    examples = training_windows(documents if labelled is None else labelled, per_language, windows_each)
    return train(examples, rounds=max(ROUNDS, ROUNDS_EACH * len({lang for lang, _ in examples}))) if examples else None


def with_language(documents: DataFrame, net: Network | None) -> DataFrame:
    """Add `lang_pred` and `score`; columns of those names are replaced. Only the text is read."""
    documents = documents.drop("lang_pred", "score", "_letters")
    if net is None:
        return documents.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    model = documents.sparkSession.sparkContext.broadcast(net)
    marked = documents.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([*documents.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def label(batches):
        own = model.value
        for batch in slices(batches, "text"):
            data, offsets = flatten(batch.column("text"))
            mean = pooled(own, data, offsets)
            chance = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(np.diff(offsets), EVIDENCE)[:, None])
            chance /= chance.sum(axis=1, keepdims=True)
            best = chance.argmax(axis=1)
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            names = [UNKNOWN if not ok else own.languages[k] for ok, k in zip(letters, best)]
            score = np.where(letters, chance[np.arange(len(best)), best], 0.0)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score)],
                                             [*batch.schema.names[:-1], "lang_pred", "score"])

    return marked.mapInArrow(label, schema)
