"""Language-model scores by a weighted backoff automaton over the corpus's own n-grams.

The model has words and pairs of words, smoothed towards the words:
    p(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | h) = (c(h w) + PRIOR p(w)) / (c(h) + PRIOR)
which sums to one over all words for every h. As an automaton: a state for each history, arcs for the
pairs seen, and a failure arc of weight PRIOR / (c(h) + PRIOR) to the root, whose arcs have p(w). A
text is read once from left to right; the traversal carries the state and adds up the weights.

Counts cover all training texts, and no task holds the whole model. Documents are dealt to batches by
a hash. A batch sends each of its distinct words and pairs, with its own counts, to the reducer of that
key; the reducer adds up and answers every batch with the totals that differ from the batch's own count.
A batch so gets the part of the automaton that its texts can reach, builds it and traverses it.

Words are compared by 64-bit hashes. Null texts count as empty: one end token. Repeated rows are
counted and scored each; a corpus without training text has N = V = 0 and p(w) = 1; empty tables give
no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.flat import LOWER, flatten, mix, prefix_hash, slices, span_hash, word_spans
from gridseries.llm.tables import pieces, stored

PRIOR = 20.0
BATCH_BYTES = 8 << 20
SLICE = 1 << 20
LEAST_BATCHES = 16
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[32, 9, 10, 11, 12, 13]] = False
END = np.uint64(0x1234567890ABCDEF)
BEGIN = np.uint64(0x0FEDCBA987654321)


def token_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each row's words and then its end; where each row begins."""
    data, offsets = flatten(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTE)
    begins = first + np.arange(len(first))
    keys = np.full(begins[-1], END, np.uint64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys[np.arange(len(starts)) + row] = span_hash(prefix_hash(low), starts, ends)
    return keys, begins


def pair_keys(keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Key of each token together with the one before it."""
    before = np.append(BEGIN, keys[:-1])[:len(keys)]
    before[begins[:-1]] = BEGIN
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)))


def _counted(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is in training tokens."""
    distinct, counts = np.unique(keys[training], return_counts=True)
    others = np.setdiff1d(keys[~training], distinct)
    keys = np.concatenate([distinct, others])
    order = np.argsort(keys)
    return keys[order], np.concatenate([counts, np.zeros(len(others), np.int64)])[order]


def _training(table: pa.Table, begins: np.ndarray) -> np.ndarray:
    return np.repeat(table["training"].to_numpy().astype(bool), np.diff(begins))


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Token keys of a whole batch, hashed in slices so that the work arrays stay small."""
    keys, begins, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for batch in slices(table.select(["text"]).to_batches(), "text", SLICE):
        own, first = token_keys(batch.column(0))
        keys.append(own)
        begins.append(first[1:] + n)
        n += len(own)
    return np.concatenate(keys), np.concatenate(begins)


class Automaton:
    """The states a batch can reach. State 0 is the root, 1 the beginning, further ones the words."""

    def __init__(self, words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray,
                 tokens: int, kinds: int, texts: int, prior: float = PRIOR):
        self.words = words
        self.root = np.log10((word_counts + 0.1) / (tokens + 0.1 * (kinds + 1)))
        count = np.concatenate([[0, texts], word_counts])
        self.fail = np.log10(prior / (count + prior))
        self.count, self.prior = count + prior, prior
        seen = pair_counts > 0
        self.arcs, self.weights = pairs[seen], pair_counts[seen].astype(float)

    def steps(self, state: np.ndarray, word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and log10 weights for one token each; without an arc the failure arc leads to the root."""
        weight = self.fail[state] + self.root[word]
        if len(self.arcs):
            at = np.minimum(np.searchsorted(self.arcs, pair), len(self.arcs) - 1)
            arc = np.flatnonzero(self.arcs[at] == pair)
            weight[arc] = np.log10((self.weights[at[arc]] + self.prior * 10 ** self.root[word[arc]]) / self.count[state[arc]])
        return word + 2, weight

    def traverse(self, keys: np.ndarray, pairs: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log10 probability of each text; all texts of the batch advance by one token at a time."""
        lengths = np.diff(begins)
        order = np.argsort(-lengths, kind="stable")
        starts, word = begins[:-1][order], np.searchsorted(self.words, keys)
        total, state = np.zeros(len(order)), np.ones(len(order), np.int64)
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
        for t, n in enumerate(active):
            at = starts[:n] + t
            state[:n], weight = self.steps(state[:n], word[at], pairs[at])
            total[:n] += weight
        out = np.empty(len(order))
        out[order] = total
        return out


def _planes(x: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte: first all lowest bytes, last all highest, which the shuffle then compresses."""
    x = np.ascontiguousarray(x).astype(kind, copy=False)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, len(planes) // width).T).view(kind).ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Ordered keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), "<u8")


def _keys(steps: bytes) -> np.ndarray:
    return np.cumsum(_numbers(steps, "<u8"), dtype=np.uint64)


def score_texts(documents: DataFrame, training: Column, prior: float = PRIOR) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score; learned where `training` holds."""
    rows = documents.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training"))
    batches = pieces(rows, BATCH_BYTES, LEAST_BATCHES, "text")
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))
    names = ["reducer", "batch", "words", "word_counts", "pairs", "pair_counts"]

    def send(table: pa.Table) -> pa.Table:
        keys, begins = _texts(table)
        training = _training(table, begins)
        words, word_counts = _counted(keys, training)
        pairs, pair_counts = _counted(pair_keys(keys, begins), training)
        word_to, pair_to = (_shares(x, batches) for x in (words, pairs))
        out = []
        # only reducers that get something, so messages never outnumber keys
        reached = np.flatnonzero(np.diff(word_to) + np.diff(pair_to)).tolist()
        for r in reached:
            w, p = slice(word_to[r], word_to[r + 1]), slice(pair_to[r], pair_to[r + 1])
            out.append((_steps(words[w]), _planes(word_counts[w], "<u4"), _steps(pairs[p]), _planes(pair_counts[p], "<u4")))
        columns = [pa.array(c, pa.binary()) for c in zip(*out)]
        own = table["batch"][0].as_py()
        return pa.table([pa.array(reached, pa.int64()), pa.array([own] * len(reached), pa.int64()), *columns], names)

    def add(table: pa.Table) -> pa.Table:
        out = {"batch": table["batch"].to_pylist(), "reducer": table["reducer"].to_pylist()}
        kinds = tokens = 0
        for name in ("word", "pair"):
            blobs = [_keys(x.as_py()) for x in table[name + "s"]]
            at = np.cumsum([0, *map(len, blobs)])
            keys = np.concatenate(blobs)
            del blobs
            counts = np.concatenate([_numbers(x.as_py(), "<u4") for x in table[name + "_counts"]])
            inverse = np.unique(keys, return_inverse=True)[1]
            total = np.bincount(inverse, counts).astype(np.int64)
            if name == "word":
                kinds, tokens = int((total > 0).sum()), int(total.sum())
            total = total[inverse]
            tell = total != counts
            # the batch has the same keys in the same order, so marks say which ones the totals are for
            out[name + "s"] = [np.packbits(tell[a:b]).tobytes() for a, b in zip(at, at[1:])]
            out[name + "_counts"] = [_planes(total[a:b][tell[a:b]], "<u8") for a, b in zip(at, at[1:])]
        n = len(out["batch"])
        out["kinds"], out["tokens"] = [kinds] + [0] * (n - 1), [tokens] + [0] * (n - 1)
        return pa.table({"batch": pa.array(out["batch"], pa.int64()), "reducer": pa.array(out["reducer"], pa.int64()),
                         **{k: pa.array(out[k], pa.binary()) for k in names[2:]},
                         "kinds": pa.array(out["kinds"], pa.int64()), "tokens": pa.array(out["tokens"], pa.int64())})

    blobs = "words binary, word_counts binary, pairs binary, pair_counts binary"
    sent = dealt.groupBy("batch").applyInArrow(send, f"reducer long, batch long, {blobs}")
    answers = stored(sent.groupBy("reducer").applyInArrow(add, f"batch long, reducer long, {blobs}, kinds long, tokens long"), "answers")
    kinds, tokens = answers.agg(F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    texts = rows.where("training").count()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, begins = _texts(left)
        training = _training(left, begins)
        pair_of = pair_keys(keys, begins)
        learned = []
        for name, own in (("word", keys), ("pair", pair_of)):
            distinct, counts = _counted(own, training)
            edges = _shares(distinct, batches)
            for r, marks, totals in zip(*(right[c].to_pylist() for c in ("reducer", name + "s", name + "_counts"))):
                share = counts[edges[r]:edges[r + 1]]
                share[np.unpackbits(np.frombuffer(marks, np.uint8), count=len(share)).astype(bool)] = _numbers(totals, "<u8")
            learned += [distinct, counts]
        automaton = Automaton(*learned, tokens, kinds, texts, prior)
        word = np.searchsorted(automaton.words, keys)
        known = learned[1][word] > 0
        n = np.diff(begins)
        sums = [np.add.reduceat(x, begins[:-1]) if len(n) else np.zeros(0) for x in (known.astype(np.int64), automaton.root[word])]
        return pa.table([left["doc_id"], left["training"], pa.array(n, pa.int64()), pa.array(sums[0], pa.int64()),
                         pa.array(np.full(len(n), tokens), pa.int64()), pa.array(sums[1], pa.float64()),
                         pa.array(automaton.traverse(keys, pair_of, begins), pa.float64())],
                        ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        score, "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _shares(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each reducer's share of the 64-bit range begins among ordered keys, and their end."""
    borders = np.array([(i << 64) // parts for i in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, borders), len(keys))
