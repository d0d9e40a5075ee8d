import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import perplexity as op
from llm_samples import ODD


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute_force(rows, training, prior=op.PRIOR):
    words, pairs, texts = Counter(), Counter(), 0
    for row in rows:
        if training(row):
            w = tokens(row[1])
            words.update(w)
            pairs.update(zip([0, *w], w))
            texts += 1
    n, v = sum(words.values()), len(words)
    out = []
    for row in rows:
        w, base, score = tokens(row[1]), 0.0, 0.0
        for before, word in zip([0, *w], w):
            p = (words[word] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            score += math.log10((pairs[before, word] + prior * p) / ((texts if before == 0 else words[before]) + prior))
        out.append((row[0], len(w), sum(words[x] > 0 for x in w), n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [1, 16])
def test_scores_are_brute_force(documents, words, monkeypatch, least):
    monkeypatch.setattr(op, "LEAST_BATCHES", least)
    rows = [(i, " ".join(words(5 + 3 * i, i))) for i in range(40)] + [(41, "Ünïcode ÀB\tC\x0bd\x1fe f"), (0, "again")] + ODD
    learned = F.col("doc_id") % 4 != 0
    got = op.score_texts(documents(rows), learned)
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got.collect()), key=str)
    want = brute_force(rows, lambda r: r[0] is not None and r[0] % 4 != 0)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert np.allclose([x[4:] for x in got], [x[4:] for x in want])


def test_probabilities_sum_to_one():
    keys = np.array([5, 9, op.END, 5, 9, 9, op.END], np.uint64)
    begins = np.array([0, 3, 7])
    words, counts = np.unique(keys, return_counts=True)
    pairs, pair_counts = np.unique(op.pair_keys(keys, begins), return_counts=True)
    automaton = op.Automaton(words, counts, pairs, pair_counts, 7, 3, 2)
    for state, before in ((1, op.BEGIN), (2, words[0]), (3, words[1])):
        pair = np.array([op.pair_keys(np.array([before, w], np.uint64), np.array([0, 2]))[1] for w in words])
        if before == op.BEGIN:
            pair = op.pair_keys(words, np.arange(4))
        _, weight = automaton.steps(np.full(3, state), np.arange(3), pair)
        # what is left over belongs to unseen words, whose base is 0.1 of a count
        unseen = 10 ** automaton.fail[state] * 0.1 / (7 + 0.1 * 4)
        assert (10 ** weight).sum() + unseen == pytest.approx(1)


def test_messages_keep_numbers():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (op._keys(op._steps(keys)) == keys).all() and len(op._keys(op._steps(keys[:0]))) == 0
    edges = op._shares(keys, 7)
    assert edges[0] == 0 and edges[-1] == 1000 and (np.diff(edges) > 0).all()


def test_without_training_texts(documents):
    got = op.score_texts(documents(ODD), F.lit(False)).collect()
    assert len(got) == len(ODD) and {(r["n_known"], r["train_tokens"]) for r in got} == {(0, 0)}
    assert op.score_texts(documents(ODD).limit(0), F.lit(True)).isEmpty()


def test_texts_longer_than_a_slice(documents, words):
    long = " ".join(words(3000, 8)) + " "
    rows = [(1, long * 100), (2, long), (4, "one more"), (8, long * 100)]
    assert len(rows[0][1]) > op.SLICE
    got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in op.score_texts(documents(rows, 1), F.col("doc_id") % 4 != 0).collect())
    want = brute_force(rows, lambda r: r[0] % 4 != 0)
    assert np.allclose(np.array(got), np.array(sorted(want)))
