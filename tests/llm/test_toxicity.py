import numpy as np
import pyarrow as pa
import pytest

from gridseries.llm import toxicity as op
from llm_samples import ODD


def corpus(words, n, seed):
    """Toxic only if an insult meets a group: neither alone tells."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = i % 4
        extra = ["scumbag"] * (kind in (1, 3)) + ["groupname"] * (kind in (2, 3))
        text = words(15, seed * 100_000 + i) + extra
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(kind == 3)))
    return rows


@pytest.fixture
def machine(words):
    rows = corpus(words, 1200, 1)
    row, key = op.terms(pa.array([t for _, t, _ in rows]))
    sets = np.split(key, np.searchsorted(row, np.arange(1, len(rows))))
    return op.train(sets, np.array([y for _, _, y in rows], float))


def test_interactions_are_learned(machine, words):
    rows = corpus(words, 400, 2)
    score = machine.of(pa.array([t for _, t, _ in rows]))
    label = np.array([y for _, _, y in rows])
    assert ((score >= 0.5) == label).mean() > 0.97
    line = machine.linear[machine.slot[op.terms(pa.array(["scumbag groupname"]))[1]]]
    assert np.abs(machine.factors).max() > 0.1 and len(line) == 4


@pytest.mark.parametrize("alike", [1, 0])
def test_terms_that_tell_only_together(words, alike):
    """Each of two terms is as common in toxic rows as in clean ones; both or neither, or just one of them, is toxic."""
    def made(n, seed):
        rng = np.random.default_rng(seed)
        first, second = rng.integers(0, 2, n), rng.integers(0, 2, n)
        texts = [" ".join([*words(12, seed * 10 ** 6 + i), *["mildinsult"] * a, *["somegroup"] * b]) for i, (a, b) in enumerate(zip(first, second))]
        return texts, ((first == second) == bool(alike)).astype(float)

    texts, labels = made(4000, 1)
    row, key = op.terms(pa.array(texts))
    sets = np.split(key, np.searchsorted(row, np.arange(1, len(texts))))
    own = set(op.terms(pa.array(["mildinsult somegroup"]))[1].tolist())
    assert own <= set(op.telling(sets, labels).tolist())
    machine = op.train(sets, labels)
    texts, labels = made(1000, 2)
    assert ((machine.of(pa.array(texts)) >= 0.5) == labels).mean() > 0.95
    # and chance alone brings in hardly any term
    assert len(op.telling(sets, np.random.default_rng(3).integers(0, 2, len(sets)).astype(float))) < 5


def test_ties_and_very_long_texts(machine):
    long = pa.array(["scumbag " + "filler thing " * 120_000 + "groupname", "scumbag groupname", "scumbag groupname"])
    assert pa.array(long).nbytes > 1 << 20
    score = machine.of(long)
    # repeated rows are scored alike, and a long text by its set of terms
    assert score[1] == score[2] and (score >= 0.5).all()


def test_score_is_the_sum_over_pairs(machine):
    keys = op.terms(pa.array(["scumbag groupname thing other"]))[1]
    slots = machine.slot[keys]
    slots = slots[slots > 0]
    z = machine.bias + machine.linear[slots].sum()
    for i in range(len(slots)):
        for j in range(i):
            z += float(machine.factors[slots[i]] @ machine.factors[slots[j]])
    assert machine.of(pa.array(["scumbag groupname thing other"]))[0] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


def test_fit_and_score(spark, documents, words):
    rows = corpus(words, 880, 3)
    docs = documents([(i, t) for i, t, _ in rows] + ODD)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(900, 1), (5, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    fitted = op.fit(docs, labels)
    scored = op.with_toxicity(docs, fitted)
    assert scored.columns == ["doc_id", "text", "spans", "score", "predicted"]
    found = [(r["doc_id"], r["score"], r["predicted"]) for r in scored.collect()]
    truth = {i: y for i, _, y in rows}
    known = [(truth[i], s) for i, s, _ in found if i in truth]
    assert sum((s >= 0.5) == y for y, s in known) / len(known) > 0.97
    assert all(p == int(s >= 0.7) and 0 <= s <= 1 for _, s, p in found)
    # empty texts have the bias alone
    assert len({s for i, s, _ in found if i in (900, 901, 902, 903)}) == 1
    assert len(op.training_rows(docs, labels, 100)[0]) <= 100


def test_without_both_labels_nothing_is_toxic(spark, documents):
    docs = documents(ODD)
    labels = spark.createDataFrame([(904, 0)], "doc_id long, toxic int")
    assert op.fit(docs, labels) is None and op.fit(docs, labels.limit(0)) is None
    assert {(r["score"], r["predicted"]) for r in op.with_toxicity(docs, None).collect()} == {(0.0, 0)}
    assert op.with_toxicity(docs.limit(0), None).isEmpty()
