import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import near as op
from gridseries.llm.bagminhash import bags, signatures, weighted_jaccard

from llm_samples import ODD


def bag(text):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_force(rows):
    group = list(range(len(rows)))
    sets = [bag(t) for _, t in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            common = sum((a & sets[j]).values())
            if a and common >= 0.8 * sum((a | sets[j]).values()):
                group = [group[i] if g == group[j] else g for g in group]
    names = {}
    for g, (i, _) in zip(group, rows):
        names.setdefault(g, []).append(i)
    return sorted(((i, min((x for x in names[g] if x is not None), default=None)) for g, (i, _) in zip(group, rows)), key=str)


@pytest.fixture
def rows(words):
    out, number = [], 0
    for base in range(6):
        w = words(150, base, 5000)
        for copy in range(12):
            edited = list(w)
            for k in range(copy // 2):
                edited[(17 * k + 31 * copy) % 150] = f"new{base}x{copy}x{k}"
            out.append((number, " ".join(edited)))
            number += 1
    # repeated passages count by how often they occur
    out += [(200, "one two three four five six " * 30), (201, "one two three four five six " * 28), (202, "one two three four five six " * 10)]
    out += [(210, "three words only"), (211, "Three, words ONLY!"), (212, "three other words")]
    return out + [(3, out[3][1])] + ODD


def test_classes_are_brute_force(documents, rows):
    got = [(r["doc_id"], r["class_id"]) for r in op.near_duplicates(documents(rows)).collect()]
    assert sorted(got, key=str) == brute_force(rows)


def test_one_of_each_class_stays(documents, rows):
    docs = documents(rows)
    kept = op.one_of_each(docs)
    assert kept.columns == docs.columns
    # all texts without words stay, repeated or not
    want = sorted({c for i, c in brute_force(rows) if i not in (900, 901, 902, 903)} | {900, 901, 902, 903}, key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want


def test_empty_table(documents, rows):
    assert op.near_duplicates(documents(rows).limit(0)).isEmpty()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in op.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("most", [2, 9, 60])
def test_signatures_are_unbiased(most):
    rng = np.random.default_rng(most)
    elements = rng.integers(1, 1 << 62, 250).astype(np.uint64)
    a = rng.integers(0, most, 250)
    b = np.where(rng.random(250) < 0.7, a, rng.integers(0, most, 250))
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    found = []
    for shift in range(60):
        seeded = elements ^ np.uint64(shift * 7919 + 1)
        rows = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = signatures(2, rows, np.concatenate([seeded[a > 0], seeded[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 125)
        found.append((s[0] == s[1]).mean())
    # five standard errors of 7500 components
    assert abs(np.mean(found) - true) < 5 * (true * (1 - true) / 7500) ** 0.5
    assert weighted_jaccard((np.arange(250)[a > 0], a[a > 0]), (np.arange(250)[b > 0], b[b > 0])) == pytest.approx(true)


def test_bags_count_repeats():
    rows, shingles, n = bags(np.array([1, 0, 1, 1]), np.array([5, 5, 7, 5], np.uint64))
    assert list(zip(rows, shingles, n)) == [(0, 5, 1), (1, 5, 2), (1, 7, 1)]


def test_texts_longer_than_a_slice(documents, words):
    base = words(190_000, 21, 5000)
    assert len(" ".join(base)) > op.STEP
    rows = [(1, " ".join(base)), (2, " ".join(base[:-3000])), (3, " ".join(base[::-1])), (4, " ".join(base[:60_000])), (5, " ".join(base))]
    got = {r["doc_id"]: r["class_id"] for r in op.near_duplicates(documents(rows, 2)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}


def test_texts_whose_first_hash_is_the_same(documents, rows, monkeypatch):
    """Five hashes for all texts: the second hash keeps them apart, copies stay together."""
    monkeypatch.setattr(op, "_raw", lambda: F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(5)))
    docs = documents(rows)
    assert sorted(((r["doc_id"], r["class_id"]) for r in op.near_duplicates(docs).collect()), key=str) == brute_force(rows)
    want = sorted({c for i, c in brute_force(rows) if i not in (900, 901, 902, 903)} | {900, 901, 902, 903}, key=str)
    assert sorted((r["doc_id"] for r in op.one_of_each(docs).collect()), key=str) == want
