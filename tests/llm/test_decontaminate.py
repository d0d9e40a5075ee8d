import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridseries.llm import decontaminate as op

from llm_samples import ODD


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(docs, items, window=10):
    windows = []
    for item, text in items:
        w = tokens(text)
        windows += [(item, w[i:i + window]) for i in range(max(1, len(w) - window + 1) if w else 0)]
    out = []
    for doc_id, text in docs:
        w, hit, found = tokens(text), set(), set()
        for item, win in windows:
            for s in range(len(w) - len(win) + 1):
                if w[s:s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    found |= {str(item)} if item is not None else set()
        names = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def case(spark, documents, words):
    items = [(1, " ".join(words(30, 1))), (10, " ".join(words(12, 2))), (2, "Only Four Words here"), (3, None), (4, "?"),
             (None, " ".join(words(11, 3))), (1, " ".join(words(10, 4)))]
    docs = [(i, " ".join(words(60, 50 + i))) for i in range(12)]
    docs[1] = (1, "start " + ", ".join(words(30, 1)[4:17]).upper() + " end")
    docs[2] = (2, "ONLY four; words HERE " * 3 + " ".join(words(12, 2)))
    docs[3] = (3, " ".join(words(30, 1)[:9]))
    docs[4] = (4, " ".join(words(11, 3)))
    docs[5] = (5, " ".join(words(30, 1) + words(10, 4)))
    rows = docs + [docs[1]] + ODD
    return rows, items, documents(rows), spark.createDataFrame(items, "item_id long, text string")


def test_it_is_brute_force(case):
    rows, items, docs, benchmark = case
    got = sorted(map(tuple, op.contamination(docs, benchmark).collect()), key=str)
    assert got == brute_force(rows, items)


def test_blocks_give_the_same(case):
    rows, items, docs, benchmark = case
    whole = op.find_spans(docs, benchmark).select("doc_id", "n_words", F.array_sort("spans").alias("spans"))
    blocks = op.find_spans(docs, benchmark, block_bytes=60).select("doc_id", "n_words", F.array_sort("spans").alias("spans"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect()))


def test_empty_tables(spark, case):
    _, _, docs, benchmark = case
    assert op.contamination(docs.limit(0), benchmark).isEmpty()
    assert op.contamination(docs, benchmark.limit(0)).filter("contaminated or n_hit > 0").isEmpty()


def test_clean_documents_stay_as_they_are(case):
    rows, items, docs, benchmark = case
    docs = docs.withColumn("n_words", docs.doc_id + 7)
    kept = op.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and {(r["spans"], r["n_words"] - r["doc_id"]) for r in kept.collect() if r["doc_id"] is not None} == {("x", 7)}
    clean = [r[0] for r in brute_force(rows, items) if not r[5]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_texts_longer_than_a_slice(spark, documents, words):
    filler = " ".join(words(100, 8)) + " "
    long = filler * 3000 + " ".join(words(30, 1)[2:15]) + " tail"
    assert len(long) > 1 << 20
    items, rows = [(1, " ".join(words(30, 1)))], [(1, long), (2, filler * 3000), (3, long)]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in op.contamination(documents(rows, 1), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: (300_014, 13, 1), 2: (300_000, 0, 0), 3: (300_014, 13, 1)}
