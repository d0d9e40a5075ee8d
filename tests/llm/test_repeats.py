import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest

from gridseries.llm import repeats as op

from llm_samples import ODD


def brute_force(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(t), int(gone.sum()), len(op.intervals(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def rows(words):
    rng = random.Random(4)
    out = [(i, " ".join(words(rng.randint(20, 300), 100 + i, 4000))) for i in range(30)]
    shared = " ".join(words(90, 7, 4000))
    for i in (2, 5, 9, 14):
        text = out[i][1]
        out[i] = (i, text[:150] + shared[i:len(shared) - 2 * i] + text[150:])
    out[20] = (20, out[21][1])
    out[22] = (22, shared + " between " + shared)
    out[23] = (23, "ab" * 600)
    out[24] = (24, "é" + "ab" * 250)
    out[25] = (25, "z" * 399)
    out[26] = (26, "q" * 401)
    # many neighbours of one passage
    out += [(100 + i, f"{i} " + " ".join(words(80, 300 + i)) + shared[100:560] + " ".join(words(30, 400 + i))) for i in range(20)]
    return out + ODD


@pytest.mark.parametrize("most,length", [(op.MOST_CONTENTS, 400), (3, 400), (op.MOST_CONTENTS, 240), (3, 16)])
def test_removal_is_brute_force(documents, rows, monkeypatch, most, length):
    monkeypatch.setattr(op, "MOST_CONTENTS", most)
    monkeypatch.setattr(op, "LEAST_BUCKETS", 8)
    monkeypatch.setattr(op, "MERGE_BYTES", 1500)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest())
           for r in op.without_repeats(documents(rows), length).collect()]
    assert sorted(got, key=str) == brute_force(rows, length)


def test_lengths_are_whole_blocks(documents, rows):
    with pytest.raises(ValueError, match="multiple of 4"):
        op.without_repeats(documents(rows), 100 + 1)


def test_kept_text_has_whole_characters_only(documents):
    shared = "é" * 200 + "\ufffd"
    rows = [(1, "ü\ufffda" + shared + "é\ufffd"), (2, "b" + shared + "z"), (3, None), (4, "short é")]
    got = {r["doc_id"]: r["kept"] for r in op.without_repeats(documents(rows), 400, as_text=True).collect()}
    assert got == {1: "ü\ufffdaé\ufffd", 2: "bz", 3: "", 4: "short é"}
    # the cut starts within the first character of the run, as é is 2 bytes and the strings are odd
    rows = [(1, "x" + "é" * 300), (2, "\u00e8" + "é" * 299)]
    assert {r["kept"] for r in op.without_repeats(documents(rows), 400, as_text=True).collect()} <= {"x", "", "\u00e8"}


def test_short_runs_of_words_stay(documents):
    few, many = " ".join(f"longerword{i:03}" for i in range(40)), " ".join(f"w{i:03}" for i in range(100))
    rows = [(i, f"{i}start {few} {i}middle {many} {i}end") for i in range(3)]
    kept = {r["doc_id"]: r["kept"] for r in op.without_repeats(documents(rows), 400, least_words=51, as_text=True).collect()}
    assert all(few in kept[i] and "w050" not in kept[i] for i in range(3))


def test_times_count_as_copies():
    text = bytes(range(200)) * 3
    assert not op.repeated_windows([text[:450]], 400)[0].any()
    assert op.repeated_windows([text[:450]], 400, times=[2])[0].all()


@pytest.mark.parametrize("shard", [500, 3000, 1 << 18])
def test_merged_transforms_find_repeated_windows(shard):
    rng = random.Random(shard)
    base = [bytes(rng.choices(b"ab", k=900)) for _ in range(3)]
    strings = [b"xy" * 400, b"z" * 700, b"", b"short"]
    for _ in range(25):
        edited = bytearray(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            edited[rng.randrange(900)] = rng.choice(b"abc")
        begin = rng.randint(0, 300)
        strings.append(bytes(edited[begin:rng.randint(begin + 100, 900)]))
    seen = Counter(s[i:i + 400] for s in strings for i in range(len(s) - 399))
    for s, got in zip(strings, op.repeated_windows(strings, 400, shard)):
        assert got.tolist() == [seen[s[i:i + 400]] > 1 for i in range(len(s) - 399)]


def test_long_texts_are_cut_into_overlapping_parts(documents, words, monkeypatch):
    monkeypatch.setattr(op, "STEP", 2000)
    text = " ".join(words(4000, 9, 9000))
    rows = [(1, text), (2, text[7000:9000]), (3, text[:500] + text[-500:])]
    monkeypatch.setattr(op, "LEAST_BUCKETS", 4)
    got = [(r["doc_id"], r["n_removed"]) for r in op.without_repeats(documents(rows)).collect()]
    assert sorted(got) == [x[::2][:2] for x in brute_force(rows)]


def test_empty_table(documents, rows):
    assert op.without_repeats(documents(rows).limit(0)).isEmpty()


def test_extra_columns_stay(documents, rows):
    docs = documents(rows).withColumnRenamed("spans", "removed")
    assert op.without_repeats(docs).columns == ["doc_id", "text", "score", "kept", "n_bytes", "n_removed", "removed"]


def test_ranks_of_symbols_that_differ_in_their_lowest_bits():
    rng = np.random.default_rng(5)
    for symbols in (rng.integers(0, 1 << 64, 3000, dtype=np.uint64), rng.integers(0, 40, 3000, dtype=np.uint64) | np.uint64(1 << 63), np.zeros(0, np.uint64)):
        assert op.ranked(symbols).tolist() == np.unique(symbols, return_inverse=True)[1].tolist()


def test_transforms_of_many_symbols():
    """More symbols than a digit of the sort holds, in shards of different sizes."""
    rng = np.random.default_rng(6)
    strings = [rng.bytes(700) for _ in range(150)]
    strings += [s[i:i + 500] for i, s in enumerate(strings[:20])]
    seen = Counter(s[i:i + 400] for s in strings for i in range(len(s) - 399))
    for s, got in zip(strings, op.repeated_windows(strings, 400, 9000)):
        assert got.tolist() == [seen[s[i:i + 400]] > 1 for i in range(len(s) - 399)]


def test_cost_of_merged_transforms():
    """Against plain argsorts of as many numbers, which the machine slows down as well."""
    rng = np.random.default_rng(7)
    strings = [rng.bytes(600) for _ in range(800)]
    numbers = rng.integers(0, 1 << 62, sum(map(len, strings)))

    def least(run):
        took = []
        for _ in range(5):
            begun = time.process_time()
            run()
            took.append(time.process_time() - begun)
        return min(took)

    assert least(lambda: op.repeated_windows(strings, 400)) < 6 * least(lambda: np.argsort(numbers))
