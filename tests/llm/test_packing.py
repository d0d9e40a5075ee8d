import itertools
import random

import numpy as np
import pytest

from gridseries.llm import packing as op
from gridseries.llm.queries import tokenizer_path
from llm_samples import ODD

PIECES = ["a", " ", "\n", "\t", "don't", "1", "é", "日", "<|endoftext|>", "\r", " ", "\x85", " ", "!", "  ", "\x1c", "'s", "x", "²", "'ve"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer):
    rng, encoder = random.Random(2), op.Encoder(tokenizer_path())
    assert encoder.fast is not None
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 700 + "x", "ab " * 3 + "x" * 2000 + " y", "!" * 900, "\n" * 600]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want, repr(text)
    encoder.fast = None
    assert np.frombuffer(encoder.ids("a b"), "<u4").tolist() == tokenizer.encode("a b", add_special_tokens=False).ids


def test_fullest_bin_is_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        counts = np.zeros(31, np.int64)
        for _ in range(rng.randint(1, 8)):
            counts[rng.randint(1, 30)] += 1
        opener = int(np.flatnonzero(counts)[-1])
        chosen = op.fullest(30, opener, counts)
        assert all(n <= counts[length] for length, n in chosen.items()) and chosen[opener] >= 1
        rest = [length for length in range(1, 31) for _ in range(counts[length])]
        rest.remove(opener)
        best = max(opener + sum(c) for r in range(len(rest) + 1) for c in itertools.combinations(rest, r) if opener + sum(c) <= 30)
        assert sum(length * n for length, n in chosen.items()) == best


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.geometric(0.01, 5000), 256)
    counts = np.bincount(lengths, minlength=257)
    plan = op.minimum_slack(counts, 256)
    rank = np.concatenate([np.arange(n) for n in counts])
    length = np.repeat(np.arange(257), counts)
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    new = np.append(True, np.diff(sequence[order]) > 0)
    ends = (offset + length)[order]
    assert (offset[order][new] == 0).all() and (offset[order][1:][~new[1:]] == ends[:-1][~new[1:]]).all() and ends.max() <= 256
    # within one percent of the least that could hold them
    assert plan.sequences == len(np.unique(sequence)) <= 1.01 * -(-lengths.sum() // 256) + 1


def check(rows, packed, tokenizer, capacity):
    want = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) - capacity * (-(-len(ids) // capacity) - 1)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(doc_id, i, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in packed]
    assert sorted(got, key=str) == sorted(want, key=str)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r["length"] for r in packed)


@pytest.mark.parametrize("capacity", [32, 1024])
def test_packing(documents, words, tokenizer, capacity):
    rows = [(i, " ".join(words(1 + i % 37, i))) for i in range(200)] + [(7, "same"), (7, "same"), (300, " ".join(words(3000, 5)))] + ODD
    packed = op.pack(documents(rows, 5), tokenizer_path(), capacity).collect()
    n, tokens = check(rows, packed, tokenizer, capacity)
    assert n <= 1.05 * -(-tokens // capacity) + 1


def test_ranks_join_without_a_broadcast(documents, words, tokenizer, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_BYTES", 0)
    rows = [(i, " ".join(words(1 + i % 7, i))) for i in range(60)]
    check(rows, op.pack(documents(rows, 5), tokenizer_path(), 64).collect(), tokenizer, 64)


def test_empty_table(documents):
    assert op.pack(documents(ODD).limit(0), tokenizer_path()).isEmpty()


def test_ids_are_compared_with_those_of_the_file(monkeypatch):
    encoder = op.Encoder(tokenizer_path(), compared=2)
    class Other:
        def encode_to_numpy(self, text, allowed_special):
            return np.zeros(3, np.uint32)

    assert encoder.ids("some words") == encoder.exact("some words") and encoder.compared == 1
    encoder.fast = Other()
    with pytest.raises(ValueError, match="tokenizer file"):
        encoder.ids("other words")


def test_parameters_change_no_rows(documents, words):
    docs = documents([(i, " ".join(words(40 + i, i)) + "x" * 30 * (i % 3)) for i in range(40)], parts=5)
    kinds = [sorted(map(tuple, op.pack(docs, tokenizer_path(), 64, **given).drop("sequence_id", "offset").collect()))
             for given in ({}, {"long_run": 8}, {"broadcast_bytes": 0})]
    assert kinds[0] == kinds[1] == kinds[2]


def test_texts_longer_than_a_slice(documents, words, tokenizer):
    text = " ".join(words(200_000, 4))
    assert len(text) > 1 << 20
    packed = op.pack(documents([(1, text), (2, text)], 1), tokenizer_path()).orderBy("doc_id", "piece").collect()
    want = tokenizer.encode(text, add_special_tokens=False).ids + [op.END_ID]
    for doc in (1, 2):
        ids = [np.frombuffer(r["ids"], "<u4") for r in packed if r["doc_id"] == doc]
        assert np.concatenate(ids).tolist() == want and all(len(x) == 1024 for x in ids[1:])
