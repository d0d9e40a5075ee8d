import numpy as np
import pytest

from gridseries.llm import language as op
from llm_samples import ODD

SOUNDS = {"aa": ["th", "er", "ing", "on", "wh"], "bb": ["sch", "ei", "ung", "ö", "zu"], "cc": ["eau", "que", "é", "oi", "aux"]}


def text(lang, seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(SOUNDS[lang], rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def examples():
    return [(lang, text(lang, 10 * i + k).encode()) for k, lang in enumerate(SOUNDS) for i in range(30)]


@pytest.fixture(scope="module")
def net(examples):
    return op.train(examples, rounds=150)


def test_held_out_texts(net, documents):
    rows = [(i, text(list(SOUNDS)[i % 3], 1000 + i, 5 + 20 * i)) for i in range(30)]
    found = {r["doc_id"]: r for r in op.with_language(documents(rows), net).collect()}
    right = sum(found[i]["lang_pred"] == list(SOUNDS)[i % 3] for i in range(30))
    assert right >= 28 and all(0 <= r["score"] <= 1 for r in found.values())


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    gru = op.Gru.new(rng, 3)
    for name in ("table", "inner", "bias"):
        setattr(gru, name, getattr(gru, name).astype(np.float64))
    steps = rng.integers(97, 101, (5, 2))
    upstream = rng.normal(size=(5, 2, 3))
    kept = []
    gru.run(steps, kept)
    grads = gru.back(steps, kept, upstream)
    for name, grad, at in (("table", grads[0], (98, 4)), ("table", grads[0], (99, 8)), ("inner", grads[1], (1, 2)),
                           ("inner", grads[1], (2, 7)), ("bias", grads[2], (5,))):
        weights = getattr(gru, name)
        old, losses = weights[at], []
        for shift in (1e-2, -1e-2):
            weights[at] = old + shift
            losses.append(float((gru.run(steps).astype(np.float64) * upstream).sum()))
        weights[at] = old
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.03, abs=2e-3)


def test_all_bytes_count(net):
    """A long text's mean is that of its windows, wherever its batch cuts them."""
    long = (text("aa", 1, 3000) + " " + text("bb", 2, 3000)).encode()
    data = np.frombuffer(long + b"x", np.uint8)
    together = op.pooled(net, data, np.array([0, len(long), len(long), len(long) + 1]))
    parts = [op.pooled(net, data[a:b], np.array([0, b - a]))[0] * (b - a)
             for a, b in zip(range(0, len(long), op.STEPS), [*range(op.STEPS, len(long), op.STEPS), len(long)])]
    assert together[0] == pytest.approx(sum(parts) / len(long), rel=1e-4)
    assert together[1].tolist() == [0, 0, 0]


def test_odd_texts(net, documents):
    docs = documents(ODD)
    found = op.with_language(docs, net)
    assert found.columns == ["doc_id", "text", "spans", "lang_pred", "score"]
    by = [(r["doc_id"], r["lang_pred"], r["score"]) for r in found.collect()]
    assert {x[0] for x in by if x[1] == op.UNKNOWN} == {900, 901, 902, 903} and len(by) == len(ODD)
    assert all(s == 0 for _, lang, s in by if lang == op.UNKNOWN)


def test_without_labels_all_is_unknown(spark, documents):
    docs = documents(ODD)
    unlabelled = docs.selectExpr("*", "cast(null as string) lang")
    assert op.fit(unlabelled) is None
    assert {r["lang_pred"] for r in op.with_language(docs, None).collect()} == {"und"}
    assert op.with_language(docs.limit(0), None).isEmpty()


def test_training_sample_is_bounded(spark, documents):
    rows = [(i, text("aa" if i % 10 else "bb", i, 20)) for i in range(400)]
    labelled = documents(rows).selectExpr("text", "if(doc_id % 10 = 0, 'bb', 'aa') lang")
    chosen = op.training_windows(labelled, 25)
    assert sum(lang == "aa" for lang, _ in chosen) == 25 and 20 <= sum(lang == "bb" for lang, _ in chosen) <= 25
    assert chosen == op.training_windows(labelled.repartition(7), 25)
    one = op.train([("aa", b"some text of one language only")])
    assert one.languages == ["aa"] and op.pooled(one, np.frombuffer(b"abc", np.uint8), np.array([0, 3])).shape == (1, 1)


def test_every_label_is_learned_from_different_texts(spark, documents):
    labels = [f"l{k:03}" for k in range(230)]
    rows = [(i, text(list(SOUNDS)[i % 3], i, 8)) for i in range(690)]
    labelled = documents(rows).selectExpr("text", "concat('l', lpad(cast(doc_id % 230 as string), 3, '0')) lang")
    assert {lang for lang, _ in op.training_windows(labelled)} == set(labels)
    # one text very often, ten others once: each counts once, and none is missing
    often = [(i, text("aa", 5000 + max(0, i - 2990), 8)) for i in range(3000)]
    more = labelled.union(documents(often).selectExpr("text", "'often' lang"))
    chosen = op.training_windows(more, 25)
    found = [t for lang, t in chosen if lang == "often"]
    assert len(found) == len(set(found)) == 10 and set(found) == {t.encode() for _, t in often}
    assert op.train(chosen, rounds=1).languages == sorted([*labels, "often"])


def test_many_labels_have_fewer_excerpts_each(spark, documents, monkeypatch):
    monkeypatch.setattr(op, "MOST_TEXTS", 60)
    rows = [(i, text("aa", i, 8)) for i in range(2000)]
    chosen = op.training_windows(documents(rows).selectExpr("text", "cast(doc_id % 40 as string) lang"))
    assert len(chosen) == 40 and len({lang for lang, _ in chosen}) == 40


def test_pooled_is_the_network_step_by_step(net):
    """Every window of a text, one byte after the other in plain floats."""
    from math import exp, log, tanh

    def states(gru, data):
        hidden, h, out = gru.inner.shape[0], [0.0] * gru.inner.shape[0], []
        for byte in data:
            x = [float(a) + float(b) for a, b in zip(gru.table[byte], gru.bias)]
            gate = [0.5 + 0.5 * tanh(0.5 * (x[j] + sum(h[i] * float(gru.inner[i, j]) for i in range(hidden)))) for j in range(2 * hidden)]
            update, reset = gate[:hidden], gate[hidden:]
            new = [tanh(x[2 * hidden + j] + sum(reset[i] * h[i] * float(gru.inner[i, 2 * hidden + j]) for i in range(hidden))) for j in range(hidden)]
            h = [a + u * (b - a) for a, u, b in zip(h, update, new)]
            out.append(h)
        return out

    for whole in (b"x", text("bb", 3, 20).encode(), text("cc", 4, 9).encode() + bytes(range(256))):
        total = [0.0] * len(net.languages)
        for at in range(0, len(whole), net.steps):
            window = whole[at:at + net.steps]
            padded = window.ljust(net.steps)
            ahead, behind = states(net.ahead, padded), states(net.behind, padded[::-1])[::-1]
            for a, b in list(zip(ahead, behind))[:len(window)]:
                logits = [float(net.out_bias[k]) + sum(v * float(net.out[i, k]) for i, v in enumerate(a + b)) for k in range(len(total))]
                norm = log(sum(exp(z) for z in logits))
                total = [t + z - norm for t, z in zip(total, logits)]
        got = op.pooled(net, np.frombuffer(whole, np.uint8), np.array([0, len(whole)]))[0]
        assert got == pytest.approx([t / len(whole) for t in total], rel=1e-4, abs=1e-5)


def test_training_takes_windows_from_all_over_a_text(spark):
    long = "".join(f"{i:04}abcdef" for i in range(9000))
    rows = [("aa", long), ("aa", long), ("bb", "short é text"), ("bb", "é" * 2000), ("cc", None), (None, "no label")]
    found = op.training_windows(spark.createDataFrame(rows, "lang string, text string"), windows_each=6)
    own = [w for lang, w in found if lang == "aa"]
    places = [long.encode().find(w) for w in own]
    # one window in each sixth of the text, and whole short texts
    assert [p // (len(long) // 6) for p in places] == list(range(6)) and all(len(w) == op.STEPS for w in own)
    assert ("bb", "short é text".encode()) in found and len(found) == 6 + 1 + 6


def test_ties_and_very_long_texts(net, documents):
    flat = op.Network(["x", "y"], net.ahead, net.behind, np.zeros((2 * op.HIDDEN, 2), np.float32), np.zeros(2, np.float32))
    rows = [(1, "any text"), (2, text("aa", 5) * 9000), (2, text("aa", 5) * 9000)]
    assert len(rows[1][1]) > 1 << 20
    # equal chances: the first label in alphabetical order
    assert {(r["lang_pred"], r["score"]) for r in op.with_language(documents(rows), flat).collect()} == {("x", 0.5)}
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in op.with_language(documents(rows), net).collect()}
    assert len(found) == 2 and (2, "aa") in {f[:2] for f in found}
