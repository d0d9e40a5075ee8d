import hashlib
import random

import pytest
from gridseries.llm import chat as op
from gridseries.llm import queries

SCHEMA = "conv_id long, message_id long, seq long, kind string, role string, text string, loss string, turns int"
NASTY = ["\\", "\n", ":", "###", "### ", "####  ", "<turn>", "</turn>", "\n</turn>\n", ":\n", "é", "😀", "<", "", "\\\\### Assistant: </turn> ok", "$1", "\r\n"]


def folded(events):
    """One event after the other."""
    out = {}
    logs = {}
    for e in set(events):
        if e[3] in op.KINDS:
            logs.setdefault(e[0], []).append(e)
    for conv, log in logs.items():
        log.sort(key=lambda e: (e[2] is not None, e[2] or 0, e[3], e[5] is not None, e[5] or ""))
        opened, role, text = {}, {}, {}
        for _, m, seq, kind, who, said in log:
            if kind == "message" and m not in opened:
                opened[m], role[m] = seq, who or ""
        for _, m, seq, kind, who, said in log:
            if m not in opened:
                opened[m], role[m] = seq, who or ""
        for _, m, seq, kind, who, said in log:
            text[m] = (text.get(m, "") if kind == "delta" else "") + (said or "")
        place = {m: (opened[m] is not None, opened[m] or 0, m is not None, m or 0) for m in opened}
        gone = {k for _, j, seq, kind, *_ in log if kind == "regenerate" and seq is not None for k in opened
                if place[j] < place[k] and opened[k] is not None and opened[k] < seq}
        kept = sorted(opened.keys() - gone, key=place.get)
        out[conv] = [(role[m], text[m]) for m in kept]
    return out


def rebuilt(spark, events):
    frame = spark.createDataFrame([(*e, "clash", 1) for e in events], SCHEMA).repartition(5)
    rows = op.read_back(op.format_conversations(frame)).collect()
    for r in rows:
        spans = [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss"]]
        assert [plain(s) for s in spans] == r["loss_texts"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
    return {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in rows}


def plain(text):
    out, it = "", iter(text)
    for c in it:
        out += next(it) if c == "\\" else c
    return out


def test_streams_edits_and_regenerations(spark):
    rng = random.Random(5)
    events = []
    for conv in range(60):
        # a third of all events is one conversation's
        for seq in range(400 if conv == 0 else rng.randint(1, 30)):
            m = rng.randint(0, 60 if conv == 0 else 5)
            kind = rng.choices(op.KINDS, [2, 6, 1, 0.4 if conv else 0.02])[0]
            events.append((conv, m, seq, kind, rng.choice(["user", "assistant", "system", None]) if kind == "message" else None,
                           None if kind == "regenerate" else "".join(rng.choices(NASTY, k=rng.randint(0, 4)))))
    events += events[:90]
    want = folded(events)
    assert rebuilt(spark, events) == want
    assert any(len(t) > 3 for t in want.values())


def test_discarded_branch(spark):
    log = [(1, 0, 0, "message", "user", "q"), (1, 1, 1, "message", "assistant", "dr"), (1, 1, 2, "delta", None, "aft"), (1, 2, 3, "message", "user", "thanks"),
           (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "bet"), (1, 1, 6, "delta", None, "ter"), (1, 3, 7, "message", "user", "fine"),
           (1, 0, 8, "edit", None, "question")]
    assert rebuilt(spark, log) == {1: [("user", "question"), ("assistant", "better"), ("user", "fine")]}


def test_odd_events(spark):
    log = [(None, None, None, "message", None, None), (None, None, 3, "delta", "x", "late"), (2, 0, 1, "other", "user", "no"), (2, 0, 1, None, "user", "no"),
           (3, 1, 5, "delta", "assistant", "only a delta"), (4, 1, 1, "delta", None, "b"), (4, 1, 1, "delta", None, "a"), (4, 1, 0, "message", "assistant", ""),
           (5, 1, 1, "message", "assistant", "x" * 300_000 + "\\</turn>"), (6, 2, 1, "message", "a:\n\\", "\\"), (6, 1, 1, "message", "b", "\n")]
    want = {None: [("", "late")], 3: [("assistant", "only a delta")], 4: [("assistant", "ab")], 5: [("assistant", "x" * 300_000 + "\\</turn>")],
            6: [("b", "\n"), ("a:\n\\", "\\")]}
    assert rebuilt(spark, log) == folded(log) == want
    assert op.format_conversations(spark.createDataFrame([], SCHEMA)).isEmpty()


@pytest.mark.parametrize("part", [1, 3, 4096])
def test_turns_become_logs_and_come_back(spark, part):
    rng = random.Random(part)
    turns = [(c, t, rng.choice(["user", "assistant", None, ":\n"]), "".join(rng.choices(NASTY, k=rng.randint(0, 9)))) for c in range(20) for t in range(5)]
    turns += [(7, 2, "user", "again"), (7, 2, "user", "again"), (None, 1, "user", None), (8, None, "user", "no turn"), (9, 2, "user", "\n\n"), (30, 0, "assistant", "y" * 20_000)]
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, copy int").repartition(3)
    back = op.read_back(op.format_conversations(op.events_of_turns(frame, part), ("turn", "copy"))).collect()
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in back}
    want = {}
    for c, t, role, text in sorted(turns, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == want


def test_query_reads_the_added_conversation_back(spark, tmp_path):
    spark.createDataFrame([(1, 0, "assistant", None)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = {r["conv_id"]: r for r in queries.op12_chat(spark, str(tmp_path)).collect()}
    text = "\\### Assistant: </turn> ok"
    digest = hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert set(rows) == {1, -7} and rows[-7]["turns_sha256"] == digest and rows[-7]["n_turns"] == 2
    assert rows[-7]["loss_chars"] == len(text) and rows[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert rows[1]["loss_chars"] == 0 and rows[1]["loss_sha256"] == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 1, 1, "message", "user", "x", "", 0)], SCHEMA)
    plan = op.read_back(op.format_conversations(frame))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2
