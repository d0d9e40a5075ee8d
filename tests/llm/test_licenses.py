import math
import textwrap
from collections import Counter

import pytest

from gridseries.llm import licenses as op

APACHE, MIT, GPL = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", op.TEMPLATES[14][1]
BODY = "some words about rivers and hills that go on and on. "


def files(spark, rows):
    return spark.createDataFrame([(i, path, text, "x") for i, (path, text) in enumerate(rows)],
                                 "id long, path string, text string, license string").repartition(3)


def scan(spark, rows):
    return {r["id"]: r for r in op.scan_licenses(files(spark, rows)).collect()}


def test_own_and_inherited(spark):
    rows = [
        ("a/LICENSE", f"{MIT}\n"), ("a/b/c/one.txt", BODY), ("a/b/LICENSE", APACHE), ("a/two.txt", BODY * 2), ("c/three.txt", BODY),
        ("a/b/four.txt", BODY + "\n" + GPL), ("a/b/d/head.txt", APACHE + "\n" + BODY * 20), ("a/b/d/five.txt", BODY), ("six.txt", BODY),
        (None, BODY), ("a/b/c/null.txt", None), ("a/b/c/empty.txt", ""), ("a/b/c/one.txt", BODY)]
    found = scan(spark, rows)
    got = [(found[i]["license"], found[i]["via"], found[i]["licensed_by"]) for i in range(len(rows))]
    assert got == [
        ("MIT", "own", "a/LICENSE"), ("Apache-2.0", "inherited", "a/b/LICENSE"), ("Apache-2.0", "own", "a/b/LICENSE"),
        ("MIT", "inherited", "a/LICENSE"), (None, None, None), ("GPL-2.0", "own", "a/b/four.txt"), ("Apache-2.0", "own", "a/b/d/head.txt"),
        # a header licenses its own file only
        ("Apache-2.0", "inherited", "a/b/LICENSE"), (None, None, None), (None, None, None), ("Apache-2.0", "inherited", "a/b/LICENSE"),
        ("Apache-2.0", "inherited", "a/b/LICENSE"), ("Apache-2.0", "inherited", "a/b/LICENSE")]


def test_the_root_and_ties(spark):
    rows = [("LICENSE", MIT), ("COPYING", APACHE), ("x/y/one.txt", BODY)]
    # equal cosines: the smallest path, whatever its length or the order of ids
    assert scan(spark, rows)[2]["license"] == scan(spark, rows[::-1])[0]["license"] == "Apache-2.0"
    rows = [("aa/LICENSE", MIT), ("aa/LICENSE", APACHE), ("aa/LICENSE", APACHE), ("aa/one.txt", BODY)]
    # one path: the smallest id, also where rows repeat
    assert [scan(spark, rows)[3]["license"], scan(spark, [rows[1], rows[0], rows[2], rows[3]])[3]["license"]] == ["MIT", "Apache-2.0"]


def test_cosine_is_brute_force():
    matcher = op.Matcher({"the": 50, "license": 5, "under": 20}, 60)

    def vector(text):
        n = 60 + len(op.TEMPLATES)
        df = Counter(t for _, x in op.TEMPLATES for t in set(op.terms(x)))
        df.update({t: {"the": 50, "license": 5, "under": 20}[t] for t in ("the", "license", "under") if t in df})
        return {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(op.terms(text)).items()}

    def cosine(a, b):
        return sum(w * b.get(t, 0) for t, w in a.items()) / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))

    for text in (APACHE, "Under the license of mountains", GPL[:100], "Licensed under CC BY 4.0 or later"):
        name, score = matcher.best(text)
        best = max(cosine(vector(text), vector(t)) for _, t in op.TEMPLATES)
        assert score == pytest.approx(best)
        assert any(name == n and cosine(vector(text), vector(t)) == pytest.approx(best) for n, t in op.TEMPLATES)


def test_every_template_is_its_own_best():
    matcher = op.Matcher({}, 0)
    assert all(matcher.scan(text)[0] == name for name, text in op.TEMPLATES if op.passages(text))
    assert matcher.scan("The license of poets is to bend words.")[0] is None and matcher.scan("")[0] is None
    assert matcher.scan(BODY * 50 + "\n" + APACHE.upper())[0] == "Apache-2.0"


def test_empty_table(spark):
    assert op.scan_licenses(files(spark, [("a", "b")]).limit(0)).isEmpty()


def full(name):
    return next(text for known, text in op.FULL_TEXTS if known == name)


def commented(text, mark, width=60):
    """Wrapped at `width` columns, each line behind a comment mark."""
    return "\n".join(f"{mark} {line}".rstrip() for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""])


NOTICES = [("MIT", full("MIT")), ("BSD-2-Clause", full("BSD-2-Clause")), ("BSD-3-Clause", full("BSD-3-Clause")), ("ISC", full("ISC")),
           ("Apache-2.0", op.TEMPLATES[1][1]), ("GPL-2.0", GPL), ("GPL-3.0", op.TEMPLATES[16][1]), ("MIT", op.TEMPLATES[20][1])]


@pytest.mark.parametrize("mark", ["", "#", "//", " *", "--", "dnl"])
def test_wrapped_headers(mark):
    matcher = op.Matcher({}, 0)
    code = "\n".join(f"value_{i} = compute_{i}(left_{i}, right_{i})" for i in range(200))
    for name, notice in NOTICES:
        for owner in ("", "Copyright (c) 2019, Jane Roe and the other authors\nAll rights reserved.\n\n"):
            text = commented(owner + notice, mark)
            text = f"/*\n{text}\n */" if mark == " *" else text
            found = matcher.scan(f"{text}\n\n{code}\n")
            # all of the notice counts, which is less than most of the file
            words = len(op.terms(notice))
            assert found[0] == name and words * 0.9 / (words + 820) <= found[2] < op.FILE_SHARE, (name, mark, found)
            alone = matcher.scan(text)
            assert alone[0] == name and alone[2] >= 0.8, (name, mark, alone)


def test_header_block():
    assert op.header_end("#!/bin/sh\n# one\n\n# two\ncode\n# three") == len("#!/bin/sh\n# one\n\n# two\n")
    assert op.header_end("/* one\n two\n */\ncode") == len("/* one\n two\n */\n")
    assert op.header_end("/* one */\ncode") == len("/* one */\n")
    assert op.header_end("one\ntwo\n\nthree") == len("one\ntwo\n") and op.header_end("") == 0 and op.header_end("one") == 3


def test_full_texts_license_their_directories(spark):
    rows = []
    for k, (name, text) in enumerate(op.FULL_TEXTS):
        rows += [(f"d{k}/LICENSE", f"Copyright (c) 2020 Jane Roe\n\n{text}"), (f"d{k}/src/one.txt", BODY)]
    found = scan(spark, rows)
    for k, (name, _) in enumerate(op.FULL_TEXTS):
        assert (found[2 * k]["license"], found[2 * k]["via"]) == (name, "own")
        assert (found[2 * k + 1]["license"], found[2 * k + 1]["licensed_by"]) == (name, f"d{k}/LICENSE")


def test_matched_words_are_a_union():
    """Two statements apart from each other, neither of which is most of the file."""
    matcher = op.Matcher({}, 0)
    name, _, share = matcher.scan(f"{APACHE}\nrivers hills\nsome words\nThis notice stands for all files:\n{op.TEMPLATES[0][1]}")
    assert name == "Apache-2.0" and share >= 12 / 24
    assert matcher.scan(f"All rights reserved.\n{BODY}\n{MIT}")[0] == "MIT"
    assert matcher.scan(BODY * 30)[0] is None


def test_runs_are_maximal_scoring_ranges():
    matcher = op.Matcher({}, 0, [("x", "a b c d e f g h")])
    assert matcher.runs("a b c d e f g h".split()) == [(0, 8)]
    assert matcher.runs("z z a b c d q e f g h z z z z z z z a b c d e".split()) == [(2, 11), (18, 23)]
    assert matcher.runs("a b c".split()) == [] and matcher.runs([]) == []
