import hashlib
import random

import pytest

from gridseries.llm import merkle as op
from gridseries.llm import queries

SCHEMA = "tree string, id long, leaf string, changed string, root string, position long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rooted(leaves):
    """The root of a list of digests, and the siblings of every leaf."""
    level, proofs, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            if place ^ 1 < len(level):
                proofs[i].append((place & 1, level[place ^ 1]))
            else:
                proofs[i].append((0, ""))
            at[i] = place >> 1
        level = [h("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return level[0], proofs


def brute_force(rows):
    trees = {}
    for tree, i, leaf, changed in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        trees.setdefault(tree, []).append((i, leaf, changed))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    subroots = {t: rooted([leaf for _, leaf, _ in trees[t]]) for t in names}
    root, uppers = rooted([subroots[t][0] for t in names])
    out = []
    for t, upper in zip(names, uppers):
        for (i, leaf, changed), lower in zip(trees[t], subroots[t][1]):
            nodes = [changed or leaf]
            for right, other in lower + upper:
                nodes.append(h(other + nodes[-1] if right else nodes[-1] + other))
            out.append((i, leaf, subroots[t][0], root, "".join(o for _, o in lower + upper), "".join(nodes) if changed else None, nodes[-1]))
    return sorted(out, key=str)


def proved(spark, rows, bits):
    frame = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in op.manifest(frame, bits).select("id", "leaf", "subroot", "root", "proof", "version", "folded_root").collect()), key=str)


def leaves(tree, n, seed=0):
    rng = random.Random(f"{tree}{seed}")
    return [(tree, i * 3, h(f"{tree}{i}"), h(f"other {tree}{i}") if rng.random() < 0.3 else None) for i in range(n)]


@pytest.mark.parametrize("bits", [2, 12])
def test_roots_proofs_and_versions(spark, bits):
    # several tiers of blocks, a lone leaf, full and ragged trees, more groups than a small block holds
    rows = leaves("en", 137) + leaves("de", 64) + leaves("", 5) + leaves(None, 9) + leaves("é", 1) + leaves("zz", 2)
    got = proved(spark, rows, bits)
    assert got == brute_force(rows)
    assert any(r[5] for r in got) and all((r[6] == r[3]) == (r[5] is None) for r in got)


def test_repeats_ties_and_nulls(spark):
    rows = leaves("a", 6) + leaves("a", 6) + [("a", None, h("x"), None), ("a", None, h("y"), h("z")), ("a", 0, h("same id"), None)]
    assert proved(spark, rows, 1) == brute_force(rows)


def test_one_row_and_none(spark):
    rows = [("a", 1, h("x"), h("y"))]
    assert proved(spark, rows, 12) == brute_force(rows) == [(1, h("x"), h("x"), h("x"), "", h("y"), h("y"))]
    assert op.manifest(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_versions_share_all_but_the_ancestors():
    base = op.Block([h(str(i)) for i in range(11)], 4)
    before = [list(level) for level in base.levels]
    version = base.version(6, h("new"))
    other = op.Block([h(str(i)) if i != 6 else h("new") for i in range(11)], 4)
    assert [[version.node(k, i) for i in range(len(level))] for k, level in enumerate(other.levels)] == other.levels
    assert base.levels == before and len(version.copied) == 5


def test_query_on_odd_documents(spark, tmp_path):
    rows = [(1, "a|b", "s", "en", 3, "x"), (None, None, None, None, None, 1.0), (2, "", "", "", (1 << 63) - 1, "x"), (2, "", "", "", (1 << 63) - 1, "x"),
            (3, "é" * 100_000, "s", "en", None, None), *((i, "t", "s", "en", 1, None) for i in range(10, 40))]
    frame = spark.createDataFrame(rows[0:0], "doc_id long, text string, source string, lang string, n_chars long, root string")
    frame = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], str(r[5])) for r in rows], frame.schema)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_manifest(spark, str(tmp_path)).collect()

    def leaf(r, more=0):
        values = [r[0], r[2], r[3], r[4] if r[4] is None else r[4] + more, r[1]]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    import zlib
    want = brute_force([(r[3], r[0], leaf(r), leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else None) for r in rows])
    assert sorted((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, own, sub, root, h(proof), folded, folded == root) for i, own, sub, root, proof, _, folded in want if i is not None)
    assert len(got) == len(rows) and {r["verified"] for r in got} == {True, False}
