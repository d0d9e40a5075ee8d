"""A Merkle manifest of a dataset, with a proof and a verified version for every row.

Rows are leaves of one binary tree per group, in a fixed order; the roots of the groups, in order of the group,
are the leaves of one more tree. Every two consecutive nodes become their parent, the SHA-256 of their hex
digests; a last node without partner is hashed alone.

Leaves are numbered by range partitions and dealt to aligned blocks of 2^`BLOCK_BITS`. A task builds a block's
levels and hands up its root; the roots are the leaves of the next tier, until each group has one node. Then
paths are handed down: a block receives the siblings above it from the block above, so every leaf's proof is
complete where the leaf is, and no node has to meet all leaves in one place.

Trees are persistent. A leaf with another digest is a new version of its block, which copies only the leaf's
ancestors and shares all other nodes; above the block the version goes on along the path that was handed down.
A version is held against the root of the manifest.

Defined cases: a null is a field of its own, distinct from empty text; null groups form a group, the first;
rows of equal order are ordered by their leaf; repeated rows are leaves of their own; a null order value comes
first; a group of one row has its leaf as root, a table of one group that group's root; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.grouped import key_runs
from gridseries.llm.tables import stored
from gridseries.operators.numbering import with_position

BLOCK_BITS = 12
# a path has one entry of this width for each level: l or r and the sibling on that side, or - without sibling
ENTRY = 65
ALONE = "-" * ENTRY


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """UTF-8 length, colon and value as text; - if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


class Block:
    """The nodes of an aligned block: levels of digests, leaves first."""

    def __init__(self, digests: list[str], height: int):
        self.levels = [digests]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i:i + 2])) for i in range(0, len(below), 2)])

    def node(self, level: int, index: int) -> str:
        return self.levels[level][index]

    def path(self, index: int) -> list[str]:
        """The entries from a leaf up to the root of the block."""
        out = []
        for level in self.levels[:-1]:
            other = index ^ 1
            out.append(("l" if index & 1 else "r") + level[other] if other < len(level) else ALONE)
            index >>= 1
        return out

    def version(self, index: int, changed: str) -> Version:
        return Version(self, index, changed)


class Version:
    """A block in which one leaf differs: the copied nodes from that leaf up, all others shared with the block."""

    def __init__(self, base: Block, index: int, changed: str):
        self.base, self.index = base, index
        self.copied = folded(changed, base.path(index))

    def node(self, level: int, index: int) -> str:
        return self.copied[level] if index == self.index >> level else self.base.node(level, index)


def folded(start: str, path: list[str]) -> list[str]:
    """The nodes along a path, the start first."""
    nodes = [start]
    for entry in path:
        below = nodes[-1]
        nodes.append(digest(entry[1:] + below if entry[0] == "l" else below + entry[1:] if entry[0] == "r" else below))
    return nodes


def _height(total: int, bits: int) -> int:
    return min(bits, (total - 1).bit_length())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """The rows of each block together; a block is bounded."""
    now, held = None, []
    for key, part in key_runs(batches, ["tree", "block"]):
        if held and key != now:
            yield now, held
            held = []
        now = key
        held.append(part)
    if held:
        yield now, held


def _column(parts: list[pa.RecordBatch], name: str) -> list:
    return [x for p in parts for x in p.column(name).to_pylist()]


def _dealt(rows: DataFrame) -> DataFrame:
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "tree", "block").sortWithinPartitions("tree", "block", "slot")


def _in_blocks(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumns({"block": F.shiftright("position", bits), "slot": F.col("position") - F.shiftleft(F.shiftright("position", bits), bits)})


def _climbed(nodes: DataFrame, bits: int) -> DataFrame:
    """The roots of the blocks of all trees with several nodes, as nodes of the next tier."""
    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), parts in _blocks(batches):
            total = parts[0].column("total")[0].as_py()
            top = Block(_column(parts, "digest"), _height(total, bits)).levels[-1][0]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.string()), pa.array([block], pa.int64()), pa.array([-(-total >> bits)], pa.int64()), pa.array([top])],
                                             ["tree", "position", "total", "digest"])

    rows = _in_blocks(nodes.where("total > 1").select("tree", "position", "total", "digest"), bits)
    return _dealt(rows).mapInArrow(roots, "tree string, position long, total long, digest string")


def _tiers(nodes: DataFrame, most: int, bits: int) -> list[DataFrame]:
    tiers = [nodes]
    while most > 1:
        tiers.append(stored(_climbed(tiers[-1], bits), "merkle"))
        most = -(-most >> bits)
    return tiers


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """tree, tier, digest of the root of each tree."""
    return reduce(DataFrame.unionByName, (t.where("total = 1").select("tree", F.lit(k).alias("tier"), "digest") for k, t in enumerate(tiers)))


def _handed_down(nodes: DataFrame, above: DataFrame, bits: int, payload: str = "", versions: bool = False) -> DataFrame:
    """For each node its digest, path, subroot and root; or with `versions` its proof, its version's copied nodes and their root.

    above has tree, block, path, subroot and root of each block; payload names columns of the nodes that are kept.
    """
    kept = [c.split()[0] for c in payload.split(", ") if c]
    schema = ", ".join(x for x in ("tree string, block long, digest string", payload, "proof string, version string, folded_root string" if versions else "path string",
                                   "subroot string, root string") if x)
    texts = [c for c in ("proof", "version", "folded_root", "path", "subroot", "root") if f"{c} string" in schema]

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), parts in _blocks(batches):
            head, *rest = _column(parts, "path")
            subroot, root = parts[0].column("subroot")[0].as_py(), parts[0].column("root")[0].as_py()
            upper = [head[i:i + ENTRY] for i in range(0, len(head), ENTRY)]
            rows = pa.Table.from_batches(parts).slice(1)
            found = {name: [] for name in texts}
            if rows.num_rows:
                block = Block(rows["digest"].to_pylist(), _height(rows["total"][0].as_py(), bits))
                for slot, changed in enumerate(rows["changed"].to_pylist()):
                    path = block.path(slot) + upper
                    if versions:
                        version = block.version(slot, changed or block.node(0, slot)).copied
                        version += folded(version[-1], upper)[1:]
                        found["proof"].append("".join(entry[1:] for entry in path if entry != ALONE))
                        found["version"].append("".join(version) if changed else None)
                        found["folded_root"].append(version[-1])
                    else:
                        found["path"].append("".join(path))
                    found["subroot"].append(subroot)
                    found["root"].append(root)
            out = rows.select(["tree", "position", "digest", *kept]).rename_columns(["tree", "block", "digest", *kept])
            for name in texts:
                out = out.append_column(name, pa.array(found[name], pa.string()))
            yield from out.combine_chunks().to_batches()

    rows = nodes if "changed" in nodes.columns else nodes.withColumn("changed", F.lit(None).cast("string"))
    rows = _in_blocks(rows.select("tree", "position", "total", "digest", "changed", *kept), bits)
    both = above.withColumn("slot", F.lit(-1).cast("long")).unionByName(rows, allowMissingColumns=True)
    return _dealt(both).mapInArrow(descend, schema)


def _above(tiers: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """tree, block, path, subroot, root of the blocks of the lowest tier; tops has tree, tier, path, subroot, root."""
    handed = None
    for k in reversed(range(len(tiers))):
        own = tops.where(F.col("tier") == k).select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        handed = own if handed is None else own.unionByName(handed)
        if k:
            handed = _handed_down(tiers[k], handed, bits).drop("digest")
    return handed


def manifest(leaves: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """id, leaf, subroot, root, proof, version, folded_root for every row of leaves.

    leaves: tree (the group, text), id (a whole number, by which a tree is ordered), leaf, changed (the digest of the
    leaf in a version of its own, or null). proof has the siblings' digests from the leaf to the root, left out where
    there is none; version the digests of all copied nodes from the changed leaf to the version's root, null without change;
    folded_root is the root that the changed leaf, or else the leaf, makes with the siblings.
    """
    rows = leaves.select(F.col("tree").cast("string"), F.col("id").cast("long"), "leaf", "changed")
    placed = with_position(stored(rows, "leaves"), ["tree", "id", "leaf"])
    sizes = placed.groupBy(F.col("tree").alias("name")).agg(F.min("position").alias("first"), F.count("*").alias("total"))
    most = sizes.agg(F.max("total")).first()[0] or 0
    nodes = placed.join(sizes, F.col("tree").eqNullSafe(F.col("name"))).select(
        "tree", (F.col("position") - F.col("first")).alias("position"), "total", F.col("leaf").alias("digest"), "changed", "id")
    tiers = _tiers(nodes, most, bits)

    groups = with_position(_tops(tiers).select(F.col("tree").alias("name"), "tier", "digest"), ["name"])
    number = groups.count()
    roots = groups.select(F.lit(None).cast("string").alias("tree"), "position", F.lit(number).cast("long").alias("total"), "digest", "name", "tier")
    higher = _tiers(roots, number, bits)
    top = _tops(higher).select("tree", "tier", F.lit("").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    found = _handed_down(roots, _above(higher, top, bits), bits, "name string, tier int")
    tops = stored(found.select(F.col("name").alias("tree"), "tier", "path", F.col("digest").alias("subroot"), "root"), "roots")

    proved = _handed_down(nodes, _above(tiers, tops, bits), bits, "id long", versions=True)
    return proved.select("id", F.col("digest").alias("leaf"), "subroot", "root", "proof", "version", "folded_root")
