"""Near-duplicate classes by BagMinHash signatures, bands, and verified multiset overlap.

A document is the multiset of its runs of `SHINGLE` words (A-Z lower-cased); one of fewer words has a
single run. Two documents are linked if sum(min) / sum(max) of their multisets is at least THRESHOLD;
classes are the connected components of the links. A class is named by its smallest doc_id.

1. Equal texts are one node. Each node gets a weighted signature of BANDS x ROWS components; nodes
   that agree in all components of a band share a bucket.
2. First links: each node is verified against one member of each of its buckets, the one with the
   fullest buckets altogether, which in a group of copies is the original. No pairs are formed
   otherwise, so this grows with the nodes.
3. Where a bucket still holds several components, the missing links are found exactly: a prefix-filter
   join (a node's rarest shingles, as many as the two sizes allow, rarity counted over these nodes) of
   every node of a smaller component with the nodes of larger ones. Shingles of a single node form no
   pairs, and a node without links has little else in its prefix.

A pair of similarity s meets in some bucket with probability 1 - (1 - s^ROWS)^BANDS: 0.99995 at 0.8.
Nothing is capped. Shingles are compared by 64-bit hashes, texts by 128 bits: a node is named by one hash of its
text, and where a second one shows that texts share the first, all but one of them get other names.

Defined cases: a document without words (null, empty, signs only) is linked to nothing and is its own
class, also if repeated; repeated rows are one class; a null doc_id never names a class unless all of
the class are null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.bagminhash import bags, signatures
from gridseries.llm.decontaminate import WORD_BYTE
from gridseries.llm.flat import LOWER, flatten, mix, powers, prefix_hash, repeat_ranges, slices, span_hash, word_spans
from gridseries.llm.tables import set_aside, stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
STEP = 1 << 20


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every run of `size` words, repeats included."""
    data, offsets = flatten(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTE)
    words = span_hash(prefix_hash(low), starts, ends)
    n = np.diff(first)
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), runs)
    begin = repeat_ranges(first[:-1], runs)
    end = np.minimum(begin + size, first[1:][row])
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return row, mix((sums[end] - sums[begin]) * down[begin])


def _raw() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _check() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.lit(1), F.length("text"))


def _id() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))


def _signed(documents: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, raw and check (hashes of the text), n_shingles, and the bucket keys of all bands (null without words)."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text", STEP):
            row, hashes = shingles(batch.column("text"))
            n = batch.num_rows
            owner, elements, weights = bags(row, hashes)
            best = signatures(n, owner, elements, weights, bands * rows)
            values = mix(best.view(np.uint64)).reshape(n, bands, rows)
            keys = np.broadcast_to(mix(np.arange(1, bands + 1).astype(np.uint64)), (n, bands))
            for k in range(rows):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ values[:, :, k])
            count = np.bincount(row, minlength=n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * bands, bands), pa.int32()),
                                             pa.array(np.ascontiguousarray(keys).view(np.int64).ravel()))
            lists = pc.if_else(pa.array(count > 0), lists, pa.nulls(n, lists.type))
            keys_ = [batch.column(c) for c in ("doc_id", "raw", "check")]
            yield pa.RecordBatch.from_arrays([*keys_, pa.array(count, pa.int64()), lists], ["doc_id", "raw", "check", "n_shingles", "buckets"])

    rows_ = documents.select(F.col("doc_id").cast("long"), "text", _raw().alias("raw"), _check().alias("check"))
    return rows_.mapInArrow(scan, "doc_id long, raw long, check long, n_shingles long, buckets array<long>")


def _named(signed: DataFrame) -> DataFrame:
    """With `node`, a name of the text that no other text has."""
    shared = signed.groupBy("raw").agg(F.min("check").alias("main"), F.max("check").alias("other")).where("main <> other")
    shared = stored(shared.select("raw", "main"), "shared")
    # hardly ever any
    if shared.isEmpty():
        return signed.withColumn("node", F.col("raw"))
    own = F.col("main").isNull() | (F.col("check") == F.col("main"))
    return stored(signed.join(shared, "raw", "left").withColumn("node", F.when(own, F.col("raw")).otherwise(F.xxhash64("raw", "check"))).drop("main"), "named")


def _bags_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, size, and its multiset as sorted 64-bit items, the k-th occurrence of a shingle being an item of its own."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text", STEP):
            row, hashes = shingles(batch.column("text"))
            owner, elements, counts = bags(row, hashes)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            items = mix(np.repeat(elements, counts) + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            owner = np.repeat(owner, counts)
            order = np.lexsort((items, owner))
            parts = np.split(items[order], np.searchsorted(owner[order], np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["node", "size", "items"])

    # one row of each node by its id, so that the many copies of a text do not meet
    texts = documents.select("text", _raw().alias("raw"), _check().alias("check"), _id().alias("id")).join(nodes, ["raw", "check", "id"])
    texts = texts.dropDuplicates(["node", "id"])
    return texts.select("node", "text").mapInArrow(scan, "node long, size long, items binary")


def _verified(pairs: DataFrame, bags_: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose multisets overlap enough."""
    left = bags_.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("items").alias("items_a"))
    right = bags_.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("items").alias("items_b"))

    def check(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
                common = int((y[at] == x).sum()) if len(y) else 0
                good.append(common >= threshold * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    # sizes too far apart cannot reach the threshold
    sized = pairs.join(left, "a").join(right, "b").where(F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b"))
    return sized.select("a", "b", "items_a", "items_b").mapInArrow(check, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of each component; of nodes that have links.

    Labels pass along links and then along themselves until nothing changes; rounds follow the logarithm
    of the longest path.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    labels = stored(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = lower.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        new = stored(new, "labels")
        if new.where("old <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _prefixes(bags_: DataFrame, threshold: float) -> DataFrame:
    """node, item, place, size: the rarest items of each node, of which it must share one with any it is linked to.

    `place` is the item's place in the node's order of rarity; a pair's own sizes say how far down it counts.
    """
    rows = bags_.select("node", "items")

    def unpack(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for node, items in zip(batch.column("node"), batch.column("items")):
                x = np.frombuffer(items.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), node.as_py()), pa.int64()), pa.array(x)], ["node", "item"])

    items = rows.mapInArrow(unpack, "node long, item long")
    # stored, so that the join has a shuffle of its own, in which a very common item can be split
    often = stored(items.groupBy("item").agg(F.count("*").alias("n")).where("n > 1"), "often")
    # items that only one node has come first in every order and never make a pair, but they fill the prefix
    shared = items.join(often, "item").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("shared"))
    length = F.col("size") - F.ceil(F.col("size") * threshold) + 1
    kept = shared.join(bags_.select("node", "size"), "node").withColumn("length", length - (F.col("size") - F.size("shared")))
    kept = kept.where("length > 0").select("node", "size", (F.col("size") - F.size("shared")).alias("alone"),
                                           F.posexplode(F.slice("shared", F.lit(1), F.col("length").cast("int"))).alias("at", "x"))
    return kept.select("node", F.col("x.item").alias("item"), (F.col("alone") + F.col("at")).alias("place"), "size")


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, raw and check (of the text), class_id, n_members, n_shingles."""
    signed = _named(stored(_signed(documents, bands, rows), "signed"))
    nodes = signed.where(F.col("buckets").isNotNull()).groupBy("node").agg(
        F.first("buckets").alias("buckets"), F.min(_id()).alias("id"), F.min("raw").alias("raw"), F.min("check").alias("check"))
    members = nodes.select("node", F.explode("buckets").alias("bucket"))
    full = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(full, "bucket"), "members")
    score = members.groupBy("node").agg(F.sum("n").alias("score"))
    placed = members.select("bucket", "node").join(score, "node")
    centre = placed.groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("top")).select("bucket", F.col("top.node").alias("centre"))
    pairs = members.join(centre, "bucket").where("node <> centre")
    pairs = pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    bags_ = stored(_bags_of(documents, nodes.join(score, "node", "left_semi").select("node", "id", "raw", "check")), "bags")
    links = stored(_verified(pairs, bags_, threshold), "links")
    first = components(links)

    # buckets with several components: the missing links, exactly
    label = F.coalesce("label", "node")
    grouped = score.select("node").join(first, "node", "left").select("node", label.alias("label"))
    sizes = grouped.groupBy("label").agg(F.count("*").alias("n"))
    grouped = stored(grouped.join(sizes, "label").select("node", F.struct("n", "label").alias("part")), "parts")
    within = members.select("bucket", "node").join(grouped, "node")
    mixed = within.groupBy("bucket").agg(F.max("part").alias("largest"), F.min("part").alias("smallest")).where("largest <> smallest")
    open_ = within.join(mixed, "bucket").groupBy("node", "part").agg(F.max(F.col("part") < F.col("largest")).alias("smaller"))
    open_ = stored(open_, "open")
    prefix = _prefixes(bags_.join(open_.select("node"), "node", "left_semi"), threshold).join(open_, "node")
    prefix = stored(prefix, "prefix")
    left, right = (prefix.where(which).select("item", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "part", "place", "size")])
                   for which, s in (("smaller", "a"), ("true", "b")))
    # the overlap that a pair of these sizes needs: beyond it, an item comes too late in the order to be the first one shared
    needed = F.ceil(threshold / (1 + threshold) * (F.col("size_a") + F.col("size_b")) - 1e-9)
    early = (F.col("place_a") <= F.col("size_a") - needed) & (F.col("place_b") <= F.col("size_b") - needed)
    missed = left.join(right, "item").where((F.col("part_a") < F.col("part_b")) & early)
    missed = missed.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = _verified(missed, bags_, threshold)
    labels = components(links.union(more))

    found = signed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # documents without words stay alone
    worded = found.where("n_shingles > 0")
    # stored, so that the join has a shuffle of its own, in which a large class can be split
    classes = stored(worded.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_members")), "classes")
    result = worded.join(classes, "label").select("doc_id", "raw", "check", "class_id", "n_members", "n_shingles")
    alone = found.where("n_shingles = 0").select("doc_id", "raw", "check", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_members"), "n_shingles")
    return result.union(alone)


def one_of_each(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with one row of each class, that of the smallest doc_id; all columns stay as they are."""
    documents, restore = set_aside(documents, "doc_id", "text")
    classes = near_duplicates(documents, threshold).where(F.col("n_shingles") > 0)
    stays = F.col("doc_id").eqNullSafe(F.col("class_id"))
    other = [F.col("doc_id").alias("_id"), F.col("raw").alias("_other"), F.col("check").alias("_second")]
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_raw") == F.col("_other")) & (F.col("_check") == F.col("_second"))
    gone = classes.where(~stays).select(*other).distinct()
    kept = documents.withColumns({"_raw": _raw(), "_check": _check()}).join(gone, same, "left_anti")
    # rows that repeat the one that stays: rare, and looked for among ids only
    again = classes.where(stays).groupBy("doc_id", "raw", "check").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():
        again = again.select(*other)
        once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "_raw", "_check"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return restore(kept)
