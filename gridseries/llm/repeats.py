"""Removal of repeated passages by merged Burrows-Wheeler transforms.

A byte goes when a string of `length` bytes that covers it also starts anywhere else in the corpus. The
length is a parameter, a multiple of LEVELS; a minimizer's strings and the blocks have a quarter of it.

1. Every window of `length` bytes has a minimizer: the smallest hash of its quarter-length strings, leftmost
   on ties. Consecutive windows with one minimizer are a run, the bytes they span its content. Equal
   windows have equal minimizers, and no two windows of a run are equal.
2. Runs are counted by (minimizer, content), so that copies are looked at once. A content that occurs
   once, and alone under its minimizer, shares no window with anything and needs nothing else.
3. All other contents are dealt to buckets by minimizer, each once and with its count, so that all strings
   that can share a window meet. Whole minimizers of a bucket are merged at a time, cut into shards. Each shard gets its own suffix order and
   Burrows-Wheeler transform over blocks. The transforms are then merged: the interleave of the shards, at
   first one after the other, is refined LEVELS times; a pass deals every slot to its preceding block, in order,
   and splits the groups of equal prefixes. The suffixes themselves are not sorted again. What is still
   together at the end shares all blocks; a group whose slots count two or more is a repeated interval.
4. Repeated intervals go back to all places of their content, and to the documents by a key of the text.

A minimizer with more than MOST_CONTENTS contents is not given to one task: its windows are counted
one by one by (minimizer, place, hash), with partial sums before the shuffle. That is exact as well.

Contents, blocks and windows are compared by 64-bit hashes among strings of one minimizer or bucket,
texts by 128 bits. Nulls count as empty; texts under `length` bytes hold no window; repeated rows are
repeats of each other; an empty table gives no rows; extra columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.flat import flatten, prefix_hash, slices, span_hash
from gridseries.llm.tables import stored

LENGTH = 400
LEVELS = 4
SHARD_BYTES = 1 << 15
MERGE_BYTES = 1 << 17
BUCKET_BYTES = 1 << 20
LEAST_BUCKETS = 512
MOST_CONTENTS = 8192
STEP = 1 << 18
_PLACE = np.uint64((1 << 24) - 1)


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, first window, last window, minimizer, content hash, minimizer's place) of every run; a row's bytes count from 0."""
    n, gram = len(data), length // 4
    if n < length:
        return None
    sums = prefix_hash(data)
    grams = np.arange(n - gram + 1)
    hashes = span_hash(sums, grams, grams + gram)
    least = (hashes & ~_PLACE) | grams.astype(np.uint64)
    width, wanted = 1, length - gram + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[:len(least) - (wanted - width)], least[wanted - width:])
    place = (least & _PLACE).astype(np.int64)
    lengths = np.diff(offsets)
    edge = np.zeros(n + 1, np.int64)
    long = lengths >= length
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(edge)[:len(place)] > 0
    first = valid.copy()
    first[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    # two rows whose windows touch cannot be: the last length - 1 bytes of a row start no window
    last = valid.copy()
    last[:-1] &= first[1:] | ~valid[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    row = np.searchsorted(offsets, starts, "right") - 1
    at = place[starts]
    return row, starts - offsets[row], ends - offsets[row], hashes[at], span_hash(sums, starts, ends + length), at - offsets[row]


def _parts(batches: Iterator[pa.RecordBatch], length: int):
    """(batch, data, offsets, base): small slices; a long text comes in overlapping parts with their place in it."""
    for batch in slices(batches, "text", STEP):
        data, offsets = flatten(batch.column("text"))
        if batch.num_rows == 1 and len(data) > 4 * STEP:
            for base in range(0, len(data) - length + 1, STEP):
                piece = data[base:base + STEP + length - 1]
                yield batch, piece, np.array([0, len(piece)]), base
        else:
            yield batch, data, offsets, 0


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _runs(texts: DataFrame, length: int) -> DataFrame:
    """k1, k2, id, minimizer, content, begin, end of all runs."""

    def scan(batches):
        for batch, data, offsets, base in _parts(batches, length):
            found = runs_of(data, offsets, length)
            if found is None:
                continue
            row, begin, end, minimizer, content, _ = found
            keys = [batch.column(c).take(pa.array(row)) for c in ("k1", "k2", "id")]
            yield pa.RecordBatch.from_arrays([*keys, _signed(minimizer), _signed(content), pa.array(begin + base), pa.array(end + base)],
                                             ["k1", "k2", "id", "minimizer", "content", "begin", "end"])

    return texts.mapInArrow(scan, "k1 long, k2 long, id long, minimizer long, content long, begin long, end long")


def _keyed(documents: DataFrame) -> DataFrame:
    """With the key of the text, and an id that tells most copies of a text apart."""
    return documents.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("text", F.lit(1), F.length("text")),
                                  "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))})


def ranked(symbols: np.ndarray) -> np.ndarray:
    """Dense ranks of 64-bit symbols. They are sorted with their places in the lowest bits, which is faster than an argsort."""
    n = len(symbols)
    bits = np.uint64(n.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = (symbols & ~low) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    packed >>= bits
    ordered = symbols[order]
    new = ordered[1:] != ordered[:-1]
    if (new & (packed[1:] == packed[:-1])).any():
        # some symbols differ in the lowest bits only
        return np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = np.append(0, np.cumsum(new))[:n]
    return rank


class Shard:
    """Suffixes of some strings in order of their first blocks, and the block before each.

    The strings' symbols, one a place, lie one string after the other; all shards that are merged rank them together. A suffix
    is read in steps of `block` bytes; where less than a block is left stands the end symbol 0, the same for all.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, levels: int, block: int):
        n = len(symbols)
        if n >= 1 << 21:
            raise ValueError("a shard has at most 2 MB")
        end = np.repeat(bounds[1:], np.diff(bounds))
        here = np.arange(n)
        rank = symbols if n and symbols.max() < 1 << 21 else np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        order, step = here, block
        for _ in range(max(0, levels - 1).bit_length()):
            after = here + step
            # what follows the end counts as nothing, lower than any rank
            follow = np.where(after < end, rank[np.minimum(after, n - 1)] + 1, 0)
            follow[symbols == 0] = 0
            packed = (rank << 42) | (follow << 21) | here
            packed.sort()
            order = packed & ((1 << 21) - 1)
            packed >>= 21
            rank = np.empty(n, np.int64)
            rank[order] = np.append(0, np.cumsum(packed[1:] != packed[:-1]))[:n]
            step *= 2
        self.order = order.astype(np.int32)
        begin = np.repeat(bounds[:-1], np.diff(bounds))
        before = here - block
        self.before = np.where(before >= begin, symbols[np.maximum(before, 0)], 0)[self.order]


def merge(shards: list[Shard], levels: int) -> list[np.ndarray]:
    """For each shard, the group of each of its suffixes: equal numbers share `levels` blocks."""
    sizes = [len(s.order) for s in shards]
    n = sum(sizes)
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) <= 256 else np.uint16), sizes)
    before = np.concatenate([s.before for s in shards]).astype(np.int32)
    group = np.zeros(n, np.int32)
    for _ in range(levels):
        dealt = np.empty(n, np.int32)
        dealt[np.argsort(interleave, kind="stable")] = before
        source = np.argsort(dealt.astype(np.uint16), kind="stable")
        # stable sorts of at most 16 bits go by digits; the upper ones come second
        upper = (dealt >> 16).astype(np.uint8 if n < 1 << 24 else np.uint16)
        source = source[np.argsort(upper[source], kind="stable")]
        dealt, interleave, old = dealt[source], interleave[source], group[source]
        # suffixes at their end are alike, whatever string comes next
        split = (dealt[1:] != dealt[:-1]) | ((old[1:] != old[:-1]) & (dealt[1:] != 0))
        group = np.append(0, np.cumsum(split, dtype=np.int32)).astype(np.int32) if n else group
    by_shard = group[np.argsort(interleave, kind="stable")]
    return np.split(by_shard, np.cumsum(sizes)[:-1])


def repeated_places(contents: list[bytes], length: int, shard_bytes: int, times: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(mark, bounds): of all strings, each with one more place behind it, whether the window at a place occurs at another one."""
    levels, block = LEVELS, length // LEVELS
    # the place behind a string is where its empty suffix stands
    places = np.array([len(c) + 1 for c in contents], np.int64)
    times = np.ones(len(contents)) if times is None else np.array(times, float)
    data = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8)
    bounds = np.append(0, np.cumsum(places))
    left = np.repeat(bounds[1:], places) - np.arange(len(data))
    sums, symbols, whole = prefix_hash(data), np.zeros(len(data), np.uint64), np.flatnonzero(left > block)
    symbols[whole] = span_hash(sums, whole, whole + block) | np.uint64(1)
    symbols = ranked(symbols)
    cuts, held = [0], 0
    for i, n in enumerate((places - 1).tolist()):
        if held and held + n > shard_bytes:
            cuts.append(i)
            held = 0
        held += n
    cuts.append(len(contents))
    pairs = list(zip(cuts, cuts[1:]))
    shards = [Shard(symbols[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], levels, block) for a, b in pairs]
    groups = merge(shards, levels)
    weights = [np.repeat(times[a:b], places[a:b])[shard.order] for (a, b), shard in zip(pairs, shards)]
    total = np.bincount(np.concatenate(groups), np.concatenate(weights))
    mark = np.empty(len(data), bool)
    for (a, b), shard, group in zip(pairs, shards, groups):
        mark[bounds[a]:bounds[b]][shard.order] = total[group] > 1
    mark &= left > length
    return mark, bounds


def repeated_windows(contents: list[bytes], length: int = LENGTH, shard_bytes: int = SHARD_BYTES, times: list[int] | None = None) -> list[np.ndarray]:
    """For each string, whether the window at each start occurs at another place of any of them.

    `times` says how often each string stands for itself, else once.
    """
    mark, bounds = repeated_places(contents, length, shard_bytes, times)
    return [mark[a:max(a, b - length)] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def intervals(mark: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


_COLUMNS = ["k1", "k2", "minimizer", "content", "n", "begin", "end"]
_FOUND = "k1 long, k2 long, minimizer long, content long, n long, begin long, end long"


def _merged(contents: DataFrame, buckets: int, length: int) -> DataFrame:
    """Intervals of repeated window starts of each content, bucket by bucket."""

    def settle(table: pa.Table) -> pa.Table:
        # repeated rows of one document bring the same content again
        keys = list(zip(table["minimizer"].to_pylist(), table["content"].to_pylist()))
        rows = list({k: i for i, k in enumerate(keys)}.values())
        table = table.take(pa.array(rows)).sort_by([("minimizer", "ascending"), ("content", "ascending")])
        minimizers = table["minimizer"].to_numpy()
        before = np.append(0, np.cumsum(pc.binary_length(table["bytes"]).to_numpy()))
        edges = np.append(np.flatnonzero(np.append(True, np.diff(minimizers) != 0)), len(minimizers))
        out, first = [], 0
        while first < len(minimizers):
            # whole minimizers up to MERGE_BYTES, one at least: only strings of one minimizer can share a window
            fitting = edges[(edges > first) & (before[edges] <= before[first] + MERGE_BYTES)]
            end = int(fitting[-1]) if len(fitting) else int(edges[np.searchsorted(edges, first, "right")])
            part = table.slice(first, end - first)
            mark, bounds = repeated_places(part["bytes"].to_pylist(), length, SHARD_BYTES, part["n"].to_pylist())
            # no window starts at a string's end, so an interval is of one string
            begin, last = np.array(intervals(mark), np.int64).reshape(-1, 2).T
            row = np.searchsorted(bounds, begin, "right") - 1
            within = part["begin"].to_numpy()[row] - bounds[row]
            out.append(pa.table([*(part[c].take(pa.array(row)) for c in _COLUMNS[:5]), pa.array(within + begin), pa.array(within + last)], _COLUMNS))
            first = end
        return pa.concat_tables(out)

    dealt = contents.withColumn("bucket", F.pmod(F.xxhash64("minimizer"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(settle, _FOUND)


def _counted(contents: DataFrame, length: int) -> DataFrame:
    """The same for minimizers with very many contents: windows counted one by one."""

    def windows(batches):
        for batch in slices(batches, "bytes", STEP):
            data, offsets = flatten(batch.column("bytes"))
            lengths = np.diff(offsets) - length + 1
            sums = prefix_hash(data)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            start = offsets[row] + inner
            taken = [batch.column(c).take(pa.array(row)) for c in _COLUMNS[:5]]
            at = pc.add(batch.column("begin").take(pa.array(row)), pa.array(inner))
            yield pa.RecordBatch.from_arrays([*taken, at, _signed(span_hash(sums, start, start + length))],
                                             [*_COLUMNS[:6], "window"])

    rows = contents.mapInArrow(windows, "k1 long, k2 long, minimizer long, content long, n long, begin long, window long")
    often = rows.groupBy("minimizer", "window").agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    return rows.join(often, ["minimizer", "window"]).select(*_COLUMNS[:6], F.col("begin").alias("end"))


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """k1, k2 (the text's key) and the intervals of window starts that occur elsewhere, as one array a text."""
    if length < LEVELS or length % LEVELS:
        raise ValueError(f"the length has to be a multiple of {LEVELS}")
    keyed = _keyed(documents.select("doc_id", "text")).where(F.octet_length("text") >= length)
    runs = _runs(keyed.select("k1", "k2", "id", "text"), length)
    # one place of each content; of copies of a text always the same one
    held = F.struct("k1", "k2", "id", "begin", "end")
    counted = runs.groupBy("minimizer", "content").agg(F.count("*").alias("n"), F.min(held).alias("at"))
    counted = stored(counted.select("minimizer", "content", "n", "at.*"), "contents")
    several = counted.groupBy("minimizer").agg(F.count("*").alias("contents")).where("contents > 1")
    asked = counted.join(several, "minimizer", "left").where("n > 1 or contents > 1").fillna(1, ["contents"])
    lists = asked.groupBy("k1", "k2", "id").agg(F.collect_list(F.struct("begin", "end", "minimizer", "content", "n", "contents")).alias("asked"))
    one = keyed.join(lists, ["k1", "k2", "id"]).select("k1", "k2", "text", "asked")

    def cut(batches):
        for batch in slices(batches, "text"):
            data, offsets = flatten(batch.column("text"))
            asked = batch.column("asked")
            count = pc.list_value_length(asked).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), count)
            flat = pc.list_flatten(asked)
            begin, end = flat.field("begin").to_numpy(), flat.field("end").to_numpy()
            raw = data.tobytes()
            bytes_ = [raw[a:b] for a, b in zip((offsets[row] + begin).tolist(), (offsets[row] + end + length).tolist())]
            keys = [batch.column(c).take(pa.array(row)) for c in ("k1", "k2")]
            own = [flat.field(c) for c in ("minimizer", "content", "n", "contents", "begin")]
            yield pa.RecordBatch.from_arrays([*keys, *own, pa.array(bytes_, pa.binary())],
                                             ["k1", "k2", "minimizer", "content", "n", "contents", "begin", "bytes"])

    contents = one.mapInArrow(cut, "k1 long, k2 long, minimizer long, content long, n long, contents long, begin long, bytes binary")
    contents = stored(contents, "contents").dropDuplicates(["minimizer", "content"])
    size = contents.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    few, many = contents.where(F.col("contents") <= MOST_CONTENTS), contents.where(F.col("contents") > MOST_CONTENTS)
    found = stored(_merged(few, buckets, length).union(_counted(many, length)), "found")
    # of a content that occurs several times every window does, at all its places
    alike = runs.join(found.where("n > 1").select("minimizer", "content").distinct(), ["minimizer", "content"])
    spans = found.where("n = 1").select("k1", "k2", "begin", "end").union(alike.select("k1", "k2", "begin", "end"))
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def without_repeats(documents: DataFrame, length: int = LENGTH, least_words: int = 0, as_text: bool = False) -> DataFrame:
    """All columns, and `kept` (binary), `n_bytes`, `n_removed`, `removed` (array of begin, end; end not included).

    Columns of those names are replaced. Of the runs of repeated bytes those go that hold at least `least_words`
    words, divided by white space and counting cut ones. With `as_text`, kept is text: of characters that a cut splits, what is
    left of their bytes goes as well.
    """
    documents = documents.drop("kept", "n_bytes", "n_removed", "removed", "_k1", "_k2", "_spans")
    # stored, so that the join has a shuffle of its own, in which the many copies of a text can be split
    spans = stored(repeated_spans(documents, length), "spans").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans"))
    keyed = documents.withColumns({"_k1": F.xxhash64("text"), "_k2": F.xxhash64("text", F.lit(1), F.length("text"))})
    joined = keyed.join(spans, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*documents.schema.fields, T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(span))])
    arrow_span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in slices(batches, "text"):
            data, offsets = flatten(batch.column("text"))
            raw, kept, removed = data.tobytes(), [], []
            for i, spans_ in enumerate(batch.column("_spans")):
                own, found = raw[offsets[i]:offsets[i + 1]], []
                if spans_.is_valid:
                    flat = spans_.values
                    begin, end = flat.field("begin").to_numpy(), flat.field("end").to_numpy() + length
                    order = np.argsort(begin, kind="stable")
                    begin, reach = begin[order], np.maximum.accumulate(end[order])
                    new = np.append(True, begin[1:] > reach[:-1])
                    found = list(zip(begin[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)].tolist()))
                    found = [(a, b) for a, b in found if len(own[a:b].split()) >= least_words] if least_words else found
                edges = [0, *(x for s in found for x in s), len(own)]
                left = [own[a:b] for a, b in zip(edges[::2], edges[1::2])]
                kept.append("".join(x.decode("utf-8", "ignore") for x in left) if as_text else b"".join(left))
                removed.append([{"begin": a, "end": b} for a, b in found])
            gone = [sum(x["end"] - x["begin"] for x in r) for r in removed]
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_spans"]
            names = [name for name in batch.schema.names if name != "_spans"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array(removed, arrow_span)],
                [*names, "kept", "n_bytes", "n_removed", "removed"])

    return joined.mapInArrow(cut, schema)
