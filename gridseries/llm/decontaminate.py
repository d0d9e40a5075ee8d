"""Benchmark decontamination as a prefix-filtered containment join.

A benchmark item is cut into windows of `window` consecutive words; an item with fewer words is one
window. Only whole windows count, so the necessary prefix of a window in rarity order is its single
rarest word: a document that contains the window contains that word. Documents are joined on the
prefix words alone. A candidate must then fit (the positional bound: the words before the rare word;
the length bound: the words after it) and is verified exactly, first by the hashes of its words, then
byte by byte.

The benchmark is the query set. It is read in blocks of at most `block_bytes`; each block becomes a
broadcast index, and with several blocks the table is carried from one to the next by checkpoint().
Word frequencies cover all documents.

Defined cases: null and empty texts have no words and no spans; a null item id takes part in spans
but not in the list of items; repeated rows stay rows; extra columns stay untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.flat import LOWER, flatten, prefix_hash, repeat_ranges, slices, span_hash, word_spans
from gridseries.llm.tables import ensure_checkpoint_dir, set_aside

WINDOW = 10
BLOCK_BYTES = 16 << 20
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPAN = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("length", T.LongType())])
_ARROW_SPANS = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(bytes(LOWER)))


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = ends - [len(w) for w in words]
    return span_hash(prefix_hash(np.frombuffer(b"".join(words), np.uint8)), starts, ends) if words else np.zeros(0, np.uint64)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = flatten(column)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTE)
    return low, starts, ends, first, span_hash(prefix_hash(low), starts, ends)


class Windows:
    """The distinct windows of one block of items, and the items each occurs in."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        found: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[i:i + window]), set()).add(None if item is None else str(item))
        self.words = sorted(found)
        self.items = [sorted(found[w], key=lambda x: (x is None, x)) for w in self.words]
        self.vocabulary = np.unique(_hashes(sorted({w for x in self.words for w in x})))

    def index(self, frequency: dict[int, int]) -> None:
        """Arrange windows by their rarest word; words no document has come first, ties go by hash."""
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.hashes = np.zeros((len(self.words), max(self.lengths, default=1)), np.uint64)
        rare, place = [], []
        for i, words in enumerate(self.words):
            own = _hashes(list(words))
            self.hashes[i, :len(own)] = own
            at = min(range(len(own)), key=lambda j: (frequency.get(int(own[j]), 0), int(own[j])))
            rare.append(own[at])
            place.append(at)
        rare = np.array(rare, np.uint64)
        order = np.argsort(rare, kind="stable")
        self.place, self.which = np.array(place, np.int64)[order], order
        self.prefix, self.first = np.unique(rare[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.prefix & np.uint64(0xFFFF)).astype(np.int64)] = True

    def spans(self, low, starts, ends, first, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and windows of all verified occurrences."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.words) or not len(hashes):
            return none
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.prefix, hashes[at]), len(self.prefix) - 1)
        at, slot = at[(hit := self.prefix[slot] == hashes[at])], slot[hit]
        posting = repeat_ranges(self.first[slot], self.count[slot])
        at, window = np.repeat(at, self.count[slot]), self.which[posting]
        row = np.searchsorted(first, at, "right") - 1
        at = at - self.place[posting]
        fits = (at >= first[row]) & (at + self.lengths[window] <= first[row + 1])
        at, window = at[fits], window[fits]
        for k in range(self.hashes.shape[1]):
            same = (k >= self.lengths[window]) | (hashes[np.minimum(at + k, len(hashes) - 1)] == self.hashes[window, k])
            at, window = at[same], window[same]
        raw = low.tobytes()
        exact = np.array([all(raw[starts[p + k]:ends[p + k]] == w for k, w in enumerate(self.words[j]))
                          for p, j in zip(at.tolist(), window.tolist())], bool)
        return (at[exact], window[exact]) if len(at) else none


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list]:
    """The query set in blocks of bounded size, never whole."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        n = len((row.text or "").encode())
        if held and size + n > block_bytes:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += n
    yield held


def _frequencies(documents: DataFrame, vocabulary) -> dict[int, int]:
    """Documents with each word of the block; every document counts."""

    def count(batches):
        wanted = vocabulary.value
        total = np.zeros(len(wanted), np.int64)
        for batch in slices(batches, "text"):
            *_, first, hashes = _tokens(batch.column(0))
            slot = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            known = wanted[slot] == hashes
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))[known]
            total += np.bincount(np.unique(row * len(wanted) + slot[known]) % len(wanted), minlength=len(wanted))
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(total)], ["word", "n"])

    if not len(vocabulary.value):
        return {}
    counted = documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # one row per word of the block
    return {int(np.int64(r.word).view(np.uint64)): r.n for r in counted.collect()}


def find_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with `n_words` and `spans`, the (item_id, start, length) in words of every window occurrence.

    Columns of those two names in the input are replaced.
    """
    spark = documents.sparkSession
    out = documents.drop("n_words", "spans").withColumns(
        {"n_words": F.lit(None).cast("long"), "spans": F.lit(None).cast(T.ArrayType(SPAN))})
    for number, items in enumerate(_blocks(benchmark, block_bytes)):
        block = Windows(items, window)
        block.index(_frequencies(documents, spark.sparkContext.broadcast(block.vocabulary)))
        index = spark.sparkContext.broadcast(block)
        if number:
            ensure_checkpoint_dir(spark)
            out = out.checkpoint()
        schema = out.schema

        def scan(batches, index=index):
            own = index.value
            for batch in slices(batches, "text"):
                low, starts, ends, first, hashes = _tokens(batch.column("text"))
                at, window_of = own.spans(low, starts, ends, first, hashes)
                row = np.searchsorted(first, at, "right") - 1
                found = batch.column("spans").to_pylist()
                found = [x or [] for x in found]
                for r, p, j in zip(row.tolist(), at.tolist(), window_of.tolist()):
                    found[r] += [{"item_id": i, "start": p - int(first[r]), "length": int(own.lengths[j])}
                                 for i in own.items[j]]
                names = batch.schema.names
                columns = [batch.column(i) for i in range(batch.num_columns)]
                columns[names.index("n_words")] = pa.array(np.diff(first), pa.int64())
                columns[names.index("spans")] = pa.array(found, _ARROW_SPANS)
                yield pa.RecordBatch.from_arrays(columns, names)

        out = out.mapInArrow(scan, schema)
    return out


def covered_words(spans: str = "spans"):
    """Number of words inside any span: lengths of the merged intervals."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), (s["start"] + s["length"]).alias("e"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))

    def step(seen, x):
        new = F.greatest(x["e"] - F.greatest(x["s"], seen["to"]), F.lit(0).cast("long"))
        return F.struct((seen["n"] + new).alias("n"), F.greatest(seen["to"], x["e"]).alias("to"))

    return F.aggregate(ordered, start, step)["n"]


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, and the items with windows in it."""
    items = F.array_sort(F.array_distinct(F.filter(F.transform("spans", lambda s: s["item_id"]), lambda x: x.isNotNull())))
    found = find_spans(documents.select("doc_id", "text"), benchmark, window).drop("text")
    found = found.select("doc_id", "n_words", covered_words().alias("n_hit"), items.alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any benchmark window; all columns stay as they are."""
    apart, restore = set_aside(documents, "text")
    return restore(find_spans(apart, benchmark, window).where(F.size("spans") == 0))
