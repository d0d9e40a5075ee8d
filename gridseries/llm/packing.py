"""Packing of tokenised documents into sequences by minimum bin slack.

A document is its token ids and one end id. Longer ones are cut into pieces of `capacity` tokens, of
which the first may be shorter. Only lengths decide what fits together, so the plan is made from the
counts of pieces by length (at most `capacity` rows): the longest length left opens a bin, a bitset
subset-sum over the available lengths finds the fullest bin that has it, and that combination is
taken as often as the counts allow. Afterwards every piece finds its place from its length and its
rank among the pieces of that length, without any group being collected.

A combination leaves some length with fewer pieces than it takes of it, and it takes at most
capacity / length of a length; so there are at most capacity * (1 + ln capacity) combinations, and the
broadcast plan has a bound that does not depend on the data.

Defined cases: null text counts as empty, and an empty document is one piece of the end id alone;
repeated rows are packed each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridseries.llm.tables import stored

CAPACITY = 1024
END_ID = 2
BROADCAST_BYTES = 32 << 20
# the splitting pattern of the file's byte-level pre-tokenizer (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 256
COMPARED = 8
# one task in so many compares texts
COMPARING = 8
COMPARED_CHARS = 20_000
_SPACE = re.compile(r"\s")


class Encoder:
    """Byte-level BPE ids of whole texts, as the tokenizer file gives them.

    The merges run in tiktoken on the file's own vocabulary, whose ids are in the order of its merges;
    that gives the ids of `tokenizers` several times faster. Texts with very long runs without white
    space (`long_run` characters), where its merging is slow, and files of another kind go through `tokenizers`
    itself. The first `compared` texts of an encoder, of up to COMPARED_CHARS characters as `tokenizers` takes much memory
    for long ones, go through both; should their ids differ, that is an error.
    """

    def __init__(self, path: str, long_run: int = LONG_RUN, compared: int = COMPARED):
        self.path, self.fast = path, _fast(path)
        self.long_run, self.compared = long_run, compared

    @cached_property
    def slow(self):
        """Loaded where a text needs it; it takes some memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> bytes:
        run = self.long_run
        if self.fast is None or any(not _SPACE.search(text, i, i + run) for i in range(0, len(text) - run + 1, run)):
            return self.exact(text)
        found = self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        if self.compared and len(text) <= COMPARED_CHARS:
            self.compared -= 1
            if found != self.exact(text):
                raise ValueError("the merged ids are not those of the tokenizer file")
        return found

    def exact(self, text: str) -> bytes:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _fast(path: str):
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    split, model = content["pre_tokenizer"] or {}, content["model"]
    added = {x["content"]: x["id"] for x in content["added_tokens"]}
    plain = not any(x[k] for x in content["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    expected = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if content["normalizer"] or not plain or any(split.get(k) != v for k, v in expected.items()) or model.get("ignore_merges"):
        return None
    # the printable characters that stand for bytes in such files: printable bytes themselves, others from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, long_run: int = LONG_RUN) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit), and part, nth: a number per length in each partition."""
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"

    def cut(batches: Iterator[pa.RecordBatch]):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part = TaskContext.get().partitionId()
        encoder = Encoder(tokenizer_path, long_run, 0 if part % COMPARING else COMPARED)
        seen = np.zeros(capacity + 1, np.int64)
        rows, held = [], 0

        def batch():
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["doc_id", "piece", "start", "length", "ids", "part", "nth"])

        for incoming in batches:
            for doc_id, text in zip(incoming.column("doc_id").to_pylist(), incoming.column("text")):
                ids = encoder.ids(text.as_py() or "") + end
                n = len(ids) // 4
                count = -(-n // capacity)
                start = 0
                for piece in range(count):
                    length = n - capacity * (count - 1) if not piece else capacity
                    rows.append((doc_id, piece, start, length, ids[4 * start:4 * (start + length)], part, int(seen[length])))
                    seen[length] += 1
                    start += length
                held += len(ids)
                if held > 8 << 20:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def fullest(capacity: int, opener: int, counts: np.ndarray) -> dict[int, int]:
    """The fullest combination with the opener: bit s of `reach` says that sum s can be had."""
    room = capacity - opener
    mask = (1 << (room + 1)) - 1
    reach, taken = 1, []
    for length in range(min(room, opener), 0, -1):
        for _ in range(min(int(counts[length]) - (length == opener), room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            taken.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    left = reach.bit_length() - 1
    chosen = {opener: 1}
    for length, before in reversed(taken):
        if not before >> left & 1:
            chosen[length] = chosen.get(length, 0) + 1
            left -= length
    return chosen


@dataclass
class Plan:
    """Row i: the ranks from `rank` on of pieces of `length`, `each` to a sequence, numbered from `sequence`."""

    key: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, length * RANKS + rank, "right") - 1
        beyond = rank - self.rank[row]
        return self.sequence[row] + beyond // self.each[row], self.offset[row] + beyond % self.each[row] * length


RANKS = 1 << 48


def minimum_slack(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Combinations for all pieces, from the number of pieces of each length."""
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows, sequence = [], 0
    for opener in range(capacity, 0, -1):
        while left[opener]:
            chosen = fullest(capacity, opener, left)
            times = min(int(left[length]) // n for length, n in chosen.items())
            offset = 0
            for length, n in chosen.items():
                rows.append((length, int(used[length]), n, sequence, offset))
                used[length] += n * times
                left[length] -= n * times
                offset += n * length
            sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(table[:, 0] * RANKS + table[:, 1], *table[:, 1:].T, sequence)


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, long_run: int = LONG_RUN,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per piece with its ids, its sequence_id and its offset there.

    `long_run` says which texts `tokenizers` merges, see Encoder; the counts of pieces by partition are broadcast if they
    have at most `broadcast_bytes`, else joined by Spark's own choice. The rows do not depend on either.
    """
    spark = documents.sparkSession
    pieces = stored(token_pieces(documents, tokenizer_path, capacity, end_id, long_run), "pieces")
    sizes = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    totals = np.zeros(capacity + 1, np.int64)
    # one row per length
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        totals[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(minimum_slack(totals, capacity))
    # one row per partition and length
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    before = before.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("before"))
    if before.count() * capacity * 16 <= broadcast_bytes:
        before = F.broadcast(before)
    ranked = pieces.join(before, "part").withColumn("rank", F.col("nth") + F.col("before")[F.col("length")])

    def settle(batches: Iterator[pa.RecordBatch]):
        own = plan.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = own.place(length, rank)
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids", "rank").mapInArrow(
        settle, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")
