"""Dictionary-compressed WARC archives: writing pages and reading them back.

An archive (.warc.zst) starts with a skippable frame that holds a Zstandard dictionary; then comes one
frame for each record, compressed with that dictionary, so that a record can be read by its offset
alone. The dictionary is trained on at most `SAMPLE_RECORDS` different payloads, chosen by a hash. Of pages with
equal payloads of at least `least_bytes`, the one with the largest page_id is a `response` record; the
others are `revisit` records that name it and carry no payload.

Tasks write their archives under names made of the partition's number, first under a name of the
attempt's own, and then move them into place; so a repeated task puts the same file there again.

Defined cases: null html is an empty payload; rows that repeat a response's page_id and payload are
responses too; a null page_id never is the largest; if all of a group are null, all are responses; a
null url gives no target header; an empty table gives no archive; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.flat import slices
from gridseries.llm.tables import stored

SAMPLE_RECORDS = 1500
SAMPLE_PAGE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 32 << 20
LEAST_REVISIT_BYTES = 0
# fixed values of the formats
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:gridseries:page-records")
_ATTEMPT_SPACE = re.compile(r"[\r\n]+")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_RECORD_NAMES, f'{page_id}/{payload_digest}')}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {_ATTEMPT_SPACE.sub(' ', str(v))}" for k, v in fields if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None,
                date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A response record, or a revisit record if `refers_to` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, payload_digest)),
              ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
              ("Content-Type", "application/http;msgtype=response"), ("Page-ID", page_id)]
    if refers_to is None:
        return _record(fields, http + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, payload_digest)), ("Refers-To-Page-ID", refers_to)]
    return _record(fields, http)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; too few of them serve as its raw content."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


class Archive:
    """An archive being written: the dictionary's frame, then a frame for each record."""

    def __init__(self, dictionary: bytes, level: int = 6):
        own = _dictionary(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=level, **({"dict_data": own} if own else {}))
        self.out = io.BytesIO()
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_RECORD_NAMES, 'info')}>"),
                          ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")],
                         b"format: WARC File Format 1.1\r\n"))

    def add(self, record: bytes) -> tuple[int, int]:
        """Offset and length of the record's frame."""
        begin = self.out.tell()
        self.out.write(self.compressor.compress(record))
        return begin, self.out.tell() - begin


def dictionary_of(archive) -> bytes:
    """The dictionary of an open archive; leaves the file behind it."""
    magic, size = struct.unpack("<II", archive.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no dictionary frame")
    return archive.read(size)


def records(archive) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of all records of an open archive, read as a stream."""
    own = _dictionary(dictionary_of(archive))
    decompressor = zstandard.ZstdDecompressor(**({"dict_data": own} if own else {}))
    stream = io.BufferedReader(decompressor.stream_reader(archive, read_across_frames=True), 1 << 20)
    while stream.readline().startswith(b"WARC/"):
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        stream.read(4)
        yield fields, block


def _files(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder's address: file, or any that pyarrow reaches."""
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


def with_originals(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_sha1 and refers_to, the response's page_id for revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("payload_sha1", F.sha1("payload"))
    long = rows.where(F.octet_length("payload") >= least_bytes)
    largest = long.groupBy("payload_sha1").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n")
    # stored, so that the join has a shuffle of its own, in which a very common payload can be split
    joined = rows.join(stored(largest, "originals"), "payload_sha1", "left")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")) & (F.octet_length("payload") >= least_bytes)
    return joined.withColumn("refers_to", F.when(other, F.col("largest"))).drop("largest")


def sample_dictionary(pages: DataFrame, most: int = SAMPLE_RECORDS) -> bytes:
    """Trained on at most `most` different payloads, of each the first SAMPLE_PAGE_BYTES; records are written whole.

    The draw goes by a hash of the payload and takes the smallest, so it is the same in every run and copies
    count once.
    """
    draw = F.xxhash64("html")
    rows = pages.where(F.octet_length("html") > 0).select(draw.alias("draw"), F.xxhash64("html", F.lit(1)).alias("tie"), "url", "html", "page_id")
    # about twice as many as wanted pass the filter, so few payloads are moved; the count is one of different payloads
    share = min(1.0, 2.0 * most / max(1, rows.agg(F.approx_count_distinct("draw")).first()[0]))
    drawn = rows.where(F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30)))
    cut = F.substring(F.col("html").cast("binary"), 1, SAMPLE_PAGE_BYTES)
    once = drawn.groupBy("draw", "tie").agg(F.min(F.struct("page_id", "url", cut.alias("body"))).alias("page"))
    chosen = once.orderBy("draw", "tie").limit(most).select("draw", "tie", "page.*").collect()
    chosen = sorted(chosen, key=lambda r: (r.draw, r.tie))
    return train_dictionary([page_record(r.page_id, r.url, bytes(r.body), digest(bytes(r.body)), None) for r in chosen])


def write_archives(pages: DataFrame, folder: str, dictionary: bytes | None = None, least_bytes: int = LEAST_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages; returns the index: archive, frame_offset, frame_length, page_id, record_type."""
    dictionary = sample_dictionary(pages) if dictionary is None else dictionary
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]):
        files, top = _files(folder)
        files.create_dir(top, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        archive, rows, number, raw = None, [], 0, 0

        def close():
            name = f"{top}/part-{part:05d}-{number:04d}.warc.zst"
            own = f"{top}/_writing-{part:05d}-{number:04d}-{attempt}"
            with files.open_output_stream(own, compression=None) as out:
                out.write(archive.out.getbuffer())
            files.move(own, name)
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rows)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3])],
                ["archive", "frame_offset", "frame_length", "page_id", "record_type"])

        for batch in slices(batches, "payload"):
            for page_id, url, payload, sha1, refers_to in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "payload_sha1", "refers_to"))):
                archive = archive or Archive(shared.value)
                record = page_record(page_id, url, payload, base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to)
                rows.append((*archive.add(record), page_id, "response" if refers_to is None else "revisit"))
                raw += len(record)
                if raw >= archive_bytes:
                    yield close()
                    archive, rows, number, raw = None, [], number + 1, 0
        if archive:
            yield close()

    # a repeated task then writes the same bytes
    ordered = with_originals(pages, least_bytes).sortWithinPartitions("payload_sha1", "page_id", "url")
    schema = "archive string, frame_offset long, frame_length long, page_id long, record_type string"
    return stored(ordered.mapInArrow(write, schema), "warc-index")


def read_archives(index: DataFrame, folder: str, strict: bool = False) -> DataFrame:
    """One row per page record of the index's archives: page_id, url, payload (null for revisits), payload_bytes,
    payload_digest, record_type, refers_to, and whether a response's payload has the digest of its header.

    Archives are dealt to as many tasks as there are, up to the session's number of shuffle partitions. With `strict`
    a response that is not intact is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]):
        files, _ = _files(folder)
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])

        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as archive:
                    for fields, block in records(archive):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        response, named = fields["WARC-Type"] == "response", fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        page, refers = (int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID"))
                        intact = digest(payload) == named and len(payload) == length if response else None
                        if strict and response and not intact:
                            raise ValueError(f"page {page} in {name} is not what its header says")
                        rows.append((page, fields.get("WARC-Target-URI"), payload if response else None, length, named, fields["WARC-Type"], refers, intact))
                        held += len(block)
                        if held > 8 << 20:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the names are a few bytes, which adaptive execution would put into one task; by another key than that of
    # distinct(), or its shuffle would serve for this one
    archives = index.select("archive").distinct().repartition(tasks, F.xxhash64("archive"))
    return archives.mapInArrow(read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                                     "record_type string, refers_to long, intact boolean")
