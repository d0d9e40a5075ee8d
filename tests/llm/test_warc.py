import base64
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from gridseries.llm import warc as op
from gridseries.llm.tables import shared_folder


def brute_force(rows, least=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        top = max((x for x in groups[payload] if x is not None), default=None)
        refers = top if len(payload) >= least and top is not None and i != top else None
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


ROWS = [(i, f"http://x/{i}\r\nX: y" if i % 7 else None, ["aaa", None, "", "é" * 9, f"bbb {i} " * 50][i % 5]) for i in range(200)]
ROWS += [(None, "http://n", "aaa"), (None, "http://n", "only null ids"), (199, "http://x", ROWS[199][2]), (500, "u", "x" * 300_000)]


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, payload string").repartition(3)
    folder = shared_folder(spark, "test-archives")
    index = op.write_archives(pages, folder, least_bytes=least, archive_bytes=5000)
    back = op.read_archives(index, folder).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str)
    assert got == brute_force(ROWS, least)
    assert all(r["intact"] for r in back if r["record_type"] == "response")
    texts = {(i, (html or "").encode()) for i, _, html in ROWS}
    assert all((r["page_id"], bytes(r["payload"])) in texts for r in back if r["record_type"] == "response")
    assert index.select("archive").distinct().count() > 3

    # every record can be read by its offset alone
    row = index.filter("page_id = 500").first()
    with open(row["archive"], "rb") as archive:
        magic, size = struct.unpack("<II", archive.read(8))
        dictionary = zstandard.ZstdCompressionDict(archive.read(size))
        assert magic == op.SKIPPABLE_MAGIC
        archive.seek(row["frame_offset"])
        record = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(archive.read(row["frame_length"]))
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: response") and record.endswith(b"x" * 300_000 + b"\r\n\r\n")


def test_repeating_a_task_gives_the_same_files(spark):
    pages = spark.createDataFrame(ROWS[:50], "page_id long, url string, html string").coalesce(1)
    names = []
    for _ in range(2):
        folder = shared_folder(spark, "test-archives")
        archive = op.write_archives(pages, folder).first()["archive"]
        names.append((archive.rsplit("/")[-1], open(archive, "rb").read()))
    assert names[0] == names[1]


def test_dictionary_helps_and_small_samples_work():
    records = [op.page_record(i, f"http://a/{i}", f"<html><head><title>{i}</title></head><body>words of page {i}</body></html>".encode() * 3, "D", None)
               for i in range(400)]
    dictionary = op.train_dictionary(records, 4096)
    sizes = []
    for content in (dictionary, b""):
        archive = op.Archive(content)
        sizes.append(sum(archive.add(r)[1] for r in records))
        found = list(op.records(io.BytesIO(archive.out.getvalue())))
        assert len(found) == 401 and found[5][0]["Page-ID"] == "4"
    assert sizes[0] < 0.7 * sizes[1]
    assert op.train_dictionary([]) == b"" and op.train_dictionary([b"few"])


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_folder(spark, "test-archives")
    index = op.write_archives(pages, folder)
    assert index.isEmpty() and op.read_archives(index, folder).isEmpty()


def test_large_pages_only_have_a_dictionary_too(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" + " ".join(f"word{j % 700}x{i % 3}" for j in range(9000))) for i in range(12)]
    assert all(len(html) > op.SAMPLE_PAGE_BYTES for _, _, html in rows)
    pages = spark.createDataFrame(rows + rows[:5] * 3, "page_id long, url string, html string").repartition(4)
    dictionary = op.sample_dictionary(pages)
    assert dictionary and dictionary == op.sample_dictionary(pages.repartition(2)) and op.sample_dictionary(pages, 3) == op.sample_dictionary(pages, 3)


def test_archives_are_read_by_several_tasks(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 60) for i in range(300)], "page_id long, url string, html string").repartition(4)
    folder = shared_folder(spark, "test-archives")
    index = op.write_archives(pages, folder, archive_bytes=8000)
    assert index.select("archive").distinct().count() > 10
    back = op.read_archives(index, folder, strict=True)
    assert back.select(F.spark_partition_id()).distinct().count() > 1 and back.count() == 300


def test_broken_records_are_an_error(spark, tmp_path):
    archive = op.Archive(b"")
    archive.add(op.page_record(1, "u", b"payload", "A" * 32, None))
    (tmp_path / "part-00000-0000.warc.zst").write_bytes(archive.out.getvalue())
    index = spark.createDataFrame([(str(tmp_path / "part-00000-0000.warc.zst"),)], "archive string")
    assert [r["intact"] for r in op.read_archives(index, f"file:{tmp_path}").collect()] == [False]
    with pytest.raises(Exception, match="not what its header says"):
        op.read_archives(index, f"file:{tmp_path}", strict=True).collect()
