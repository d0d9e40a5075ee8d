import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridseries.llm import flat, tables
from gridseries.sinks.files import exists


def test_set_aside_restores_any_names(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "x")], ["doc_id", "text", "Score", "score "])
    apart, restore = tables.set_aside(df, "doc_id", "text")
    assert apart.columns == ["doc_id", "text", "_column2", "_column3"]
    back = restore(apart.withColumn("score", F.lit(1)))
    assert back.columns == df.columns and back.collect() == df.collect()


def test_stored_rows_outlive_their_source_until_dropped(spark):
    rows = tables.stored(spark.range(5), "test")
    folder = tables._written[-1]
    assert rows.count() == 5 and exists(spark, folder)
    tables.drop_stored(spark)
    assert not exists(spark, folder) and not tables._written


def test_remainder_is_that_of_the_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 123456789012, None)], "doc_id long")
    got = rows.select("doc_id", tables.remainder("doc_id", 10).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 for r in got)


def test_pieces_follow_the_texts(spark):
    rows = spark.createDataFrame([("é" * 50,), (None,)], "text string")
    assert tables.pieces(rows, 30, 1, "text") == 4 and tables.pieces(rows, 30, 9, "text") == 9
    assert tables.pieces(rows.limit(0), 30, 1, "text") == 1


def test_slices_keep_all_rows_and_long_texts_whole():
    texts = ["a" * n for n in (3, 0, 5, 40, 2, 2, 2)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(flat.slices(iter([batch, batch.slice(0, 0)]), "text", 6))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(sum(len(t or "") for t in p.column(0).to_pylist()) <= 6 or p.num_rows == 1 for p in parts)
    data, offsets = flat.flatten(batch.column(0).slice(2, 3))
    assert data.tobytes() == b"a" * 47 and offsets.tolist() == [0, 5, 45, 47]


@pytest.mark.parametrize("texts", [["ab, c", "", "d-e f", None, "g"], [""], [None], []])
def test_words_do_not_cross_rows(texts):
    inside = np.zeros(256, bool)
    inside[97:123] = True
    data, offsets = flat.flatten(pa.array(texts, pa.string()))
    starts, ends, first = flat.word_spans(data, offsets, inside)
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    want = [[w for w in (t or "").replace(",", " ").replace("-", " ").split()] for t in texts]
    assert found == [w for t in want for w in t] and np.diff(first).tolist() == [len(t) for t in want]


def test_a_worker_may_start_with_no_bytes(monkeypatch):
    monkeypatch.setattr(flat, "_powers", {})
    nothing = np.zeros(0, np.uint8)
    assert len(flat.span_hash(flat.prefix_hash(nothing), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    sums = flat.prefix_hash(data)
    h = flat.span_hash(sums, np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert h[0] == h[1] != h[2]
    up, down = flat.powers(flat.SLICE_BYTES + 10)
    assert ((up * down) == 1).all()


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    from gridseries.llm import tables
    before = spark.conf.get(tables.BATCH_SETTING)
    try:
        spark.conf.unset(tables.BATCH_SETTING)
        assert spark.conf.get(tables.BATCH_SETTING) == tables.SPARK_BATCH_BYTES
        tables.ship_package(spark)
        assert spark.conf.get(tables.BATCH_SETTING) == tables.BATCH_BYTES
        spark.conf.set(tables.BATCH_SETTING, "1m")
        tables.ship_package(spark)
        assert spark.conf.get(tables.BATCH_SETTING) == "1m"
    finally:
        spark.conf.set(tables.BATCH_SETTING, before)
