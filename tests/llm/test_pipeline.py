import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import language as op
from gridseries.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"


@pytest.fixture
def folder(spark, words, tmp_path):
    rows, shared = [], " ".join(words(80, 77, 4000))
    german = ["schein", "über", "ung", "zu", "heit"]
    for i in range(60):
        text = " ".join(words(120, i, 4000)) if i % 3 else " ".join(german[(i * k + k * k) % 5] + str((i + 7) * k) for k in range(100))
        rows.append((i, text, "de" if i % 3 == 0 else "en"))
    rows[10] = (10, rows[11][1] + " tail", "en")
    rows[13] = (13, rows[13][1] + " " + shared + " x", "en")
    rows[14] = (14, "y " + shared + " " + rows[14][1], "en")
    rows[16] = (16, rows[16][1] + " " + " ".join(words(25, 99, 4000)), "en")
    rows += [(100, None, None), (101, "", "en"), (102, "?! 12", "en"), (1, rows[1][1], "en")]
    full = [(i, t, lang, "s", None if t is None else len(t), 0.5, "k") for i, t, lang in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(words(25, 99, 4000)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_one_by_one(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before = docs.columns
        stage(spark, docs, folder).write.parquet(str(tmp_path / f"out{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out{i}"))
        if name != "packing":
            assert docs.columns == before
            kept.append({r["doc_id"]: r for r in docs.collect()})
            assert len(kept[-1]) == docs.count() or name == "language"
    language, near, repeats, clean = kept
    assert {100, 101, 102}.isdisjoint(language) and len(language) >= 58
    # 10 is a near-duplicate of 11, and the repeated row of 1 went
    assert 11 not in near and 10 in near and len(near) == len(language) - 1
    assert len(repeats[13]["text"]) < len(near[13]["text"]) and repeats[13]["n_chars"] == len(repeats[13]["text"])
    assert repeats[17]["text"] == near[17]["text"] and set(repeats) == set(near)
    assert 16 not in clean and set(clean) == set(repeats) - {16}
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(clean)


def test_only_documents_without_a_letter_are_rejected(spark, words, monkeypatch):
    """Not those whose best language is unsure, as in a mixed text or among many languages."""
    rows = [(i, " ".join(words(60, i)), "en", "s", 1, 0.5, "k") for i in range(20)]
    docs = spark.createDataFrame([*rows, (20, "12 ?!", "en", "s", 1, 0.5, "k"), (21, None, "en", "s", 1, 0.5, "k")], SCHEMA)

    def flat(examples, **_):
        return op.Network([f"l{k}" for k in range(20)], op.Gru.new(np.random.default_rng(0), 2), op.Gru.new(np.random.default_rng(0), 2),
                          np.zeros((4, 20), np.float32), np.zeros(20, np.float32))

    monkeypatch.setattr(op, "train", flat)
    assert {r["doc_id"] for r in pipeline.identify_language(spark, docs, "").collect()} == set(range(20))
    monkeypatch.undo()
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.identify_language(spark, unlabelled, "").where("lang = 'und'").count() == 20


def test_run_is_the_stages(spark, folder):
    packed = pipeline.run(spark, folder)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024
    assert pipeline.ORACLE_SQL is None


def test_empty_documents(spark, folder, tmp_path):
    empty = tmp_path / "empty"
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(empty / "benchmark.parquet"))
    assert pipeline.run(spark, str(empty)).isEmpty()


def test_every_operator_has_one_query():
    numbers = sorted(int(name.split("_")[0].removeprefix("op")) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
