"""A corpus from raw documents to packed sequences; each stage keeps the columns of documents but the last.

Defined cases are those of the operators. A stage reads nothing but its predecessor's rows, and the
benchmark table for decontamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm import decontaminate, language, near, packing, repeats
from gridseries.llm.queries import tokenizer_path
from gridseries.llm.tables import remove_folder, set_aside, shared_folder, ship_package, table, temporary


# 51 words of prose have 313 bytes at the median, and 240 or more in 99.5 of 100 places
REPEAT_BYTES = 240
LEAST_WORDS = 51


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, with the language that fits best as lang.

    Only a document without a letter is rejected: the score of a clean text that mixes languages, or of any
    text among many languages, may be low. The network learns from the documents that have a lang; if none
    has one, lang is language.UNKNOWN.
    """
    ship_package(spark)
    net = language.fit(docs.select("text", "lang"))
    apart, restore = set_aside(docs, "text", "lang")
    found = language.with_language(apart, net)
    kept = found.where(F.col("text").rlike(r"\p{L}"))
    return restore(kept.withColumn("lang", F.col("lang_pred")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id."""
    ship_package(spark)
    apart, restore = set_aside(docs, "doc_id", "text")
    return restore(near.one_of_each(apart))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that occur elsewhere; a document of which nothing is left goes.

    REPEAT_BYTES is shorter than nearly all passages of that many words, so that those are found, and LEAST_WORDS
    leaves shorter ones alone. A cut may fall within a character; such broken bytes are dropped. n_chars counts
    the new text.
    """
    ship_package(spark)
    apart, restore = set_aside(docs, "doc_id", "text", "n_chars")
    cut = repeats.without_repeats(apart, REPEAT_BYTES, LEAST_WORDS, as_text=True)
    shorter = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(shorter, F.col("kept")).otherwise(F.col("text"))).where(~shorter | (F.length("text") > 0))
    return restore(cut.withColumn("n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars"))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    apart, restore = set_aside(docs, "text")
    return restore(decontaminate.remove_contaminated(apart, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their token ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# training, hashing and packing are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written and read again before the next.

    What a stage has read, and the tables it wrote for itself, are removed once its result is there.
    """
    docs = table(spark, sf_dir, "documents")
    folder, before = shared_folder(spark, "pipeline"), None
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if before:
            remove_folder(spark, before)
        before = out
    return docs
