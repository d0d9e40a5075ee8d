import random

import pytest

from gridseries.llm.tables import ship_package

SYLLABLES = ["th", "er", "on", "an", "re", "nd", "ea", "ti", "ha", "st", "sh", "ing"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def words():
    def make(n, seed=0, vocabulary=200):
        rng = random.Random(seed)
        known = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(vocabulary)]
        return [rng.choice(known) for _ in range(n)]
    return make


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text), with a column that several operators also use as a name of their own."""
    def make(rows, parts=3):
        full = [(i, text, "x", 0.5) for i, text in rows]
        return spark.createDataFrame(full, "doc_id long, text string, spans string, score double").repartition(parts)
    return make

