import random

import pytest

from tidemark.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n_words string, node string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    queries.ship(spark)


def prose(seed, n, vocabulary=300):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def docs_of(spark):
    """A documents table with columns whose names operators use inside."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", None, None, "x", "y", "z") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
