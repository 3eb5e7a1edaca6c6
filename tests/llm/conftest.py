import random

import pytest

#: Columns that operators must carry along or ignore, named as some of their own.
EXTRA = ("key", "k", "t", "fp", "line", "word", "raw", "id", "n", "__llm")


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text) as a table with further columns."""

    def make(rows):
        schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in EXTRA)
        return spark.createDataFrame([(k, t, "en", *EXTRA) for k, t in rows], schema).repartition(3)

    return make


def words(rng: random.Random, n: int, vocabulary: int = 2000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
