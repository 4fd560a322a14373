import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_of():
    """documents from (doc_id, text) rows, with a column more whose name clashes with results."""

    def make(spark: SparkSession, rows, **more):
        rows = [(i, t, "en", "src0", len(t) if t is not None else None, 0.5) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")

    return make


WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls read old maps near cold rivers under pale moon light".split()


@pytest.fixture(scope="session")
def prose():
    import random

    def make(seed: int, n: int = 120) -> str:
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))

    return make
