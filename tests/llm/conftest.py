import random

import pytest

SYLLABLES = "ka lo mi ren tu sal ve dor pin ash el gra".split()


@pytest.fixture(scope="session")
def prose():
    """A function that makes n invented words from a seed."""
    def make(n, seed):
        r = random.Random(seed)
        return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(2, 4))) for _ in range(n)]
    return make


@pytest.fixture
def table(spark):
    """Documents with nulls everywhere, empty and odd texts, repeated rows and columns whose names clash with the operators'."""
    def make(texts):
        rows = [(i, t, None if i % 7 == 3 else "en", None if i % 5 == 4 else f"s{i % 3}", 0, "x", 1.5) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int, id string, kept double")
    return make
