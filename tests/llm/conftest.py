"""Small hand-made tables for the training-data operators."""

import random

import pytest
from pyspark.sql import functions as F

WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "ki", "lo") for b in ("n", "rt", "sk", "lm", "", "nd", "ve", "x")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(3)) * 0 for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) as documents, with columns whose names operators use too."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("score", "shard", "bands", "length", "a", "b", "n", "class_id", "_part", "item_id", "word"):
                df = df.withColumn(name, F.lit("clash"))
        return df.repartition(3)

    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "!!! ..."), (5, "one"), (6, "one"), (6, "one"), (None, "one two"), (None, None),
       (7, prose(1, 30_000)), (8, "é" * 5000), (9, "日本語 テキスト です"), (10, prose(2, 40)), (11, prose(2, 40))]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
