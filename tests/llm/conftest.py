import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from ``(id, text)`` pairs, with columns whose names the operators use themselves."""

    def make(rows):
        df = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)
        clashing = ("words", "key", "rep", "n", "seed", "at", "spans", "m", "kept", "start", "item_id", "bands", "set_hash", "component_id", "n_words")
        return df.select("*", *[F.lit(k).alias(name) for k, name in enumerate(clashing)])

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, short, repeated and very long texts."""
    rng = random.Random(5)
    long = " ".join(rng.choice(("the", "red", "fox", "ran", "over", "hills", "and", "slept")) + str(rng.randint(0, 9)) for _ in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d"), (6, "same text here"), (7, "same text here"), (7, "same text here"), (None, "no id"), (8, long), (9, "x" * 100_000), (10, "É ü \x1c z\x0by")]
