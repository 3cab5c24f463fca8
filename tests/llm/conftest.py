import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        *[T.StructField(n, T.StringType()) for n in ("score", "token", "shard", "size", "n_words", "hit_items", "place", "maybe")],
    ]
)
EXTRA = ("s", "t", "x", "y", "z", "w", "p", "m")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text[, source])."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and very long texts, ties, copies, repeated rows."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    longest = sentence(rng, 30_000, 5_000)
    return [
        (1, base, "a"),
        (2, base, "a"),
        (3, base + " tail", "a"),
        (4, None, "a"),
        (5, "", None),
        (6, " \n\t ", None),
        (7, "one", "b"),
        (7, "one", "b"),
        (8, "Ünï çödé — 漢字 🙂 " * 40, "c"),
        (9, longest, "c"),
        (10, longest + " end", None),
        (None, "no id at all", "a"),
        (11, "a" * 1000, "b"),
        (12, "THIS IS SHOUTING!!! YOU IDIOT, YOU MORON!!!", "b"),
    ]
