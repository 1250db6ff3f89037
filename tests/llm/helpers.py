"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (0, None, "en", "a", 0),
    (1, "", None, "a", 0),
    (2, " \t\n\x0b\x0c\r ", "en", None, 7),
    (3, "x", "en", "b", 1),
    (None, "a row without an id", "en", "b", 19),
    (4, "the same words", "en", "a", 14),
    (4, "the same words", "en", "a", 14),
    (5, "The  same words", None, None, 15),
    (6, "emoji 😀 and é and   and 日本語 <|endoftext|> \\### end", "en", "b", 40),
]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    names = ["".join(random.Random(i).choices("abcdefghilmnoprstu", k=2 + i % 7)) for i in range(vocabulary)]
    return " ".join(rng.choice(names) for _ in range(words))


def awkward(spark, more=()):
    """The awkward documents, some long ones, and columns named like outputs and helpers of the operators."""
    from pyspark.sql import functions as F

    long_text = prose(1, 30_000)
    rows = AWKWARD + [(10, long_text, "en", "a", len(long_text)), (11, long_text + " tail", "en", "a", 1)] + list(more)
    clashing = {name: F.lit(-1) for name in (
        "fp", "kept", "row_id", "keep_id", "score", "component_id", "recipe", "ids", "length", "rule", "bin")}
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).withColumns(clashing)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
