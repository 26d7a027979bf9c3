"""Small documents with the cases every operator must take."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta river stone cloud paper green quiet window market".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(400)}" for _ in range(n))


EDGES = [
    (1, prose(1, 120), "en", "a", 10),
    (2, prose(1, 120), "en", "a", 10),
    (2, prose(1, 120), "en", "a", 10),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (None, prose(2, 80), "en", None, 1),
    (5, " \n\t\r\n ", "en", "b", 6),
    (6, prose(3, 30_000), "de", "b", 1),
    (7, "one two", "de", "b", 7),
    (8, "Ünï ▁ café 日本語 \U0001f600 don't\x00 | <|im_end|> \\", "de", "b", 1),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, edges):
    """The same rows with columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = (
        "n_words n_tokens kept class_id rep band value hub own its score rank copies rate host "
        "salt dropped _row _host _salt _dropped _text _words _features _p s x p cell n h1 h2 "
        "sketch start labels stats"
    ).split()
    return edges.select("*", *[F.lit(f"?{n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
