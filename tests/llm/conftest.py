from __future__ import annotations

import random

import pytest
from helpers_llm import frame, words


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(4)
    passage, long = words(rng, 60, 500), words(rng, 20_000, 5000)
    return [
        (1, passage, "en", "a"), (2, words(rng, 5) + " " + passage + "\t\x0b" + words(rng, 9), "en", "b"), (3, None, "en", "a"),
        (4, "", None, None), (5, long, "de", "a"), (6, long + " end", "de", "a"), (7, " \n\t ", "de", "b"),
        (8, "one two", "fr", None), (9, "One two", "fr", "b"), (10, "one TWO", "fr", "c"), (11, "ONE two", "fr", "c"),
        (None, passage, "en", "a"), (None, None, None, None), (2, words(rng, 5) + " " + passage, "en", "b"), (1, passage, "en", "a"),
        (12, "é" * 3000 + " 🙂 ### !!!", "es", "d"), (13, words(rng, 12), "es", "d"), (14, words(rng, 13), "es", "d"),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return frame(spark, awkward_rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
