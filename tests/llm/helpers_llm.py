"""Helpers that tests import by name."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, home string, bucket string, "
    "cell string, score string, component string, m_doc string, target string, ids string, _row string, toxic string"
)


def words(rng: random.Random, n: int, size: int = 40) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def frame(spark, rows) -> DataFrame:
    """Documents from (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    full = [(i, t, la, s, None if t is None else len(t), 7, *["x"] * 10) for i, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)
