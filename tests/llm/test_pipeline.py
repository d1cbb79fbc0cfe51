"""The stages, one after another and on awkward rows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from signalmill.llm import catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    kept = P.drop_toxic(spark, docs, SF_DIR).cache()
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 and kept.count() < docs.count()
    single = P.drop_near_copies(spark, kept, SF_DIR).cache()
    assert single.columns == docs.columns and single.exceptAll(kept).count() == 0
    from signalmill.llm.minhash_dedup import near_duplicates

    groups = near_duplicates(kept, P.NEAR_PERCENT).select("component_id").distinct().count()
    assert single.count() == groups and near_duplicates(single, P.NEAR_PERCENT).filter("NOT kept").count() == 0
    hidden = P.pseudonymize(spark, single, SF_DIR).cache()
    assert hidden.columns == docs.columns and hidden.count() == single.count()
    mixed = P.mix_sources(spark, hidden, SF_DIR).cache()
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().exceptAll(hidden.select("doc_id")).count() == 0
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    tokens = P.encode(spark, mixed, SF_DIR)
    assert tokens.count() == mixed.count() and tokens.columns == ["doc_id", "source", "n_tokens", "ids"]


def test_near_copies_of_080_go(spark):
    import random

    from helpers_llm import frame, words
    from test_dedup import components_by_hand

    rng, rows = random.Random(5), []
    for group in range(12):  # a change takes 5 of 146 shingles: three leave 0.81, four 0.76
        base = words(rng, 150, 100_000).split()
        rows.append((10 * group, " ".join(base), "en", "a"))
        for i, changes in enumerate((3, 4, group % 4)):
            copy = list(base)
            for at in range(changes):
                copy[20 + 30 * at] = f"n{group}_{i}_{at}"
            rows.append((10 * group + i + 1, " ".join(copy), "en", "a"))
    left = sorted(r["doc_id"] for r in P.drop_near_copies(spark, frame(spark, rows), SF_DIR).collect())
    by_hand = {percent: sorted(r[0] for r in components_by_hand(rows, percent) if r[3]) for percent in (80, 85)}
    assert left == by_hand[80] != by_hand[85]


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "bpe"]
    out = P.run(spark, SF_DIR)
    again = P.run(spark, SF_DIR)
    assert out.count() > 0 and sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in again.collect())


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_on_awkward_and_no_rows(spark, awkward, nothing, name, stage):
    assert stage(spark, nothing, SF_DIR).count() == 0
    out = stage(spark, awkward, SF_DIR)
    rows = out.collect()
    if name != "bpe":
        assert out.columns == awkward.columns
    if name == "near_dedup":
        ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
        assert len(ids) == len(set(ids)) and 8 in ids and 10 not in ids and 6 not in ids
        assert sum(r["doc_id"] is None for r in rows) == 2
    if name in ("pii", "bpe"):
        assert len(rows) == awkward.count()


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(catalog.ORACLES) <= set(entry.oracle_sql())
