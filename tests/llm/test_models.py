"""Classifiers: held-out accuracy, and defined results on awkward input."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from helpers_llm import frame, words
from signalmill.llm import catalog, langid, packed, quality, toxicity

SF_DIR = "/root/testdata/sf0.1"
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def held_out(spark, name, label):
    rows = catalog.QUERIES[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", label)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    got = rows.filter("held_out").join(labels, "doc_id").toPandas()
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    return got["predicted"].to_numpy(), got[label].to_numpy()


@tables
def test_toxicity_held_out(spark):
    said, true = held_out(spark, "op10_toxicity", "toxic")
    assert said[true == 1].mean() > 0.85 and said[true == 0].mean() < 0.05


@tables
def test_quality_held_out(spark):
    said, true = held_out(spark, "op3_quality", "quality")
    assert said[true == 1].mean() > 0.97 and said[true == 0].mean() < 0.15


@tables
def test_language_held_out(spark):
    got = catalog.QUERIES["op6_language_id"](spark, SF_DIR)
    true = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = got.filter("held_out").join(true, "doc_id").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.99 and got["score"].between(0, 1).all()


def learned(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(80):
        bad = i % 4 == 0
        rows.append((i, words(rng, 80) + (" slur vile" * 4 if bad else "") + (" ###" * 30 if i % 5 == 0 else ""), "en", "a"))
        labels.append((i, int(i % 5 != 0), int(bad), "x"))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_awkward_texts(spark, awkward, nothing, module, label):
    docs, labels = learned(spark)
    extra = spark.createDataFrame([(None, 1, 1, "x"), (5, None, None, "x"), (77777, 1, 1, "x")], labels.schema)
    model = module.train(docs, labels.union(extra))
    rows = module.score(awkward, model, ("doc_id", "score"), "found").collect()
    assert len(rows) == awkward.count() and all(0 <= r["found"] <= 1 for r in rows) and {r["score"] for r in rows} == {"x"}
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(round(r["found"], 9))
    assert by[3] == by[4] == by[7] and len(by[1]) == 1
    assert module.score(nothing, model).count() == 0
    seen = {r["doc_id"]: r["score"] for r in module.score(docs, model).collect()}
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    high = np.mean([seen[i] for i in truth if truth[i] == 1])
    assert high > np.mean([seen[i] for i in truth if truth[i] == 0]) + 0.3


def test_many_labels_give_the_same_models(spark, monkeypatch):
    docs, labels = learned(spark)
    few = toxicity.train(docs, labels)
    monkeypatch.setattr(packed, "SMALL_ROWS", 0)
    many = toxicity.train(docs, labels)
    assert np.array_equal(few.lower, many.lower) and np.allclose(few.curve, many.curve)


@pytest.mark.parametrize("module, label, value", [(toxicity, "toxic", 0.0), (quality, "quality", 0.5)])
def test_without_labels(spark, awkward, module, label, value):
    none = spark.createDataFrame([], f"doc_id bigint, {label} int")
    got = module.score(awkward, module.train(awkward, none)).collect()
    assert all(abs(r["score"] - value) < 1e-6 for r in got)


def test_toxicity_of_one_class_only(spark, awkward):
    ones = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert all(r["score"] > 0.99 for r in toxicity.score(awkward, toxicity.train(awkward, ones)).collect())


def test_language_of_awkward_texts(spark, awkward, nothing):
    got = langid.identify(awkward, awkward, ("doc_id", "home")).collect()
    assert len(got) == awkward.count()
    for r in got:
        if r["doc_id"] in (3, 4, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in {"en", "de", "fr", "es"} and 0 < r["score"] <= 1
    assert all(r["lang_pred"] == "und" for r in langid.identify(awkward, nothing).collect())
    assert langid.identify(nothing, awkward).count() == 0


def test_language_counts_and_scores_match_brute_force(spark):
    texts = [("Ab c1ä", "x"), ("ba  CB", "y"), ("äää", "x")]
    model = langid.train(frame(spark, [(i, t, la, "s") for i, (t, la) in enumerate(texts)]))
    logs, grams = langid.score_texts(["ab", None, "1 2"], model[1])
    hashes = [h for _, hs in langid.hashed_ngrams(["ab"]) for h in hs]
    assert model[0] == ["x", "y"] and len(hashes) == grams[0] == 3 and list(grams[1:]) == [0, 0]
    assert np.allclose(logs[0], model[1][:, hashes].sum(axis=1))


def test_more_languages_than_allowed_are_refused(spark):
    docs = frame(spark, [(i, "a", f"l{i}", "s") for i in range(5)])
    with pytest.raises(ValueError):
        langid.train(docs, most=4)


def test_a_long_text_in_pieces_counts_as_one(monkeypatch):
    text = "Lange Texte werden in Stücken gezählt. " * 40
    whole = np.sort(np.concatenate([h for _, h in langid.hashed_ngrams([text])]))
    monkeypatch.setattr(langid, "_PIECE", 100)
    rows = [langid.hashed_ngrams(held) for _, held in langid._pieces([text])]
    parts = np.concatenate([h for piece in rows for _, h in piece])
    assert abs(len(parts) - len(whole)) <= 3 * len(rows)


def test_language_keeps_dotted_columns(spark):
    from signalmill.llm import langid

    docs = spark.createDataFrame([(1, "ein kleiner text", "de", 5), (2, "a small text", "en", 6)], "doc_id bigint, text string, lang string, `a.b` int")
    got = langid.identify(docs, docs, ("doc_id", "a.b"))
    assert got.columns[:2] == ["doc_id", "a.b"] and sorted(r["a.b"] for r in got.collect()) == [5, 6]


def test_a_pair_keeps_its_mass_when_other_text_is_added(spark, monkeypatch):
    """The same share of both classes more: a pair's own counts decide, not how much text there is."""
    from signalmill.llm.toxicity import pair_cell, pairs_of

    rare = [(i, "you zoxfool " * 3 + "go away", "en", "a") for i in range(30)]
    plain = [(100 + i, "the river runs past the old mill " * 3, "en", "a") for i in range(30)]
    more = [(1000 + i, f"word{i % 97} other{i % 89} thing{i % 83} " * 6, "en", "a") for i in range(600)]
    first, second, _ = pairs_of([b"you zoxfool"])
    cell = pair_cell(first << toxicity.WORD_BITS | second)[1]
    kept = []
    for rows in (rare + plain, rare + plain + more):
        labels = [(r[0], int(r[0] < 100 or (r[0] >= 1000 and r[0] % 2))) for r in rows]
        model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        kept.append(float(model.kept[1][cell]))
    # 90 of the 90 pairs after "you", less the discount; the classes' sizes move that by their ratio only.
    assert kept[0] > 0.3 and abs(kept[1] - kept[0]) < 0.35 * kept[0]
    monkeypatch.setattr(toxicity, "PAIR_DISCOUNT", 0)
    model = toxicity.train(frame(spark, rare + plain), spark.createDataFrame([(r[0], int(r[0] < 100)) for r in rare + plain], "doc_id bigint, toxic int"))
    assert abs(float(model.kept[1][cell]) - 1.0) < 1e-6


def test_quality_counts_all_documents_and_bounds_its_sample(spark):
    rows = [(i, f"alpha beta g{i}", "en", "a") for i in range(40)] + [(7, "alpha", "en", "a")] * 300 + [(None, None, "en", "a")]
    docs = frame(spark, rows)
    n, held = quality.document_frequencies(docs)
    by_hand = sum((quality.counts([(t or "").encode()])[0] > 0).astype(int) for _, t, *_ in rows)
    assert n == len(rows) and (held == by_hand).all()
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    assert len(model.labels) == 41  # a repeated row is learned from once
    assert np.allclose(model.weight, np.log((1 + n) / (1 + held)) + 1)
    assert len(quality.train(docs, labels, each_label=5).labels) < 25
