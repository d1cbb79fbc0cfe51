"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models are counted, one over toxic and one over ordinary labelled texts. Counts are
discounted absolutely and back off: a bigram to the number of different words its second word
follows in the class (the Kneser-Ney continuation count), and that to the same number over both
classes. The classes differ in size, so a discount is as large a part of each; what it takes away
goes to the next lower order by one weight that both classes share, the mass both together lose.
So an expression too rare to tell the classes apart has equal probabilities in them.

A text's words have log-likelihood ratios, toxic over ordinary. Their median is what the text's
language and subject make of it; what each word has beyond the median and one unit more, averaged
over the length, is the text's measure, and a logistic curve turns it into a score.

Counting covers all labelled rows and grows with them: tasks sum their word pairs before the
shuffle, so a frequent pair weighs one record a task. What goes to all tasks doesn't grow: words
are hashed to 2 ** WORD_BITS, and what pairs keep beyond their discounts is added up in 2 ** CELL_BITS
cells for each class. The discounts are the same at every size: a pair's mass depends on its own counts and
its first word's, not on how much other text there is. The curve alone is fitted on a bounded sample: about CURVE_ROWS of
the labelled rows, chosen by a hash of the text. (They are counted too; the discounts leave too
little of a text's own expressions to bend the curve.)

Words are runs of letters, A-Z lower-cased; everything else stands between words. Defined cases: a
null text, or one without words, has the score of a text with nothing beyond its median; rows
without a label aren't learned from; a doc_id with several labels learns each; without labels of
both classes the score is 1 if there are toxic ones only, else 0; repeated rows count each time;
extra columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .packed import by_bucket, buckets, is_small, kinds_of, pack, ready, run_starts, stored, unpack_all
from .words import as_bytes, chunks, mix, word_codes

WORD_BITS = 18
CELL_BITS = 21
UNIT = 2.0**40  # of kept probabilities, which are added up as whole numbers: sums don't depend on their order
WORD_DISCOUNT = 2
PAIR_DISCOUNT = 32
BEYOND = 1.0
CURVE_ROWS = 20_000
_BLOCK = 14
_LOW = (1 << WORD_BITS) - 1

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pairs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word (0: the start of a text), second word and text of every bigram, in order."""
    codes, at = word_codes([t.translate(_LETTERS) for t in texts])
    second = (codes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    first = np.concatenate(([0], second[:-1])) if len(second) else second
    first[at[:-1][at[:-1] < len(second)]] = 0
    return first, second, np.repeat(np.arange(len(texts)), np.diff(at))


def pair_cell(pair: np.ndarray) -> np.ndarray:
    return (mix(pair.view(np.uint64)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def sum_by(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    starts = run_starts(key[order])
    return key[order][starts], np.add.reduceat(times[order], starts) if len(starts) else times[:0]


@dataclass
class Model:
    lower: np.ndarray  # by class (ordinary, toxic) and word: the probability without context
    backoff: np.ndarray  # by first word: the weight of that
    kept: np.ndarray  # by class and cell: the probability a pair keeps beyond it
    curve: np.ndarray

    def measure(self, texts: list[bytes]) -> np.ndarray:
        """What each text has beyond its median, by length."""
        out = np.zeros(len(texts))
        for a, b in chunks(texts, 1 << 20):
            first, second, text = pairs_of(texts[a:b])
            if not len(first):
                continue
            cell, weight = pair_cell(first << WORD_BITS | second), self.backoff[first]
            odds = (self.kept[1][cell] + weight * self.lower[1][second]) / (self.kept[0][cell] + weight * self.lower[0][second])
            ratio = np.log(odds).astype(np.float32)
            count = np.bincount(text, minlength=b - a)
            ordered = ratio[np.lexsort((ratio, text))]
            start = np.cumsum(count) - count
            median = np.zeros(b - a, np.float32)
            some = count > 0
            median[some] = ordered[(start + count // 2)[some]]
            beyond = np.maximum(ratio - median[text] - BEYOND, 0)
            out[a:b] = np.bincount(text, weights=beyond, minlength=b - a) / np.maximum(count, 1)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return logistic(features(self.measure(texts)) @ self.curve)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def features(measure: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(measure)), np.log(measure + 0.002) - np.log(0.015)])


def fit_curve(measure: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method; a weak prior keeps the slope up and finite where rows are few or the classes part."""
    usual = np.array([0.0, 3.0])
    x, w = features(measure), usual.copy()
    pull = np.diag([1e-2, 0.5])
    for _ in range(100):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (toxic - p) - pull @ (w - usual))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def build(follows: np.ndarray, tokens: np.ndarray, lost: np.ndarray, kept: np.ndarray) -> Model:
    """The model of class sums. ``lost``: by first word, how many pair counts both discounts take; ``kept``: by class and cell, the rest."""
    sizes = np.maximum(follows.sum(axis=1), 1)[:, None]
    discount = WORD_DISCOUNT * sizes / sizes.min()
    shared = follows.sum(axis=0) + 1.0
    weight = np.minimum(follows.sum(axis=0), discount.sum()).sum() / sizes.sum()
    lower = np.maximum(follows - discount, 0) / sizes + max(weight, 1e-6) * shared / shared.sum()
    total = tokens.sum(axis=0)
    backoff = np.where(total > 0, lost / np.maximum(total, 1), 1.0)
    return Model(lower, np.clip(backoff, 0.02, 1), kept.astype(np.float32), np.array([-30.0, 0.0]))


def _count(labelled: DataFrame, least: np.ndarray) -> pd.DataFrame:
    """Sums over all labelled texts as packed blocks: name, cell. ``least``: a pair's discount in each class."""
    parts = buckets(labelled.sparkSession, 1)

    def gather(batches: Iterator[pd.DataFrame]):
        held, size = [], 0

        def emit():
            key, times = sum_by(*(np.concatenate(x) for x in zip(*held)))
            return by_bucket(((key >> WORD_BITS) & _LOW) % parts, key, times.astype(np.uint32))

        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            kind = batch["toxic"].to_numpy(np.int64)
            for a, b in chunks(texts):
                first, second, text = pairs_of(texts[a:b])
                key = kind[a:b][text] << 2 * WORD_BITS | first << WORD_BITS | second
                held.append(sum_by(key, np.ones(len(key), np.int64)))
                size += len(held[-1][0])
            if size > 3_000_000:
                yield emit()
                held, size = [], 0
        if size:
            yield emit()

    def sums(frame: pd.DataFrame) -> pd.DataFrame:
        key, times = sum_by(*unpack_all(frame["cell"], np.int64, np.uint32))
        times = times.astype(np.int64)
        out = []

        def add(name: str, index: np.ndarray, value: np.ndarray):
            index, value = sum_by(index, value)
            found = by_bucket(index >> _BLOCK, index, value)
            found["name"] = name
            out.append(found)

        kind, pair = key >> 2 * WORD_BITS, key & ((1 << 2 * WORD_BITS) - 1)
        add("follows", kind << WORD_BITS | pair & _LOW, np.ones(len(key), np.int64))
        add("tokens", kind << WORD_BITS | pair >> WORD_BITS, times)
        # Both classes together lose a pair's count up to both discounts.
        both, either = sum_by(pair, times)
        add("lost", both >> WORD_BITS, np.minimum(either, int(least.sum())))
        # A bucket holds all pairs of its first words, so their totals are known here.
        more = times > least[kind]
        _, which = np.unique(kind << WORD_BITS | pair >> WORD_BITS, return_inverse=True)
        total = np.bincount(which, weights=times)[which]
        share = np.rint((times - least[kind])[more] / total[more] * UNIT).astype(np.int64)
        add("kept", kind[more] << CELL_BITS | pair_cell(pair[more]), share)
        return pd.concat(out)[["name", "bucket", "cell"]]

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        index, value = sum_by(*unpack_all(frame["cell"], np.int64, np.int64))
        return pd.DataFrame({"name": [frame["name"].iloc[0]], "cell": [pack(index, value)]})

    return (
        labelled.mapInPandas(gather, "bucket bigint, cell binary")
        .groupBy("bucket")
        .applyInPandas(sums, "name string, bucket bigint, cell binary")
        .groupBy("name", "bucket")
        .applyInPandas(total, "name string, cell binary")
        .toPandas()
    )


def _model(rows: pd.DataFrame) -> Model:
    def sparse(name: str) -> tuple[np.ndarray, np.ndarray]:
        return tuple(unpack_all(rows["cell"][rows["name"] == name], np.int64, np.int64))

    def dense(name: str, size: int) -> np.ndarray:
        out = np.zeros(size)
        index, value = sparse(name)
        out[index] = value
        return out

    follows, tokens = (dense(n, 2 << WORD_BITS).reshape(2, -1) for n in ("follows", "tokens"))
    kept = dense("kept", 2 << CELL_BITS).reshape(2, -1) / UNIT
    return build(follows, tokens, dense("lost", 1 << WORD_BITS), kept)


def train(docs: DataFrame, labels: DataFrame, curve_rows: int = CURVE_ROWS) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic (0, 1 or null). Only rows with both are learned from."""
    spark = ready(docs.sparkSession)
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    # Few labels go to the texts; many meet them in a shuffle, whose result is written, as it is read three times.
    few = is_small(marked)
    labelled = texts.join(F.broadcast(marked) if few else marked, "doc_id").select("text", "toxic")
    labelled = labelled if few else stored(labelled, "toxicity-labelled")
    sizes = labelled.groupBy("toxic").agg(F.sum(F.length("text")).alias("size"), F.count("*").alias("n")).toPandas()
    kinds = set(sizes["toxic"])
    if kinds != {0, 1}:
        flat = build(np.zeros((2, 1 << WORD_BITS)), np.zeros((2, 1 << WORD_BITS)), np.zeros(1 << WORD_BITS), np.zeros((2, 1 << CELL_BITS)))
        flat.curve = np.array([30.0 if kinds == {1} else -30.0, 0.0])
        return flat

    size = np.array([max(1, sizes["size"][sizes["toxic"] == k].sum()) for k in (0, 1)], np.float64)
    least = np.ceil(PAIR_DISCOUNT * size / size.min()).astype(np.int64)
    model = _model(_count(labelled, least))
    share = min(1.0, curve_rows / sizes["n"].sum())
    sample = labelled.filter(F.pmod(F.xxhash64(F.lit("row"), "text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    sent = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            yield pd.DataFrame({"measure": sent.value.measure([as_bytes(t) for t in batch["text"]]), "toxic": batch["toxic"]})

    seen = sample.mapInPandas(measure, "measure double, toxic int").toPandas()
    seen = seen.sort_values(["measure", "toxic"])  # sums don't depend on the order rows arrive in
    model.curve = fit_curve(seen["measure"].to_numpy(), seen["toxic"].to_numpy(np.float64))
    return model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The ``keep`` columns and the score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = list(keep)

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            out = batch[kept].copy()
            out[name] = sent.value.scores([as_bytes(t) for t in batch["_text_to_score"]])
            yield out

    chosen = docs.select(*(F.col(f"`{k}`") for k in kept), F.col("text").cast("string").alias("_text_to_score"))
    return chosen.mapInPandas(run, f"{kinds_of(docs, kept)}, `{name}` double")
