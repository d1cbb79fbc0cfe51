"""Quality by nearest-neighbour voting among latent-semantic vectors.

A text's features are its hashed words and its hashed character shapes (three characters in a row,
with letters and digits reduced to their kind), as logarithms of counts times inverse document
frequency. Labelled texts make a matrix whose leading right singular vectors turn features into
DIMENSIONS latent ones. The labelled vectors go to all tasks: EACH_LABEL rows of a label at most, so
they are bounded. Every text is compared with all of them by exact cosine, in blocks, and the
NEIGHBOURS nearest vote with the square of their similarity.

Document frequencies are counted over all texts: a task adds up its own, a sum per feature is shuffled. The
matrix is fitted on a sample of labelled rows: about EACH_LABEL of each label, by a hash of doc_id and
text, all of a label that has fewer. Both labels being sampled to the same number, a vote of a label counts
as if they were equally frequent.

Defined cases: a null text is empty; a text without features, or like no labelled one, has the
sample's share of label 1; rows without a label aren't learned from; with no labelled rows all
scores are 0.5; repeated rows are scored alike, and the sample takes one of them; extra columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .packed import join_small, kinds_of, pack, ready, unpack
from .words import as_bytes, word_codes

EACH_LABEL = 2000
DIMENSIONS = 64
NEIGHBOURS = 25
WORD_BITS, SHAPE_BITS = 13, 11
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)
_ROWS, _BYTES = 256, 1 << 20

_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[[*range(97, 123), *range(128, 256)]] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and (size + len(t) > _BYTES or i - at >= _ROWS):
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def counts(texts: list[bytes]) -> np.ndarray:
    """How often each feature stands in each text."""
    codes, at = word_codes([t.lower() for t in texts])
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    words = np.bincount(
        row << WORD_BITS | (codes >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=len(texts) << WORD_BITS
    ).reshape(len(texts), -1)
    shapes = np.zeros((len(texts), 1 << SHAPE_BITS), np.int64)
    for i, t in enumerate(texts):
        s = _SHAPE[np.frombuffer(t, np.uint8)]
        if len(s) >= 3:
            h = ((s[:-2] << np.uint64(16) | s[1:-1] << np.uint64(8) | s[2:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SHAPE_BITS)
            shapes[i] = np.bincount(h.astype(np.int64), minlength=1 << SHAPE_BITS)
    return np.hstack([words, shapes])


@dataclass
class Model:
    weight: np.ndarray  # inverse document frequency by feature
    turn: np.ndarray  # features by dimensions
    vectors: np.ndarray
    labels: np.ndarray

    def vectors_of(self, found: np.ndarray) -> np.ndarray:
        x = np.log1p(found.astype(np.float32)) * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return unit(x @ self.turn)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        # Labels weigh as if they were equally frequent in the sample.
        ones, all_ = self.labels.sum(), len(self.labels)
        weight = np.where(self.labels == 1, 0.5 / max(ones, 1), 0.5 / max(all_ - ones, 1))
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, all_)
        for a, b in _blocks(texts):
            like = self.vectors_of(counts(texts[a:b])) @ self.vectors.T
            near = np.argpartition(-like, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(like, near, 1), 0).astype(np.float64) ** 2 * weight[near]
            total = vote.sum(axis=1)
            out[a:b] = np.where(total > 0, (vote * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), ones / all_)
        return np.clip(out, 0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(size > 1e-6, x / np.maximum(size, 1e-6), 0).astype(np.float32)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts, and in how many each feature stands."""

    def count(batches: Iterator[pd.DataFrame]):
        held, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            some = [as_bytes(t) for t in batch["text"]]
            n += len(some)
            for a, b in _blocks(some):
                held += (counts(some[a:b]) > 0).sum(axis=0)
        at = np.flatnonzero(held)
        yield pd.DataFrame({"feature": np.append(at, FEATURES), "n": np.append(held[at], n)})

    sums = texts.select("text").mapInPandas(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES + 1, np.int64)
    out[sums["feature"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return int(out[FEATURES]), out[:FEATURES]


def fit(found: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> Model:
    """The model of labelled rows' counts, with the features' weights."""
    n = len(found)
    x = np.log1p(found.astype(np.float32)) * weight
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    # Leading singular vectors by repeated products with a thin random matrix.
    thin = np.random.Generator(np.random.PCG64(3)).standard_normal((x.shape[1], min(DIMENSIONS + 16, n))).astype(np.float32)
    for _ in range(4):
        thin = np.linalg.qr(x.T @ np.linalg.qr(x @ thin)[0])[0]
    _, _, right = np.linalg.svd(x @ thin, full_matrices=False)
    turn = (thin @ right[:DIMENSIONS].T).astype(np.float32)
    return Model(weight, turn, unit(x @ turn), labels)


def train(docs: DataFrame, labels: DataFrame, each_label: int = EACH_LABEL) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, quality (0, 1 or null)."""
    ready(docs.sparkSession)
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sizes = {r[0]: r[1] for r in join_small(texts.select("doc_id"), marked, "doc_id").groupBy("label").count().collect()}
    # A hash of id and text thins each label to about the wanted number, before texts meet their labels.
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_000))
    shares = {k: each_label / max(sizes.get(k, 1), 1) for k in (0, 1)}
    share = F.when(F.col("label") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0])) * 1_000_000
    near = texts.filter(place < max(shares.values()) * 1_000_000)
    sample = join_small(near, marked, "doc_id").filter(place < share).select("doc_id", "text", "label").dropDuplicates()

    def count(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            cells = []
            for a, b in _blocks(texts):
                for row in counts(texts[a:b]):
                    at = np.flatnonzero(row)
                    cells.append(pack(at.astype(np.uint16), row[at].astype(np.uint32)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "cell": cells})

    rows = sample.mapInPandas(count, kinds_of(sample, ["doc_id", "label"]) + ", cell binary").toPandas()
    rows = rows.sort_values(["doc_id", "label", "cell"]).reset_index(drop=True)
    if not len(rows):
        return Model(np.zeros(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    found = np.zeros((len(rows), FEATURES), np.float32)
    for i, cell in enumerate(rows["cell"]):
        at, times = unpack(cell, np.uint16, np.uint32)
        found[i, at] = times
    n, held = document_frequencies(texts)
    weight = (np.log((1 + n) / (1 + held)) + 1).astype(np.float32)
    return fit(found, rows["label"].to_numpy(np.int64), weight)


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
