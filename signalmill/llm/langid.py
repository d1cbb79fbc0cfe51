"""Language of each text: multinomial naive Bayes over hashed character n-grams.

A text becomes its lower-cased letters with one space for whatever stands between them, and its
features are the hashed n-grams of ORDERS characters. Counting adds up, for each language, the
hashes of all learning texts: each task sums its own rows first, so a language that holds most rows
costs no more than another. The model is a matrix of log probabilities, languages by 2 ** BITS
hashes, and goes to all tasks; LANGUAGES bounds its rows (a table with more languages is refused,
none is dropped). A batch is scored as sparse rows: distinct hashes of each text and their counts.

The score is the posterior of the best language with the evidence of at most EVIDENCE n-grams,
since neighbouring n-grams are not independent; it doesn't change which language is best.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; learning skips null
texts and null languages; equal posteriors go to the language first by name; without any learning
text all are ``und``; repeated rows count as often as they stand there; extra columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .packed import kinds_of, ready

ORDERS = (1, 2, 3)
BITS = 15
LANGUAGES = 512
EVIDENCE = 60.0
UNKNOWN = "und"
_PIECE = 1 << 19  # characters worked on at a time


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: the lower-case letter it counts as, or a space."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with single spaces between words, and the text of each."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = _letters()[raw]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    space = points == 32
    keep = ~space
    keep[:-1] |= space[:-1] & (~space[1:] | (owner[1:] != owner[:-1]))
    if len(keep):
        keep[-1] = True
    return points[keep], owner[keep]


def hashed_ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: text (ascending) and hash of every n-gram that holds a letter."""
    points, owner = _points(texts)
    code = np.zeros(len(points), np.uint64)
    lettered = np.zeros(len(points), bool)
    for n in range(1, max(ORDERS) + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(0x100000001B3) + points[n - 1 :]
        lettered = lettered[:m] | (points[n - 1 :] != 32)
        if n in ORDERS:
            whole = lettered & (owner[:m] == owner[n - 1 :])
            h = (code[whole] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            yield owner[:m][whole], (h >> np.uint64(64 - BITS)).astype(np.int64)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in pieces of bounded size, with their row numbers; a long text has several pieces."""
    rows, held, size = [], [], 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        for a in range(0, len(t), _PIECE):
            # n-grams that cross the cut belong to the earlier piece
            part = t[a : a + _PIECE + (max(ORDERS) - 1 if a + _PIECE < len(t) else 0)]
            if size and size + len(part) > _PIECE:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(i)
            held.append(part)
            size += len(part)
    if rows:
        yield rows, held


def count(docs: DataFrame) -> DataFrame:
    """lang, hash, times: n-gram counts of the texts of each language, summed by task before the shuffle."""

    def sums(batches: Iterator[pd.DataFrame]):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].tolist()
            for rows, held in _pieces(batch["text"].tolist()):
                names = [langs[r] for r in rows]
                kinds = sorted(set(names))
                number = np.array([kinds.index(n) for n in names])
                found = np.zeros((len(kinds), 1 << BITS), np.int64)
                for row, h in hashed_ngrams(held):
                    found += np.bincount((number[row] << BITS) + h, minlength=found.size).reshape(found.shape)
                for k, kind in enumerate(kinds):
                    total[kind] = total.get(kind, 0) + found[k]
        for kind, counts in total.items():
            at = np.flatnonzero(counts)
            if not len(at):
                at = np.zeros(1, np.int64)
            yield pd.DataFrame({"lang": kind, "hash": at.astype(np.int32), "times": counts[at]})

    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter("text IS NOT NULL AND lang IS NOT NULL")
    return known.mapInPandas(sums, "lang string, hash int, times bigint").groupBy("lang", "hash").agg(F.sum("times").alias("times"))


def train(docs: DataFrame, most: int = LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log probabilities with their priors left out (all languages alike)."""
    spark = ready(docs.sparkSession)
    names = [r[0] for r in docs.select(F.col("lang").cast("string")).filter("lang IS NOT NULL").distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} languages: the model would not be small enough to send to all tasks")
    rows = count(docs).toPandas()
    languages = sorted(set(rows["lang"]))
    counts = np.zeros((len(languages), 1 << BITS))
    counts[rows["lang"].map({n: i for i, n in enumerate(languages)}).to_numpy(np.int64), rows["hash"].to_numpy()] = rows["times"].to_numpy()
    shared = counts.sum(axis=0, keepdims=True) + 0.5
    # A hash that a language lacks gets a share of what all languages have of it.
    smooth = counts + 50.0 * shared / shared.sum() if len(languages) else counts
    return languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)) if len(languages) else smooth


def score_texts(texts: list[str | None], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods of each text for each language, and the number of its n-grams."""
    out, grams = np.zeros((len(texts), len(model))), np.zeros(len(texts), np.int64)
    for rows, held in _pieces(texts):
        rows = np.asarray(rows)
        for row, h in hashed_ngrams(held):
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            if not len(starts):
                continue
            at = rows[row[starts]]
            for k in range(len(model)):
                np.add.at(out[:, k], at, np.add.reduceat(model[k][h], starts))
            np.add.at(grams, at, np.diff(np.append(starts, len(row))))
    return out, grams


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, lang_pred and score of every row."""
    languages, table = model
    names = np.array([*languages, UNKNOWN], object)
    sent = docs.sparkSession.sparkContext.broadcast(table)
    kept = [f"_{i}" for i in range(len(keep))]  # the mapped frame can't have names with dots

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            out = batch[kept].copy()
            if not languages:
                out["lang_pred"], out["score"] = UNKNOWN, 0.0
                yield out
                continue
            logs, grams = score_texts(batch["text"].tolist(), sent.value)
            best = np.where(grams > 0, logs.argmax(axis=1), len(languages))
            scaled = logs * (np.minimum(grams, EVIDENCE) / np.maximum(grams, 1))[:, None]
            posterior = 1 / np.exp(scaled - scaled.max(axis=1, keepdims=True)).sum(axis=1)
            out["lang_pred"] = names[best]
            out["score"] = np.where(grams > 0, posterior, 0.0)
            yield out

    chosen = docs.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keep, kept)), F.col("text").cast("string").alias("text"))
    found = chosen.mapInPandas(run, ", ".join(x for x in (kinds_of(chosen, kept), "lang_pred string, score double") if x))
    return found.toDF(*keep, "lang_pred", "score")


def identify(docs: DataFrame, learn_from: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Languages of ``docs`` by a model of ``learn_from``."""
    return predict(docs, train(learn_from), keep)
