"""Periodic runs of words: stretches that repeat a passage of q words over and over.

A run is a stretch with smallest period q (words q apart are the same) of at least LENGTH words and REPEATS
periods that no neighbouring word extends. In such a run every word occurs REPEATS times or more, so:

1. ``frequent_segments`` splits the words wherever one occurs less often than that in its segment, counts
   again in what is left and so on until every word of a segment is frequent in it. Most texts end here.
2. ``lag_scan`` compares the words of a segment with those q later. For each lag only one block of words
   a stretch of the least length apart is compared, as every run holds a whole one; all lags of a power
   of two are compared at once, about n / 2 blocks. A block that agrees is extended to its whole run, one
   inside a run of a divisor of q is that run again and left out.

So a text of n words takes about n log n steps, also where one word fills it or segments are very long.
Words are compared as numbers that a text's own dictionary gives them: nothing is taken for equal by a hash.

Defined cases: a null or empty text has no words and no runs; ties keep all runs; rows are handled alone, so
repeated rows and null ids give what each gives; a kept column named like one of the results is replaced by
it; no rows give no rows. A task holds a batch of texts and one text's words: about 60 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .packed import kinds_of, ready
from .words import as_bytes

LENGTH = 6
REPEATS = 4
BLOCK = 32  # words compared before a block is extended
ROUNDS = 64  # of splitting; the scan is exact whatever is left

RESULTS = ("n_words", "runs", "collapsed")
Run = tuple[int, int, int]  # start, length, period


def frequent_segments(words: np.ndarray, length: int = LENGTH, repeats: int = REPEATS) -> list[tuple[int, int]]:
    """Segments (start, end) outside which no run lies; ``words`` are numbers from 0."""
    if len(words) < length:
        return []
    kinds = int(words.max()) + 1
    place, part = np.arange(len(words)), np.zeros(len(words), np.int64)
    out: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        if not len(part) or part[-1] == 0:
            often = np.bincount(words[place], minlength=kinds)[words[place]] >= repeats
        else:
            _, which, counts = np.unique(part * kinds + words[place], return_inverse=True, return_counts=True)
            often = counts[which] >= repeats
        split = np.zeros(int(part[-1]) + 1 if len(part) else 0, bool)
        split[part[~often]] = True
        settled = ~split[part]
        out += _stretches(place[settled], length)[1]
        place = place[often & ~settled]
        part, _ = _stretches(place, length)
        place, part = place[part >= 0], part[part >= 0]
        if not len(place):
            return out
    return out + _stretches(place, length)[1]


def _stretches(place: np.ndarray, length: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For each place the number of its stretch of neighbours, -1 in short ones; and the stretches."""
    if not len(place):
        return np.zeros(0, np.int64), []
    starts = np.flatnonzero(np.concatenate(([True], np.diff(place) != 1)))
    sizes = np.diff(np.append(starts, len(place)))
    long = sizes >= length
    number = np.where(long, np.cumsum(long) - 1, -1)
    return np.repeat(number, sizes), [(int(place[s]), int(place[s]) + int(k)) for s, k in zip(starts[long], sizes[long])]


def _matches(words: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal those ``lag`` later."""
    limit, begin, size = len(words) - lag, at, 64
    while at < limit:
        end = min(at + size, limit)
        same = words[at:end] == words[at + lag : end + lag]
        if not same.all():
            return at + int(same.argmin()) - begin
        at, size = end, 2 * size
    return limit - begin


def _known(starts: np.ndarray, ends: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which stretches lie in one of the runs of a period: those overlap by less than it, so the last that begins before counts."""
    i = np.searchsorted(starts, at, "right") - 1
    return (i >= 0) & (end <= ends[i])


def lag_scan(words: np.ndarray, length: int = LENGTH, repeats: int = REPEATS) -> list[Run]:
    """All runs of a segment, by comparing it with itself at each lag."""
    n, low = len(words), 1
    backward = words[::-1]
    by_period: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out: list[Run] = []
    while low * repeats <= n:
        lags = np.arange(low, min(2 * low, n // repeats + 1))
        block = min(low, BLOCK)
        # A run of lag q holds this many words that equal those q later, so a whole block of every ``step`` places.
        step = np.maximum(length, repeats * lags) - lags - block + 1
        blocks = (n - lags - block) // step + 1
        blocks[n < np.maximum(length, repeats * lags)] = 0
        lag = np.repeat(lags, blocks)
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * np.repeat(step, blocks)
        for j in range(block):
            same = words[at + j] == words[at + j + lag]
            at, lag = at[same], lag[same]
        for period, (starts, ends) in by_period.items():
            if not len(at):
                break
            inside = (lag % period == 0) & _known(starts, ends, at, at + lag + block)
            at, lag = at[~inside], lag[~inside]
        found: dict[int, list[tuple[int, int]]] = {}
        last, until = 0, 0
        for a, q in zip(at.tolist(), lag.tolist()):
            if q == last and a < until:
                continue
            until = a + _matches(words, a, q)
            # Backwards, the words before a + q equal those q later in the reversed text.
            start = a - _matches(backward, n - a - q, q)
            last = q
            if until + q - start >= max(length, repeats * q):
                found.setdefault(q, []).append((start, until + q))
        for q, runs in found.items():
            by_period[q] = tuple(np.array(x) for x in zip(*runs))
            out += [(s, e - s, q) for s, e in runs]
        low *= 2
    return out


def periodic_runs(words: np.ndarray, length: int = LENGTH, repeats: int = REPEATS) -> list[Run]:
    """All runs of words (numbers from 0) by start, then period."""
    out = []
    for start, end in frequent_segments(words, length, repeats):
        out += [(start + s, n, q) for s, n, q in lag_scan(words[start:end], length, repeats)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def repeated(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    turn = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        turn[start + period] += 1
        turn[start + length] -= 1
    return np.cumsum(turn)[:n] > 0


def collapse_runs(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", length: int = LENGTH, repeats: int = REPEATS
) -> DataFrame:
    """The kept columns with n_words, runs (start, length, period: by start, then period) and collapsed.

    Collapsed is the text without the words that any run holds after its first period, joined by one space.
    """
    if repeats < 2:
        raise ValueError("a run has two periods at least")
    ready(docs.sparkSession)
    keep = [k for k in keep if k not in RESULTS]
    kept = [f"_{i}" for i in range(len(keep))]  # the mapped frame can't have names with dots
    source = docs.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keep, kept)), F.col(f"`{text}`").alias("_run_text"))
    made = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    kinds = ", ".join(x for x in (kinds_of(source, kept), made) if x)

    def one(value) -> tuple[int, list[dict], str]:
        words = as_bytes(value).split()
        runs = periodic_runs(numbered(words), length, repeats)
        if runs:
            gone = repeated(len(words), runs)
            left = [w for w, g in zip(words, gone.tolist()) if not g]
        else:
            left = words
        listed = [{"start": s, "length": n, "period": q} for s, n, q in runs]
        return len(words), listed, b" ".join(left).decode("utf-8", "surrogatepass")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [one(t) for t in frame.pop("_run_text")]
            for i, name in enumerate(RESULTS):
                frame[name] = pd.Series([f[i] for f in found], index=frame.index, dtype="int64" if i == 0 else object)
            yield frame

    return source.mapInPandas(run, kinds).toDF(*keep, *RESULTS)


def longest(runs: Column) -> Column:
    """The run of greatest length; ties: smallest start, then period. Null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    return F.array_max(ranked)["run"]


def listed(runs: Column) -> Column:
    """Each run's ``start,length,period`` on a line of its own."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))))
