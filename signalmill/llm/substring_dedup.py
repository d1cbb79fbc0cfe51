"""Repeated passages: every run of ``n`` words that a document with a smaller id holds too.

Suffixes of the corpus, cut at ``n`` words, are split by variable-length prefixes into groups that
fit one task, and each group builds its part of the suffix tree: its suffixes in order, whose
internal nodes at depth ``n`` are the runs of equal ones. A node with leaves in several documents
is a repeat; neighbouring nodes along a document join to the maximal repeats that are removed.

Three things keep this small at scale:

* Only suffixes that can repeat are grouped. Each window of ``n`` words has an anchor, the least
  code of the sequences of ``ANCHOR`` words in it; equal windows have equal anchors. Anchors (about
  a fifth of the positions) are counted first, and windows whose anchor is in one document only
  are done with.
* A prefix is as long as its words are common: it ends with its second word that is not common,
  so a group holds few suffixes however often "of the" is written. The common words are those with
  a share of ``COMMON`` or more of all words, 1 / COMMON at most.
* Copies met in one task are settled there. Of equal windows a task sends the one with the least
  id, so a passage that a third of all documents share weighs one record a task.

Windows are told apart by a 64-bit code beside the bits of their group. Defined cases: a null or
empty text has no words; a null doc_id neither removes nor loses words; repeated rows (equal
doc_id) do not count as another document, whatever their texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .packed import buckets, by_bucket, pack, ready, run_starts, stored, unpack_all
from .words import as_bytes, chunks, mix, sequence_codes, word_codes

ANCHOR = 5
COMMON = 1e-4
RARE_WORDS = 2

_HITS = "doc_id bigint, tkey int, cell binary"


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    have, out = 1, a
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def _windows(texts: list[bytes], n: int, anchor: int):
    """Word codes, each window's text (-1: it crosses texts), its place in the text, and its anchor."""
    codes, at = word_codes(texts)
    count = len(codes) - n + 1
    if count <= 0:
        return codes, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    anchors = _least(sequence_codes(codes, anchor, 1), n - anchor + 1)
    window_owner = np.where(owner[:count] == owner[n - 1 :], owner[:count], -1)
    return codes, window_owner, np.arange(count) - at[owner[:count]], anchors


def _common_words(docs: DataFrame, share: float) -> np.ndarray:
    """Codes of the words with this share of all words, sorted. Words rarer than that in a chunk don't count for it."""

    def count(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            for a, b in chunks(texts):
                codes, _ = word_codes(texts[a:b])
                if len(codes):
                    word, times = np.unique(codes, return_counts=True)
                    keep = times >= max(2, len(codes) * share / 2)
                    yield pd.DataFrame(
                        {
                            "word": np.append(word[keep].view(np.int64), 0),
                            "times": np.append(times[keep], 0),
                            "total": np.append(np.zeros(keep.sum(), np.int64), len(codes)),
                        }
                    )

    counted = docs.select("text").mapInPandas(count, "word bigint, times bigint, total bigint")
    counted = stored(counted.groupBy("word").agg(F.sum("times").alias("times"), F.sum("total").alias("total")), "common-words")
    whole = counted.agg(F.sum("total")).first()[0] or 0
    found = counted.filter(F.col("times") >= F.lit(max(1.0, whole * share)))
    return np.sort(found.toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def _groups(codes: np.ndarray, places: np.ndarray, common: np.ndarray, n: int) -> np.ndarray:
    """The code of the prefix that each window's group is named by."""
    rare = np.ones(len(codes), np.int64)
    if len(common):
        rare[np.isin(codes, common)] = 0
    out = np.zeros(len(places), np.uint64)
    met = np.zeros(len(places), np.int64)
    open_ = np.ones(len(places), bool)
    salt = np.uint64(0x9E3779B97F4A7C15)
    for i in range(n):
        out[open_] = (out[open_] ^ codes[places[open_] + i]) * salt
        met[open_] += rare[places[open_] + i]
        open_ &= met < RARE_WORDS
        if not open_.any():
            break
    return mix(out)


def _settle(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and id; for each record in that order: the key's first record, and whether other ids hold the key."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    starts = run_starts(k)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(k))))
    last = np.append(starts[1:], len(k)) - 1
    return order, starts[run], (d[starts] != d[last])[run] if len(k) else np.zeros(0, bool)


def _homes(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, a part of the text's hash that tells repeated ids apart, and the bucket the row is at home in."""
    tkey = F.xxhash64("text").bitwiseAND(F.lit(0xFFFF)).cast("int")
    home = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))
    # Ids stay whole numbers on their way through pandas: a null one is 0 and not known.
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))
    return docs.select(
        doc.alias("doc_id"), F.col("text").cast("string").alias("text"), tkey.alias("tkey"), home.alias("home"),
        F.col("doc_id").isNotNull().alias("known"),
    )


_DEALT = "bucket bigint, cell binary"
_HITS = "home bigint, cell binary"


def _anchors(named: DataFrame, n: int, anchor: int, parts: int) -> DataFrame:
    """For each home, the anchors of its documents that stand in another document too: home, packed codes."""

    def find(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            batch = batch[batch["known"]]
            texts = [as_bytes(t) for t in batch["text"]]
            ids, home = batch["doc_id"].to_numpy(np.int64), batch["home"].to_numpy(np.uint32)
            for a, b in chunks(texts):
                _, owner, _, least = _windows(texts[a:b], n, anchor)
                first = run_starts(owner, least)
                first = first[owner[first] >= 0]
                row, value = owner[first] + a, least[first]
                order, head, several = _settle(value, ids[row])
                sent = np.sort(order[head == np.arange(len(head))])
                yield by_bucket((value[sent] % np.uint64(parts)).astype(np.int64), value[sent], ids[row[sent]], home[row[sent]])
                if several.any():
                    known = order[several]
                    yield by_bucket(-1 - home[row[known]].astype(np.int64), value[known])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        if bucket < 0:
            value = np.unique(unpack_all(group["cell"], np.uint64)[0])
            return pd.DataFrame({"home": [-1 - bucket], "cell": [pack(value)]})
        value, doc, home = unpack_all(group["cell"], np.uint64, np.int64, np.uint32)
        order, _, several = _settle(value, doc)
        chosen = order[several]
        return by_bucket(home[chosen].astype(np.int64), value[chosen]).rename(columns={"bucket": "home"})

    return named.select("doc_id", "text", "home", "known").mapInPandas(find, _DEALT).groupBy("bucket").applyInPandas(shared, _HITS)


def _repeats(named: DataFrame, hits: DataFrame, n: int, anchor: int, parts: int, common: np.ndarray) -> DataFrame:
    """For each home, the windows that also start in a document with a smaller id: home, packed (doc_id, tkey, start)."""

    def suffixes(key, batch: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        home, out = int(key[0]), []
        wanted = np.unique(unpack_all(found["cell"], np.uint64)[0])
        batch = batch[batch["known"]].sort_values(["doc_id", "tkey"])
        texts = [as_bytes(t) for t in batch["text"]]
        ids, keys = batch["doc_id"].to_numpy(np.int64), batch["tkey"].to_numpy(np.uint16)
        for a, b in chunks(texts) if len(wanted) else ():
            codes, owner, place, least = _windows(texts[a:b], n, anchor)
            first = run_starts(least)
            held = np.repeat(np.isin(least[first], wanted), np.diff(np.append(first, len(least))))
            at = np.flatnonzero(held & (owner >= 0))
            row, value, start = owner[at] + a, sequence_codes(codes, n, 2)[at], place[at].astype(np.uint32)
            bucket = (_groups(codes, at, common, n) % np.uint64(parts)).astype(np.int64)
            doc, tkey = ids[row], keys[row]
            order, head, _ = _settle(value, doc)
            late = np.zeros(len(at), bool)
            late[order] = doc[order] != doc[order][head]
            # What comes after the first document here is settled; that one's windows wait for the other tasks.
            sent = ~late
            out.append(by_bucket(bucket[sent], value[sent], doc[sent], tkey[sent], start[sent], np.full(sent.sum(), home, np.uint32)))
            if late.any():
                out.append(pd.DataFrame({"bucket": [-1 - home], "cell": [pack(doc[late], tkey[late], start[late])]}))
        return pd.concat(out) if out else pd.DataFrame({"bucket": [], "cell": []})

    def subtree(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        if bucket < 0:
            return pd.DataFrame({"home": -1 - bucket, "cell": group["cell"]})
        value, doc, tkey, start, home = unpack_all(group["cell"], np.uint64, np.int64, np.uint16, np.uint32, np.uint32)
        order, head, _ = _settle(value, doc)
        chosen = np.sort(order[doc[order] != doc[order][head]])
        return by_bucket(home[chosen].astype(np.int64), doc[chosen], tkey[chosen], start[chosen]).rename(columns={"bucket": "home"})

    return (
        named.groupBy("home")
        .cogroup(hits.groupBy("home"))
        .applyInPandas(suffixes, _DEALT)
        .groupBy("bucket")
        .applyInPandas(subtree, _HITS)
    )


def remove_repeats(docs: DataFrame, n: int = 13, keep_text: bool = True) -> DataFrame:
    """Documents without the words of repeated passages.

    Returns doc_id, n_words, n_removed, kept_sha256, removed (maximal repeats as pairs of first
    word and length) and, with ``keep_text``, the kept words joined by one space.
    """
    spark = ready(docs.sparkSession)
    parts, anchor = buckets(spark, 1), min(ANCHOR, n)
    named = _homes(docs, parts)
    hits = _anchors(named, n, anchor, parts)
    starts = _repeats(named, hits, n, anchor, parts, _common_words(docs, COMMON))
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"] + ["text"] * keep_text

    def cut(batch: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        doc, tkey, start = unpack_all(found["cell"], np.int64, np.uint16, np.uint32)
        order = np.lexsort((tkey, doc))
        doc, tkey, start = doc[order], tkey[order], start[order]
        begin = run_starts(doc, tkey)
        spot = {(int(doc[s]), int(tkey[s])): start[s:e] for s, e in zip(begin, np.append(begin[1:], len(doc)))}
        rows = []
        for doc_id, known, key, text in zip(batch["doc_id"], batch["known"], batch["tkey"], batch["text"]):
            words = as_bytes(text).split()
            total, spans = len(words), []
            at = spot.get((int(doc_id), int(key))) if known else None
            if at is not None:
                steps = np.bincount(at, minlength=total + 1) - np.bincount(at.astype(np.int64) + n, minlength=total + 1)
                gone = np.cumsum(steps)[:total] > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                spans = [(int(s), int(e - s)) for s, e in zip(edge[::2], edge[1::2])]
                words = list(compress(words, ~gone))
            kept = b" ".join(words)
            row = (int(doc_id) if known else None, total, total - len(words), hashlib.sha256(kept).hexdigest(), spans)
            rows.append(row + (kept.decode("utf-8", "replace"),) if keep_text else row)
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    kind = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<first: int, words: int>>"
    return named.groupBy("home").cogroup(starts.groupBy("home")).applyInPandas(cut, kind + ", text string" * keep_text)
