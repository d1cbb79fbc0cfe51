"""SpotSigs fingerprints: chains of content words after common words.

Wherever a common word (an antecedent) stands, the next CHAIN words that are not common make a
signature with it; boilerplate has few such spots, prose has many. A text's fingerprint is the set
of its signatures, and two texts are as like as the Jaccard coefficient of their sets. Sets whose
lengths are too far apart for a wanted likeness can't reach it, so comparing stops before their
elements are looked at, and ``length_part`` deals sets to parts of neighbouring lengths in which
alone a like one can be.

Words are runs of letters, A-Z lower-cased. Defined cases: a null text is empty and has the empty
fingerprint; a text without any whole chain has one signature, that of all its bytes, so equal texts
always have equal fingerprints and different ones rarely do; two empty sets are alike (1), an empty
and another are not (0). Rows are ordered by doc_id, a null one first, equal ones by text; extra
columns stay unread.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from .packed import buckets, ready
from .words import as_bytes, chunks, mix, word_codes

CHAIN = 3

# Antecedents, common words of four languages.
ANTECEDENTS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with",
    "de": "auf das dem den der die ein eine es für im in ist mit nicht sich und von zu",
    "fr": "à au dans de des du en est et il la le les ne par pas pour que qui sur un une",
    "es": "al con de del el en es la las los no para por que se su un una y",
}

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COMMON = np.unique(word_codes([w.encode() for words in ANTECEDENTS.values() for w in words.split()])[0])
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def signatures(texts: list[bytes], chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted 32-bit signatures of each text."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts, 1 << 20):
        part = texts[a:b]
        codes, at = word_codes([t.translate(_LETTERS) for t in part])
        owner = np.repeat(np.arange(len(part)), np.diff(at))
        place = np.minimum(np.searchsorted(_COMMON, codes), len(_COMMON) - 1)
        common = _COMMON[place] == codes
        content = np.flatnonzero(~common)
        spot = np.flatnonzero(common)
        first = np.searchsorted(content, spot)  # the first content word behind each spot
        whole = first + chain <= len(content)
        spot, first = spot[whole], first[whole]
        inside = owner[content[first + chain - 1]] == owner[spot] if len(spot) else np.zeros(0, bool)
        spot, first = spot[inside], first[inside]
        value = codes[spot] * _SALTS[0]
        for k in range(chain):
            value += codes[content[first + k]] * _SALTS[(k + 1) % len(_SALTS)]
        value = (mix(value) >> np.uint64(32)).astype(np.int64)
        keys = np.unique(owner[spot] << 32 | value)
        ends = np.searchsorted(keys >> 32, np.arange(len(part)), side="right")
        values = (keys & 0xFFFFFFFF).astype(np.uint32)
        for i, (s, e) in enumerate(zip([0, *ends], ends)):
            if e > s:
                out.append(values[s:e])
            elif part[i]:
                out.append(np.frombuffer(hashlib.sha256(part[i]).digest()[:4], np.uint32))
            else:
                out.append(np.zeros(0, np.uint32))
    return out


def fingerprint(signs: np.ndarray) -> str:
    return base64.b64encode(signs.astype("<u4").tobytes()).decode()


def read_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def length_part(length: int, least: float) -> int:
    """The part of a set length; sets at least ``least`` alike are in the same part or in neighbouring ones."""
    return math.floor(math.log(max(length, 1)) / -math.log(least))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 as soon as it can't be ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < least * large:
        return 0.0
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    found = shared / (small + large - shared)
    return found if found >= least else 0.0


def edited(text: str, following: str) -> str:
    """The text, with its last quarter replaced by as much of the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of doc_id and sorted; behind each range stands the first row of the next (of the last: of the first).

    Only ids decide on ranges, so the texts are shuffled once. Columns: foreign (0, 1), target, doc_id, known, text.
    """
    spark = docs.sparkSession
    lowest = -(2**63)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    parts = buckets(spark, 1)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("cuts")).first()[0] or []
    cuts = np.unique(np.array(found, np.int64))

    def ranges(ids: pd.Series) -> np.ndarray:
        return np.searchsorted(cuts, ids.to_numpy(np.int64), side="right")

    range_of = F.pandas_udf(lambda ids: pd.Series(ranges(ids)), LongType())
    heads = sorted(tuple(r) for r in rows.groupBy(range_of("doc_id")).agg(F.min("doc_id")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    def targets(ids: pd.Series) -> pd.Series:
        return pd.Series([[r, before[i]] if i in before else [r] for r, i in zip(ranges(ids).tolist(), ids.tolist())])

    dealt = rows.select(F.posexplode(F.pandas_udf(targets, ArrayType(LongType()))("doc_id")).alias("foreign", "target"), "*")
    return dealt.repartition(parts, "target").sortWithinPartitions("target", "foreign", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and likenesses to the edited and to the next text.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    ready(docs.sparkSession)

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        """Rows with the row that follows each; the last one only follows."""
        texts, target, own = batch["text"].tolist(), batch["target"].to_numpy(), (batch["foreign"] == 0).to_numpy()
        at = [i for i in range(len(texts) - 1) if own[i] and target[i] == target[i + 1]]
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        signs = signatures([as_bytes(t) for t in texts])
        new = signatures([as_bytes(t) for t in changed])
        return pd.DataFrame(
            {
                "doc_id": batch["doc_id"].where(batch["known"], None).astype("object").iloc[at].astype("Int64"),
                "n_chars": [len(texts[i]) for i in at],
                "edited_sha256": [hashlib.sha256(as_bytes(t)).hexdigest() for t in changed],
                "fingerprint": [fingerprint(signs[i]) for i in at],
                "edited_fingerprint": [fingerprint(x) for x in new],
                "near_edited": np.array([likeness(signs[i], x) for i, x in zip(at, new)], np.float64),
                "near_next": np.array([likeness(signs[i], signs[i + 1]) for i in at], np.float64),
            }
        )

    def run(batches: Iterator[pd.DataFrame]):
        held: pd.DataFrame | None = None
        for batch in batches:
            # The next row of a batch's last one stands in the batch after it.
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            held = batch.iloc[-1:]
            yield compare(batch)

    kind = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return _in_order(docs).mapInPandas(run, kind)
