"""Fill-in-the-middle examples: prefix, middle and suffix of texts, cut at code points.

Cuts are numbers of code points, texts are UTF-8 bytes. ``CutIndex`` turns one into the other for all
texts of a batch at once: it records only the multibyte characters, each one's place and the bytes it has
beyond one; ``searchsorted`` among them gives what has to be added to a cut, and text without such
characters costs nothing but arithmetic. No text is decoded.

The draws of a document are the first four 8-digit groups of the sha256 of ``seed:id``, so reruns agree and
a row's example doesn't depend on other rows. The cuts are the first two draws, modulo one more than the
number of code points; the third decides whether the text stays plain, the fourth between the two orders:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

Texts that are empty or hold a marker stay plain, so ``restore`` finds each marker where it was put.

Defined cases: a null text is an empty one; a null id is drawn as an empty one; repeated rows give repeated
examples; a kept column named like one of the results is replaced by it; no rows give no rows. A batch holds
its texts, their examples and 16 bytes for each multibyte character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .packed import ready

# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


class CutIndex:
    """Code points against bytes of UTF-8 data, by its multibyte characters alone."""

    def __init__(self, data: np.ndarray):
        self.places = np.flatnonzero(data >= 0xC0)  # the first byte of each
        first = data[self.places]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess)))  # of all characters before each
        self.points = self.places - self.excess[:-1]  # the number of each among all code points

    def points_at(self, places: np.ndarray) -> np.ndarray:
        """Code points before places in bytes, which lie between characters."""
        return places - self.excess[np.searchsorted(self.places, places)]

    def places_at(self, points: np.ndarray) -> np.ndarray:
        """Bytes before code points."""
        return points + self.excess[np.searchsorted(self.points, points)]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more at the end); nulls are empty."""
    texts = column.fill_null("").cast(pa.large_string())
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def _examples(column: pa.Array, draws: list[np.ndarray], plain_percent: int, spm_percent: int) -> list[pa.Array]:
    data, at = flat(column)
    index = CutIndex(data)
    first = index.points_at(at)
    n = np.diff(first)
    cuts = [d % (n + 1) for d in draws[:2]]
    low, high = np.minimum(*cuts), np.maximum(*cuts)
    low_at, high_at = index.places_at(first[:-1] + low), index.places_at(first[:-1] + high)
    plain = (n == 0) | (draws[2] % 100 >= 100 - plain_percent)
    spm = draws[3] % 100 < spm_percent
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out, whole = [], data.tobytes()
    for i, (a, b, c, d) in enumerate(zip(at[:-1].tolist(), low_at.tolist(), high_at.tolist(), at[1:].tolist())):
        text = whole[a:d]
        if not plain[i] and (p in text or s in text or m in text):
            plain[i] = True
        if plain[i]:
            out.append(text)
        elif spm[i]:
            out.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
        else:
            out.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
    return [
        pa.array(n),
        pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string()),
        pa.array(low, mask=plain),
        pa.array(high - low, mask=plain),
        pa.array(out, pa.binary()).cast(pa.string()),
    ]


def fill_in_middle(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    key: str = "doc_id",
    text: str = "text",
    seed: str = "1",
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """The kept columns with n (code points), form, prefix_chars, middle_chars (null if plain) and output."""
    ready(docs.sparkSession)
    kept = [k for k in keep if k not in RESULTS]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"_{i}") for i in range(4)]
    source = docs.select(F.struct(*(F.col(f"`{k}`") for k in kept)).alias("row"), F.col(f"`{text}`").alias("text"), *draws)
    schema = StructType(
        [source.schema["row"], StructField("n", LongType()), StructField("form", StringType())]
        + [StructField(c, LongType()) for c in RESULTS[2:4]]
        + [StructField("output", StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [batch.column(f"_{i}").to_numpy() for i in range(4)]
            found = _examples(batch.column("text"), drawn, plain_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *found], names=schema.names)

    made = source.mapInArrow(run, schema)
    return made.select(*(F.col("row")[k].alias(k) for k in kept), *RESULTS)


def restore(examples: DataFrame, output: str = "output", form: str = "form", restored: str = "restored") -> DataFrame:
    """All columns and the text that the example was made of, from its output and form alone."""
    made, kind = F.col(f"`{output}`"), F.col(f"`{form}`")

    def parts(second: str) -> tuple[Column, Column, Column]:
        """What stands after the first marker, after ``second`` and after the middle's marker."""
        b = F.instr(made, F.lit(second))
        c = F.position(F.lit(MIDDLE), made, b)
        one, two = F.substring(made, F.lit(4), b - 4), F.substring(made, b + 3, c - b - 3)
        return one, two, F.substring(made, c + 3, F.length(made))

    prefix, suffix, middle = parts(SUFFIX)
    suffix_first, prefix_second, middle_last = parts(PREFIX)
    text = (
        F.when(kind == "psm", F.concat(prefix, middle, suffix))
        .when(kind == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(made)
    )
    return examples.withColumn(restored, text)
