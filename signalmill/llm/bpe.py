"""Byte-level BPE: texts to token ids and back, with the vocabulary of a public tokenizer file.

Each distinct piece of text (a word with the space before it, a number, a run of signs) is merged
on a segment tree over its adjacent pairs. A leaf holds rank and place of the pair that begins
there, so the root is the leftmost pair of the lowest rank; a merge changes three leaves and the
nodes above them, until no pair at the root can be merged. The trees of all new pieces of a batch
that have the same depth are kept as one numpy matrix and take each step together. Finished pieces
are remembered up to a fixed number; the vocabulary (a file of fixed size) goes with the function.

Defined cases: a null text is empty and has no ids; the special token's text becomes its id;
in decoding, null ids are empty and ids that the vocabulary doesn't have are skipped; bytes that
are no UTF-8 become U+FFFD; extra columns are kept, so a clash with an output name is the caller's
to settle by naming the outputs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

REMEMBERED = 600_000  # finished pieces that a worker keeps
CELLS = 1 << 21  # leaves of the trees that are merged together

# The split into pieces that byte-level BPE files of this kind are made for.
PIECES = (
    r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
ASCII_PIECES = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"  # the same for ASCII


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


@dataclass
class Vocabulary:
    byte_ids: np.ndarray  # id of each single byte
    pair_keys: np.ndarray  # sorted: left id * size + right id
    pair_ranks: np.ndarray
    merged: np.ndarray  # by rank: the id that a merge makes
    size: int
    id_bytes: list[bytes | None]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        ids = file["model"]["vocab"]
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*ids.values(), *special.values()]) + 1
        id_bytes: list[bytes | None] = [None] * size
        for token, i in ids.items():
            id_bytes[i] = bytes(value[c] for c in token)
        for token, i in special.items():
            id_bytes[i] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        return cls(
            np.array([ids[c] for c in letters], np.int32), keys[order], order.astype(np.int64),
            np.array([ids[a + b] for a, b in pairs], np.int32), size, id_bytes, special,
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges for a pair that isn't merged."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.merged))


def _merge_class(pieces: list[bytes], cap: int, v: Vocabulary) -> list[bytes]:
    """Ids (32-bit) of pieces of 2 to ``cap`` bytes; ``cap`` is a power of two."""
    n, none = len(pieces), len(v.merged) * cap
    length = np.array([len(p) for p in pieces])
    ids = np.zeros((n, cap + 1), np.int32)
    inside = np.arange(cap) < length[:, None]
    ids[:, :cap][inside] = v.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, cap + 2), (n, 1))  # the next symbol still there
    before = np.tile(np.arange(-1, cap), (n, 1))
    tree = np.full((n, 2 * cap), none, np.int64)
    pair = inside[:, 1:]
    ranks = np.full((n, cap - 1), len(v.merged), np.int64)
    ranks[pair] = v.ranks(ids[:, : cap - 1][pair], ids[:, 1:cap][pair])
    tree[:, cap : 2 * cap - 1] = np.minimum(ranks * cap + np.arange(cap - 1), none)
    level = cap // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2
    there = inside.copy()
    rows = np.flatnonzero(tree[:, 1] < none)
    while len(rows):
        root = tree[rows, 1]
        at, rank = root % cap, root // cap
        right = after[rows, at]
        behind = after[rows, right]
        ids[rows, at] = v.merged[rank]
        there[rows, right] = False
        after[rows, at] = behind
        last = behind >= length[rows]
        before[rows, np.where(last, cap, behind)] = at
        previous = before[rows, at]
        first = previous < 0
        here = v.ranks(ids[rows, at], ids[rows, np.where(last, cap, behind)]) * cap + at
        ahead = v.ranks(ids[rows, np.maximum(previous, 0)], ids[rows, at]) * cap + previous
        tree[rows, cap + right] = none
        tree[rows, cap + at] = np.where(last, none, np.minimum(here, none))
        some = np.flatnonzero(~first)
        tree[rows[some], cap + previous[some]] = np.minimum(ahead[some], none)
        for leaf, r in ((right, rows), (at, rows), (previous[some], rows[some])):
            node = (cap + leaf) // 2
            for _ in range(cap.bit_length() - 1):
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                node = node // 2
        rows = rows[tree[rows, 1] < none]
    flat, ends = ids[:, :cap][there].tobytes(), (4 * np.cumsum(there.sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def merge_pieces(pieces: list[bytes], v: Vocabulary) -> list[bytes]:
    """Ids (32-bit) of each piece of at least one byte."""
    out = [b""] * len(pieces)
    classes: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        if len(p) == 1:
            out[i] = v.byte_ids[p[0]].tobytes()
        else:
            classes.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
    for cap, members in classes.items():
        step = max(1, CELLS // cap)
        for a in range(0, len(members), step):
            part = members[a : a + step]
            for i, ids in zip(part, _merge_class([pieces[i] for i in part], cap, v)):
                out[i] = ids
    return out


class Encoder:
    """Encodes lists of texts and remembers pieces."""

    def __init__(self, v: Vocabulary):
        import regex

        self.v = v
        self.known: dict[str, bytes] = {}
        self.find_any = regex.compile(PIECES).findall
        self.find_ascii = re.compile(ASCII_PIECES, re.ASCII).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None

    def find(self, text: str) -> list[str]:
        return self.find_ascii(text) if text.isascii() else self.find_any(text)

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.find(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.find(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.find(text[at:])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.pieces(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        if new:
            ordinary = [p for p in new if p not in self.v.special]
            self.known.update(zip(ordinary, merge_pieces([p.encode("utf-8", "surrogatepass") for p in ordinary], self.v)))
            self.known.update({p: np.int32(i).tobytes() for p, i in self.v.special.items()})
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, s)), np.int32) for s in split]


def _add_column(df: DataFrame, name: str, kind, convert) -> DataFrame:
    """The frame and one more column, made batch by batch in Arrow."""
    fields = [f for f in df.schema.fields if f.name != name]
    kept = [f.name for f in fields]
    schema = StructType([*fields, StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = convert()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(k)) for k in kept]
            yield pa.RecordBatch.from_arrays([*columns, state(batch)], names=[*kept, name])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", output: str = "ids") -> DataFrame:
    """All columns and the token ids of ``text``, as the file's tokenizer gives them without added tokens."""
    v = Vocabulary.load(path)

    def convert():
        encoder = Encoder(v)

        def one(batch: pa.RecordBatch) -> pa.Array:
            ids = encoder.encode(batch.column(batch.schema.get_field_index(text)).to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return one

    return _add_column(df, output, ArrayType(IntegerType()), convert)


def decode_ids(ids: list[int | None] | None, id_bytes: list[bytes | None]) -> str:
    known = (id_bytes[i] for i in ids or [] if i is not None and 0 <= i < len(id_bytes))
    return b"".join(b for b in known if b is not None).decode("utf-8", "replace")


def decode(df: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns and the text that ``ids`` stand for."""
    id_bytes = Vocabulary.load(path).id_bytes
    size = len(id_bytes)
    table = pa.array([b or b"" for b in id_bytes], pa.large_binary())

    def convert():
        def one(batch: pa.RecordBatch) -> pa.Array:
            column = batch.column(batch.schema.get_field_index(ids))
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False) if not flat.null_count else None
            if values is None or (len(values) and not 0 <= values.min() <= values.max() < size):
                return pa.array([decode_ids(x, id_bytes) for x in column.to_pylist()], pa.string())
            taken = table.take(flat)  # all ids' bytes in a row; a text is where its first id begins to where its last ends
            token_at = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
            text_at = token_at[np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())))]
            joined = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(text_at.tobytes()), taken.buffers()[2]])
            try:
                return joined.cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:  # cut characters
                return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())

        return one

    return _add_column(df, output, StringType(), convert)
