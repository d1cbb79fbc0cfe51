"""Words as 64-bit codes, many texts at a time.

Words are runs of anything but space and \\x09-\\x0D, which is what ``bytes.split()`` takes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SEGMENT = 1 << 20  # bytes hashed at a time; the working arrays take about 40 bytes for each

_random = np.random.Generator(np.random.PCG64(20240131))
_BYTE_CODES = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C13  # 3 modulo 4, so that neighbouring powers differ by twice an odd number
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit codes that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _size_class(n: int) -> int:
    return max(SEGMENT, 1 << (n - 1).bit_length()) + 1


def _hash_segment(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    size = _size_class(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _powers(size, _BASE)[: len(data)], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * _powers(size, _BASE_INVERSE)[starts]
    return mix(codes + (ends - starts).astype(np.uint64)), starts


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of all texts in order, and where each text's words begin (one more at the end)."""
    buffer = b"\n".join(texts) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    codes, places, at = [], [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        if end < len(data):
            # A segment ends at white space; a single longer word makes a longer segment.
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while not _SPACE[data[end]]:
                    end += 1
                end += 1
        c, s = _hash_segment(data[at:end])
        codes.append(c)
        places.append(s + at)
        at = end
    codes_all, places_all = np.concatenate(codes), np.concatenate(places)
    text_at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))) if texts else np.zeros(1, np.int64)
    return codes_all, np.searchsorted(places_all, text_at)


def sequence_codes(codes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The code of the ``length`` words that start at each place; the last places have none."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    salts = np.random.Generator(np.random.PCG64(7 + seed)).integers(0, 2**63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out += codes[i : i + n] * salts[i]
    return mix(out)


def as_bytes(text) -> bytes:
    return b"" if text is None or not isinstance(text, str) else text.encode("utf-8", "surrogatepass")


def chunks(texts: list[bytes], limit: int = 4 << 20):
    """Ranges of texts of about ``limit`` bytes; a longer text is alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)
