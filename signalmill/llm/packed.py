"""Packed rows: many small records of one bucket in one binary cell, and the session settings they need."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import tune, work_dir


def ready(spark: SparkSession) -> SparkSession:
    """Settings of these operators: long texts go to Python in small batches."""
    tune(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def buckets(spark: SparkSession, each: int = 4) -> int:
    """How many buckets packed records are dealt to: some for each shuffle partition."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: later plans start there."""
    path = work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SMALL_ROWS = 1_000_000  # of a few numbers each: what a join may send to all tasks


def is_small(df: DataFrame) -> bool:
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that leaves the texts of ``big`` where they are if ``small`` is counted to be small, else by shuffle."""
    return big.join(F.broadcast(small) if is_small(small) else small, on, how)


def kinds_of(df: DataFrame, names) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*(F.col(f"`{n}`") for n in names)).schema.fields)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as one cell; ids are kept as differences, which compress well."""
    parts = [np.int64(len(arrays[0])).tobytes()]
    for a in arrays:
        parts.append(np.diff(a, prepend=a.dtype.type(0)).tobytes() if a.dtype == np.int64 else a.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(cell: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(cell)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out, at = [], 8
    for t in types:
        a = np.frombuffer(raw, t, n, at)
        out.append(np.cumsum(a) if np.dtype(t) == np.int64 else a)
        at += n * np.dtype(t).itemsize
    return out


def unpack_all(cells, *types) -> list[np.ndarray]:
    parts = [unpack(c, *types) for c in cells]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate(types)]


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> pd.DataFrame:
    """One row for each bucket that has records: bucket, cell."""
    order = np.argsort(bucket, kind="stable")
    sorted_buckets = bucket[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_buckets[1:] != sorted_buckets[:-1]))) if len(bucket) else []
    ends = np.append(starts[1:], len(bucket)) if len(bucket) else []
    moved = [a[order] for a in arrays]
    return pd.DataFrame(
        {
            "bucket": np.asarray([sorted_buckets[s] for s in starts], np.int64),
            "cell": [pack(*(a[s:e] for a in moved)) for s, e in zip(starts, ends)],
        }
    )


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, over sorted keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)
