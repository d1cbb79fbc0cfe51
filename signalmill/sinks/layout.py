"""Tables laid out for lookups by several keys: a space-filling order, and Bloom filters for ids.

Rows are dealt along a Z-order curve. Each key's values are cut into 2^bits ranges of about as many rows each,
and the bits of a row's ranges are interleaved, so rows of one file or row group lie close together in all keys
at once and the statistics of most groups rule out a lookup by any of them. Ids that lie nowhere close, such as
trace ids, get a Bloom filter in each row group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import now

SAMPLE = 20_000  # rows that the ranges of a key are cut by; the order of rows is all that depends on them


def range_bounds(df: DataFrame, columns: list[str], bits: int) -> dict[str, list]:
    """Values that cut each column into 2^bits ranges, from a sample of the rows: at most 2^bits - 1 of each."""
    rows = df.select(*(F.col(c) for c in columns))
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    taken = rows.sample(share, seed=7).limit(2 * SAMPLE).collect() if share < 1 else rows.collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in taken if r[c] is not None)
        cuts = [values[i * len(values) >> bits] for i in range(1, 1 << bits)] if values else []
        out[c] = sorted(set(cuts))
    return out


def range_number(value: Column, bounds: list) -> Column:
    """How many bounds are not above the value (null: none), by halving: a comparison for each bit."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def z_order(numbers: list[Column], bits: int) -> Column:
    """The bits of several numbers, interleaved from the highest on."""
    out = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for n in numbers:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(n.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint")))
    return out


def rewrite_z_ordered(
    df: DataFrame, path: str, columns: list[str], ids: dict[str, int] | None = None, bits: int = 6,
    partitions: int | None = None, target_rows: int = 5_000_000, options: dict[str, str] | None = None,
) -> None:
    """Rewrites a table in the Z-order of ``columns``; ``ids`` are columns with Bloom filters and how many values a row group has.

    Ranges of the curve are the partitions; a hash of the row comes last, so that a value which fills
    many files is cut into several. Rows without a key value are in its first range.
    """
    if not 1 <= bits * len(columns) <= 63:
        raise ValueError("the interleaved bits must fit a long")
    bounds = range_bounds(df, columns, bits)
    placed = df.withColumn("_z", z_order([range_number(F.col(c), bounds[c]) for c in columns], bits))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    keys = [F.col("_z"), F.xxhash64(*plain)]
    dealt = placed.repartitionByRange(*keys) if partitions is None else placed.repartitionByRange(partitions, *keys)
    writer = dealt.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").option("maxRecordsPerFile", target_rows)
    for name, distinct in (ids or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct))
    writer.options(**(options or {})).parquet(path)


def raw_lookback(raw: DataFrame, nanos: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """Raw rows not older than ``interval`` before ``as_of``, by the bare nanosecond column.

    Before flattening, so the bound reaches the scan of raw files, where a bound on the derived time can't.
    """
    since = F.unix_micros(now(as_of) - F.expr(f"INTERVAL {interval}")) * 1000
    return raw.filter(F.col(nanos) >= since)
