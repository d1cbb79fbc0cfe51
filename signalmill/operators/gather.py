"""Groups with lists of their rows, in one shape for every group."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass
class Total:
    """A value of the whole group: ``parts`` are aggregates of rows, ``merged`` puts them together.

    ``merged`` gets ``over(aggregate, name, then)``: a part's column aggregated over all parts of the group.
    """

    parts: dict[str, Column]
    merged: Callable[[Callable[..., Column]], Column]


def total(part: Column, merge: Callable[[Column], Column], name: str) -> Total:
    """A total whose parts one aggregate puts together."""
    return Total({name: part}, lambda over: over(merge, name))


def gather(df: DataFrame, keys: list[str], totals: dict[str, Total], lists: dict[str, Column], parts: int, spread: list[str]) -> DataFrame:
    """``keys``, ``part``, the totals of the whole group, and the part's lists.

    Every group has up to ``parts`` rows, whatever its size: the caller sets the number so that a
    part of the largest group fits a task. ``spread`` must tell the rows of a group apart. The rows
    are read once; parts meet for their totals after they are aggregated.
    """
    partial = {n: c for t in totals.values() for n, c in t.parts.items()}
    columns = [c.alias(n) for n, c in {**partial, **lists}.items()]
    if parts == 1:
        grouped = df.groupBy(*keys).agg(*columns).withColumn("part", F.lit(0))
        merged = {n: t.merged(lambda aggregate, name, then=None: F.col(name)) for n, t in totals.items()}
    else:
        split = df.withColumn("part", F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int"))
        grouped = split.groupBy(*keys, "part").agg(*columns)
        whole = Window.partitionBy(*keys)

        def over(aggregate, name, then=None):
            found = aggregate(F.col(name)).over(whole)
            return then(found) if then else found

        merged = {n: t.merged(over) for n, t in totals.items()}
    return grouped.select(*keys, "part", *[c.alias(n) for n, c in merged.items()], *lists)
