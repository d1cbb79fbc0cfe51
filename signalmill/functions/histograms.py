"""Quantiles from explicit-bucket histograms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bucket_total(buckets: Column) -> Column:
    return F.aggregate(buckets, F.lit(0).cast("bigint"), lambda acc, n: acc + n)


def histogram_quantile(
    buckets: Column, bounds: Column, q: float, low: Column | None = None, high: Column | None = None
) -> Column:
    """Value below which a share ``q`` of the observations lies.

    Linear inside the bucket that holds the wanted rank. The first bucket
    starts at ``low`` (else 0 or its own bound if that is negative), the last
    one ends at ``high`` (else its lower bound). NULL for empty or malformed
    histograms.
    """
    rank = bucket_total(buckets) * F.lit(float(q))
    first = F.least(F.lit(0.0), F.element_at(bounds, 1))
    low = first if low is None else F.coalesce(low, first)
    last = F.element_at(bounds, -1)
    high = last if high is None else F.coalesce(high, last)

    def step(acc: Column, i: Column) -> Column:
        n = F.get(buckets, i)
        below = acc["below"]
        start = F.when(i == 0, low).otherwise(F.get(bounds, i - 1))
        end = F.when(i == F.size(bounds), high).otherwise(F.get(bounds, i))
        inside = (n > 0) & (below + n >= rank)
        value = F.when(
            acc["value"].isNull() & inside, start + (end - start) * (rank - below) / n
        ).otherwise(acc["value"])
        return F.struct((below + n).alias("below"), value.alias("value"))

    start = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("double").alias("value"))
    found = F.aggregate(F.sequence(F.lit(0), F.size(bounds)), start, step)["value"]
    well_formed = (F.size(bounds) > 0) & (F.size(buckets) == F.size(bounds) + 1)
    return F.when(well_formed & (bucket_total(buckets) > 0), found)
