"""Metric rollups over time windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as C
from ..functions.predicates import lookback, of_type
from ..schemas import DISTRIBUTION_TYPES, NUMBER_TYPES
from .gather import Total, gather, total

# What tells a series apart.
SERIES = ["name", "service_name", "metric_type"]


def metrics_rollup(
    metrics: DataFrame,
    size: str = "1 minute",
    delay: str | None = None,
    percentiles: bool = False,
    types: tuple[str, ...] | None = NUMBER_TYPES,
    as_of: Column | None = None,
) -> DataFrame:
    """Count, mean, extremes and sum per series and window; percentiles on request."""
    if types is not None:
        metrics = of_type(metrics, *types)
    if delay:
        metrics = metrics.withWatermark("metric_timestamp", delay)
    stats = [
        F.count("*").alias("sample_count"),
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.sum("value").alias("sum_value"),
    ]
    names = ["sample_count", "avg_value", "min_value", "max_value", "sum_value"]
    picked = [F.col(n) for n in names]
    if percentiles:
        stats.append(F.percentile_approx("value", [0.5, 0.95, 0.99]).alias("_q"))
        picked += [F.get("_q", i).alias(n) for i, n in enumerate(["p50_value", "p95_value", "p99_value"])]
    grouped = metrics.groupBy(*SERIES, F.window("metric_timestamp", size).alias("window")).agg(*stats)
    return grouped.select(
        *SERIES,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *picked,
        C.now(as_of).alias("ingestion_timestamp"),
    )


def rerollup(rollup: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Coarser rollup from a finer one.

    ``avg_value`` is the mean of the finer means; ``weighted_avg_value`` is
    the mean over the samples.
    """
    grouped = rollup.groupBy(*SERIES, C.floor_to("window_start", size).alias("window_start")).agg(
        F.sum("sample_count").alias("sample_count"),
        F.avg("avg_value").alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("sum_value").alias("sum_value"),
    )
    return grouped.select(
        *SERIES,
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {size}")).alias("window_end"),
        "sample_count", "avg_value", "min_value", "max_value", "sum_value",
        F.try_divide(F.col("sum_value"), F.col("sample_count")).alias("weighted_avg_value"),
    )


def resolutions(rollup: DataFrame, sizes: dict[str, str], hours: dict[str, int] | None = None, as_of: Column | None = None) -> DataFrame:
    """A finer rollup at several resolutions at once: ``rollup_window`` (the label) and the columns of ``rerollup``.

    One scan: each row goes to one window of each size, and rows of a window are combined in each task before
    the shuffle. ``hours`` is how far back the windows of each label start, ``as_of`` from when.
    """
    cut = rollup
    if hours is not None:
        # A window starts before its rows, so rows further back than the longest lookback belong to none.
        cut = lookback(rollup, "window_start", f"{max(hours.values())} HOURS", as_of)
    at = [F.struct(F.lit(label).alias("label"), C.floor_to("window_start", size).alias("start")) for label, size in sizes.items()]
    dealt = cut.select(F.explode(F.array(*at)).alias("to"), *SERIES, "sample_count", "avg_value", "min_value", "max_value", "sum_value")
    if hours is not None:
        since = C.now(as_of)
        dealt = dealt.filter(reduce(
            lambda a, b: a | b,
            ((F.col("to.label") == label) & (F.col("to.start") >= since - F.expr(f"INTERVAL {back} HOURS")) for label, back in hours.items()),
        ))
    grouped = dealt.groupBy(F.col("to.label").alias("rollup_window"), *SERIES, F.col("to.start").alias("window_start")).agg(
        F.sum("sample_count").alias("sample_count"), F.avg("avg_value").alias("avg_value"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("sum_value").alias("sum_value"),
    )
    return grouped.withColumn("weighted_avg_value", F.try_divide(F.col("sum_value"), F.col("sample_count")))


def metric_rollups_hourly(
    metrics: DataFrame, interval: str | None = "2 days", as_of: Column | None = None
) -> DataFrame:
    """Hourly statistics with standard deviation, per name and service."""
    recent = lookback(metrics, "metric_timestamp", interval, as_of)
    hour = F.date_trunc("hour", "metric_timestamp").alias("hour")
    return recent.groupBy("name", "service_name", hour).agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.stddev("value").alias("stddev_value"),
        F.count("*").alias("sample_count"),
    )


def _distribution_totals() -> dict[str, Total]:
    count = F.coalesce("histogram_count", "exp_histogram_count", "summary_count")
    value = F.coalesce("histogram_sum", "exp_histogram_sum", "summary_sum")
    bounds = {"_bounds": F.min("histogram_bounds"), "_last_bounds": F.max("histogram_bounds")}
    return {
        "total_count": total(F.sum(count), F.sum, "_count"),
        "total_sum": total(F.sum(value), F.sum, "_sum"),
        "min_value": total(F.min(F.coalesce("histogram_min", "exp_histogram_min")), F.min, "_min"),
        "max_value": total(F.max(F.coalesce("histogram_max", "exp_histogram_max")), F.max, "_max"),
        "histogram_bounds": total(bounds["_bounds"], F.min, "_bounds"),
        "bounds_mismatch": Total(bounds, lambda over: over(F.min, "_bounds") != over(F.max, "_last_bounds")),
        "exp_histogram_scale": total(F.min("exp_histogram_scale"), F.min, "_scale"),
        "exp_histogram_zero_count_sum": total(F.sum("exp_histogram_zero_count"), F.sum, "_zeros"),
    }


# What a point brings to the lists of its group.
POINT_LISTS = {
    "histogram_buckets_list": "histogram_buckets",
    "exp_histogram_positive_bucket_list": "exp_histogram_positive_bucket",
    "exp_histogram_negative_bucket_list": "exp_histogram_negative_bucket",
    "summary_quantiles_list": "summary_quantiles",
}


def _windowed_points(metrics: DataFrame, size: str) -> DataFrame:
    spread = F.xxhash64(
        F.map_keys("attributes"), F.map_values("attributes"), "histogram_sum", "exp_histogram_sum", "summary_sum"
    )
    points = of_type(metrics, *DISTRIBUTION_TYPES)
    return points.withColumns({"window": F.window("metric_timestamp", size), "_spread": spread})


def _with_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_value", C.hist_mean(F.col("total_sum"), F.col("total_count")))


_DISTRIBUTION_COLUMNS = [
    "total_count", "total_sum", "avg_value", "min_value", "max_value", "histogram_bounds", "bounds_mismatch",
    "exp_histogram_scale", "exp_histogram_zero_count_sum",
]


def _unwindowed(df: DataFrame, *columns: str, as_of: Column | None) -> DataFrame:
    return df.select(
        *SERIES, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns,
        C.now(as_of).alias("ingestion_timestamp"),
    )


def histogram_totals(
    metrics: DataFrame, size: str = "1 minute", delay: str | None = None, as_of: Column | None = None
) -> DataFrame:
    """Counts, sums and extremes of histogram, exponential-histogram and summary points, batch or stream.

    State is bounded: nothing is listed. A stream keeps the points themselves with
    ``distribution_points``; ``with_point_lists`` puts the two written tables together.
    """
    if delay:
        metrics = metrics.withWatermark("metric_timestamp", delay)
    grouped = gather(_windowed_points(metrics, size), [*SERIES, "window"], _distribution_totals(), {}, 1, [])
    return _unwindowed(_with_mean(grouped), *_DISTRIBUTION_COLUMNS, as_of=as_of)


def distribution_points(metrics: DataFrame, size: str = "1 minute") -> DataFrame:
    """The points by series, window and time with what they bring to lists: a projection, batch or stream."""
    points = _windowed_points(metrics, size)
    return points.select(*SERIES, F.col("window.start").alias("window_start"), "metric_timestamp", "_spread", *POINT_LISTS.values())


def _lists() -> dict[str, Column]:
    return {n: F.collect_list(c) for n, c in POINT_LISTS.items()}


def with_point_lists(totals: DataFrame, points: DataFrame, parts: int = 1) -> DataFrame:
    """Written totals with the lists of their written points: one row per series, window and part."""
    keys = [*SERIES, "window_start"]
    lists = gather(points, keys, {}, _lists(), parts, ["metric_timestamp", "_spread"])
    key = F.struct(*keys).alias("_key")
    listed = lists.select(key, "part", *POINT_LISTS)
    others = [c for c in totals.columns if c not in keys]
    return totals.select(key, *others).join(listed, "_key").select("_key.*", "*").drop("_key")


def histogram_rollup(
    metrics: DataFrame, size: str = "1 minute", parts: int = 1, as_of: Column | None = None
) -> DataFrame:
    """Histogram, exponential-histogram and summary points of a batch per series and window.

    The points' buckets and quantiles are kept as lists: ``parts`` rows per group, one by default,
    each with the totals of the whole group and a share of the lists. Streams keep
    ``histogram_totals`` and ``distribution_points``. ``bounds_mismatch`` tells that bounds differ
    inside the group; use ``merge_histograms`` for sums that respect them.
    """
    points = _windowed_points(metrics, size)
    grouped = gather(points, [*SERIES, "window"], _distribution_totals(), _lists(), parts, ["metric_timestamp", "_spread"])
    return _unwindowed(
        _with_mean(grouped), "part", "total_count", "total_sum", "avg_value", "min_value", "max_value",
        "histogram_bounds", "bounds_mismatch", "histogram_buckets_list", "exp_histogram_scale",
        "exp_histogram_zero_count_sum", "exp_histogram_positive_bucket_list", "exp_histogram_negative_bucket_list",
        "summary_quantiles_list", as_of=as_of,
    )


def histogram_rollup_profile(rollup: DataFrame) -> DataFrame:
    """How many bucket lists and quantile lists each rollup row kept."""
    return rollup.select(
        *SERIES, "window_start", "part", "total_count", "avg_value",
        F.size("histogram_buckets_list").alias("bucket_samples_count"),
        F.size("summary_quantiles_list").alias("quantile_samples_count"),
    )


def rollup_gaps(
    rollup: DataFrame, start: Column | None = None, end: Column | None = None, step: str = "1 minute"
) -> DataFrame:
    """Windows between ``start`` and ``end`` in which a live series has no row; without them, of the rollup's own range.

    One pass: each series' distinct windows in order tell where it has gaps, and only those are
    spelled out. A series' windows, not its samples, meet in one task.
    """
    key = F.struct("name", "service_name").alias("series")
    seen = rollup.select(key, F.col("window_start").alias("at"))
    if start is not None:
        seen = seen.filter(F.col("at") >= start)
    if end is not None:
        seen = seen.filter(F.col("at") <= end)
    seen = seen.groupBy("series", "at").agg(F.lit(1).alias("one")).drop("one")
    order = Window.partitionBy("series").orderBy("at")
    span = F.expr(f"INTERVAL {step}")
    steps = seen.select("series", "at", F.lead("at").over(order).alias("next"), F.lag("at").over(order).alias("before"))
    # Series that begin late or end early lack the edges of the range: a gap before the first or behind the last window.
    if start is None or end is None:
        # The same aggregate again, which Spark runs once.
        edges = seen.agg(F.struct(F.min("at").alias("lo"), F.max("at").alias("hi"))).scalar()
        start, end = (edges["lo"] if start is None else start), (edges["hi"] if end is None else end)
    inner = F.when(F.col("next").isNotNull(), F.struct((F.col("at") + span).alias("lo"), (F.col("next") - span).alias("hi")))
    head = F.when(F.col("before").isNull(), F.struct(start.alias("lo"), (F.col("at") - span).alias("hi")))
    tail = F.when(F.col("next").isNull(), F.struct((F.col("at") + span).alias("lo"), end.alias("hi")))
    gaps = steps.select("series", F.explode(F.array(inner, head, tail)).alias("gap")).filter("gap.lo <= gap.hi")
    return gaps.select(
        "series.name", "series.service_name", F.explode(F.sequence("gap.lo", "gap.hi", span)).alias("expected_window_start"),
        F.lit("MISSING").alias("status"),
    )


def latest_windows(rollup: DataFrame, k: int = 100) -> DataFrame:
    return rollup.orderBy(F.desc("window_start"), "name", "service_name", "metric_type").limit(k)
