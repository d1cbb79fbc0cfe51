"""Merging of explicit and exponential histograms and of summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.histograms import histogram_quantile
from ..functions.predicates import of_type

SERIES = ["name", "service_name"]


def merge_histograms(metrics: DataFrame, size: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """Element-wise sum of the buckets of a series and window, separately per bounds.

    Buckets are summed by position before anything is gathered, so a series of
    any length reaches the second aggregate as one row per bucket.
    """
    keys = SERIES if keys is None else keys
    points = of_type(metrics, "histogram").select(
        *keys,
        F.window("metric_timestamp", size)["start"].alias("window_start"),
        F.col("histogram_bounds").alias("bounds"),
        F.col("histogram_count").alias("_count"),
        F.col("histogram_sum").alias("_sum"),
        F.col("histogram_min").alias("_min"),
        F.col("histogram_max").alias("_max"),
        F.posexplode_outer("histogram_buckets").alias("pos", "n"),
    )
    # Exactly one exploded row per point carries the point's own totals.
    head = F.coalesce(F.col("pos"), F.lit(0)) == 0
    group = [*keys, "window_start", "bounds"]
    by_bucket = points.groupBy(*group, "pos").agg(
        F.sum("n").alias("n"),
        F.count_if(head).alias("_points"),
        F.sum(F.when(head, F.col("_count"))).alias("_count"),
        F.sum(F.when(head, F.col("_sum"))).alias("_sum"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
    )
    bucket = F.when(F.col("pos").isNotNull(), F.struct("pos", "n"))
    return by_bucket.groupBy(*group).agg(
        F.sum("_points").alias("point_count"),
        F.sum("_count").alias("total_count"),
        F.sum("_sum").alias("total_sum"),
        F.min("_min").alias("min_value"),
        F.max("_max").alias("max_value"),
        F.transform(F.sort_array(F.collect_list(bucket)), lambda b: b["n"]).alias("buckets"),
    )


def histogram_percentiles(merged: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """p50, p95, ... columns of merged histograms."""
    return merged.withColumns(
        {
            f"p{round(q * 100)}_value": histogram_quantile(
                F.col("buckets"), F.col("bounds"), q, F.col("min_value"), F.col("max_value")
            )
            for q in quantiles
        }
    )


def _signed(bucket: str, sign: int) -> Column:
    """Buckets of one range as (sign, index, count) structs."""
    counts, offset = F.col(f"{bucket}.bucket_counts"), F.col(f"{bucket}.offset")
    cells = F.transform(
        counts,
        lambda n, i: F.struct(
            F.lit(sign).alias("sign"), (F.coalesce(offset, F.lit(0)) + i).alias("idx"), n.alias("n")
        ),
    )
    return F.coalesce(cells, F.array().cast("array<struct<sign:int,idx:int,n:bigint>>"))


def merge_exp_histograms(metrics: DataFrame, size: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """Sum of exponential histograms of a series and window at their smallest scale.

    Bucket ``i`` at scale ``s`` covers (b^i, b^(i+1)], b = 2^(2^-s). One step
    down in scale joins neighbours pairwise, an arithmetic right shift of the
    index. Points are first summed per scale and index; the smallest scale is
    then looked up over those few rows, not over the points.
    """
    keys = SERIES if keys is None else keys
    header = F.array(
        F.struct(F.lit(0).alias("sign"), F.lit(None).cast("int").alias("idx"), F.lit(None).cast("bigint").alias("n"))
    )
    points = of_type(metrics, "exponential_histogram").select(
        *keys,
        F.window("metric_timestamp", size)["start"].alias("window_start"),
        F.col("exp_histogram_scale").alias("scale"),
        F.col("exp_histogram_count").alias("_count"),
        F.col("exp_histogram_sum").alias("_sum"),
        F.col("exp_histogram_zero_count").alias("_zero"),
        F.col("exp_histogram_min").alias("_min"),
        F.col("exp_histogram_max").alias("_max"),
        F.explode(
            F.concat(
                header,
                _signed("exp_histogram_positive_bucket", 1),
                _signed("exp_histogram_negative_bucket", -1),
            )
        ).alias("cell"),
    )
    group = [*keys, "window_start"]
    head = F.col("cell.sign") == 0
    cells = points.groupBy(
        *group, "scale", F.col("cell.sign").alias("sign"), F.col("cell.idx").alias("idx")
    ).agg(
        F.sum("cell.n").alias("n"),
        F.count_if(head).alias("_points"),
        F.sum(F.when(head, F.col("_count"))).alias("_count"),
        F.sum(F.when(head, F.col("_sum"))).alias("_sum"),
        F.sum(F.when(head, F.col("_zero"))).alias("_zero"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
    )
    smallest = F.min("scale").over(Window.partitionBy(*group))
    shift = F.col("scale") - F.col("min_scale")
    # A shift by d is a floor division by 2^d, also for negative indexes.
    down = F.floor(F.col("idx") / F.pow(F.lit(2.0), shift)).cast("int")
    merged = (
        cells.withColumn("min_scale", smallest)
        .withColumn("idx", down)
        .groupBy(*group, "min_scale", "sign", "idx")
        .agg(
            F.sum("n").alias("n"),
            *[F.sum(c).alias(c) for c in ("_points", "_count", "_sum", "_zero")],
            F.min("_min").alias("_min"),
            F.max("_max").alias("_max"),
        )
    )

    def side(sign: int) -> Column:
        cell = F.when((F.col("sign") == sign) & (F.col("n") > 0), F.struct("idx", "n"))
        return F.sort_array(F.collect_list(cell))

    return merged.groupBy(*group, F.col("min_scale").alias("scale")).agg(
        F.sum("_points").alias("point_count"),
        F.sum("_count").alias("total_count"),
        F.sum("_sum").alias("total_sum"),
        F.sum("_zero").alias("zero_count"),
        F.min("_min").alias("min_value"),
        F.max("_max").alias("max_value"),
        side(1).alias("positive"),
        side(-1).alias("negative"),
    )


def summary_quantiles(metrics: DataFrame, size: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """Reported quantile values of a series and window: count, mean and extremes per quantile."""
    keys = SERIES if keys is None else keys
    points = of_type(metrics, "summary").select(
        *keys,
        F.window("metric_timestamp", size)["start"].alias("window_start"),
        F.explode("summary_quantiles").alias("q"),
    )
    return points.groupBy(*keys, "window_start", F.col("q.quantile").alias("quantile")).agg(
        F.count("*").alias("point_count"),
        F.avg("q.value").alias("avg_value"),
        F.min("q.value").alias("min_value"),
        F.max("q.value").alias("max_value"),
    )


def rollup_quantiles(rollup: DataFrame) -> DataFrame:
    """The same from the lists a histogram rollup keeps."""
    return rollup.select(
        "name", "service_name", "window_start", F.explode(F.flatten("summary_quantiles_list")).alias("q")
    ).groupBy("name", "service_name", F.col("q.quantile").alias("quantile")).agg(
        F.count("*").alias("point_count"), F.min("q.value").alias("min_value"), F.max("q.value").alias("max_value")
    )
