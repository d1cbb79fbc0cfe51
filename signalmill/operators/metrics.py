"""Raw metric points to flat rows, one scan for all five types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..schemas import METRIC_TYPES, NUMBER_TYPES
from .dedup import attribute_key, attribute_text, dedup, row_order

DEDUP_KEYS = ["name", "service_name", "metric_timestamp", "metric_type"]

# Output column -> the type that carries it and the field it comes from.
TYPED_FIELDS = {
    "histogram_count": ("histogram", "count"),
    "histogram_sum": ("histogram", "sum"),
    "histogram_min": ("histogram", "min"),
    "histogram_max": ("histogram", "max"),
    "histogram_buckets": ("histogram", "bucket_counts"),
    "histogram_bounds": ("histogram", "explicit_bounds"),
    "exp_histogram_count": ("exponential_histogram", "count"),
    "exp_histogram_sum": ("exponential_histogram", "sum"),
    "exp_histogram_min": ("exponential_histogram", "min"),
    "exp_histogram_max": ("exponential_histogram", "max"),
    "exp_histogram_scale": ("exponential_histogram", "scale"),
    "exp_histogram_zero_count": ("exponential_histogram", "zero_count"),
    "exp_histogram_positive_bucket": ("exponential_histogram", "positive_bucket"),
    "exp_histogram_negative_bucket": ("exponential_histogram", "negative_bucket"),
    "summary_count": ("summary", "count"),
    "summary_sum": ("summary", "sum"),
    "summary_quantiles": ("summary", "quantile_values"),
}


def _by_type(types: tuple[str, ...], field: str) -> Column:
    """The field of whichever of ``types`` the row is tagged with."""
    tag = F.col("metric_type")
    chosen = F.when(tag == types[0], F.col(f"{types[0]}.{field}"))
    for name in types[1:]:
        chosen = chosen.when(tag == name, F.col(f"{name}.{field}"))
    return chosen


def flatten_metrics(raw: DataFrame, precision: str = "micro", as_of: Column | None = None) -> DataFrame:
    """Flat points of all five types. An unknown type keeps its row, with NULL time and values."""
    return raw.select(
        "name",
        "description",
        "unit",
        C.res_attr("service.name").alias("service_name"),
        C.nanos_to_ts(_by_type(METRIC_TYPES, "time_unix_nano"), precision).alias("metric_timestamp"),
        "metric_type",
        _by_type(NUMBER_TYPES, "value").alias("value"),
        *[_by_type((kind,), field).alias(name) for name, (kind, field) in TYPED_FIELDS.items()],
        _by_type(METRIC_TYPES, "attributes").alias("attributes"),
        C.now(as_of).alias("ingestion_timestamp"),
    )


def point_order(flat: DataFrame) -> list[Column]:
    """Which of several copies of a point ``dedup_metrics`` keeps."""
    return row_order(flat, more=(attribute_key(F.col("attributes")),))


def dedup_metrics(
    flat: DataFrame,
    delay: str | None = None,
    by_attributes: bool = True,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """One point per series and time.

    A series is told apart by its attributes too; ``by_attributes=False`` is
    the coarser key that merges such series. ``delay`` is for streams: the
    event time is part of the key, so state ends with the watermark.

    In a batch the attributes are compared as one text. Columns that are not read afterwards stay out of the
    shuffle: take single attributes before, with the ``point_order`` of the bare points.
    """
    watermark = ("metric_timestamp", delay) if delay else None
    if not by_attributes:
        return dedup(flat, DEDUP_KEYS, watermark, order_by=order_by)
    key = attribute_key if flat.isStreaming else attribute_text
    if order_by is None and not flat.isStreaming:
        order_by = point_order(flat)
    keyed = flat.withColumn("_attributes", key(F.col("attributes")))
    return dedup(keyed, DEDUP_KEYS + ["_attributes"], watermark, order_by=order_by).drop("_attributes")


def _typed_points(raw: DataFrame, kind: str, value: Column, extra: dict[str, str], precision: str) -> DataFrame:
    return raw.filter(F.col("metric_type") == kind).select(
        "name",
        "description",
        "unit",
        C.res_attr("service.name").alias("service_name"),
        C.nanos_to_ts(F.col(f"{kind}.time_unix_nano"), precision).alias("metric_timestamp"),
        value.alias("value"),
        F.col(f"{kind}.attributes").alias("metric_attributes"),
        F.lit(kind).alias("metric_type_detail"),
        *[F.col(f"{kind}.{field}").alias(name) for name, field in extra.items()],
    )


def union_metrics(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def flatten_metrics_by_type(raw: DataFrame, precision: str = "micro", as_of: Column | None = None) -> DataFrame:
    """Gauge, sum and histogram points as one projection per type, united by name.

    Each branch scans the table; :func:`flatten_metrics` needs one scan.
    """
    gauges = _typed_points(raw, "gauge", F.col("gauge.value"), {}, precision)
    sums = _typed_points(
        raw, "sum", F.col("sum.value"),
        {"is_monotonic": "is_monotonic", "aggregation_temporality": "aggregation_temporality"}, precision,
    )
    histograms = _typed_points(
        raw, "histogram", C.hist_mean(F.col("histogram.sum"), F.col("histogram.count")),
        {
            "histogram_count": "count", "histogram_sum": "sum", "histogram_min": "min",
            "histogram_max": "max", "bucket_counts": "bucket_counts", "explicit_bounds": "explicit_bounds",
        },
        precision,
    )
    return C.stamp(union_metrics(gauges, sums, histograms), as_of=as_of)
