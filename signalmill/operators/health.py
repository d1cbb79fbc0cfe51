"""Golden signals per service and time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as C
from ..functions.predicates import lookback


def _latency(*quantiles: float) -> Column:
    """Several percentiles from one sketch."""
    return F.percentile_approx("duration_ms", list(quantiles))


def service_health(
    spans: DataFrame, size: str = "1 minute", delay: str | None = None, as_of: Column | None = None
) -> DataFrame:
    """Traffic, errors and latency per window and service, for batch and stream."""
    if delay:
        spans = spans.withWatermark("start_timestamp", delay)
    grouped = (
        spans.filter(F.col("service_name").isNotNull())
        .groupBy(F.window("start_timestamp", size).alias("window"), "service_name")
        .agg(
            F.count("*").alias("request_count"),
            F.sum(F.col("is_error").cast("int")).alias("error_count"),
            _latency(0.5, 0.95, 0.99).alias("_q"),
            F.avg("duration_ms").alias("latency_avg_ms"),
            F.max("duration_ms").alias("latency_max_ms"),
            F.min("duration_ms").alias("latency_min_ms"),
        )
    )
    return grouped.select(
        F.col("window.start").alias("timestamp"),
        F.col("window.end").alias("window_end"),
        "service_name",
        "request_count",
        C.rps(F.col("request_count"), F.col("window")).alias("requests_per_second"),
        "error_count",
        (F.col("error_count") / F.col("request_count")).alias("error_rate"),
        F.get("_q", 0).alias("latency_p50_ms"),
        F.get("_q", 1).alias("latency_p95_ms"),
        F.get("_q", 2).alias("latency_p99_ms"),
        "latency_avg_ms",
        "latency_max_ms",
        "latency_min_ms",
        C.now(as_of).alias("ingestion_timestamp"),
    )


def service_health_5min(
    spans: DataFrame, interval: str | None = "90 days", as_of: Column | None = None, size: str = "5 minutes"
) -> DataFrame:
    """Five-minute health straight from spans; a missing service is a group of its own."""
    recent = lookback(spans, "start_timestamp", interval, as_of)
    grouped = recent.groupBy(C.tumble("start_timestamp", size).alias("timestamp"), "service_name").agg(
        (F.count_if("is_error") / F.count("*")).alias("error_rate"),
        _latency(0.5, 0.95, 0.99).alias("_q"),
        F.count("*").alias("total_requests"),
        F.avg("duration_ms").alias("avg_latency_ms"),
        F.min("duration_ms").alias("min_latency_ms"),
        F.max("duration_ms").alias("max_latency_ms"),
    )
    return grouped.select(
        "timestamp",
        "service_name",
        "error_rate",
        F.get("_q", 0).alias("p50_latency_ms"),
        F.get("_q", 1).alias("p95_latency_ms"),
        F.get("_q", 2).alias("p99_latency_ms"),
        "total_requests",
        "avg_latency_ms",
        "min_latency_ms",
        "max_latency_ms",
        C.now(as_of).alias("ingestion_timestamp"),
    )


def service_health_hourly(
    h5: DataFrame, interval: str | None = "30 days", as_of: Column | None = None
) -> DataFrame:
    """Hourly health from five-minute rows.

    The error rate is weighted by requests. Percentiles are the worst of the
    hour, an upper bound, since percentiles cannot be averaged.
    """
    recent = lookback(h5, "timestamp", interval, as_of)
    requests = F.sum("total_requests")
    return recent.groupBy("service_name", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.try_divide(F.sum(F.col("error_rate") * F.col("total_requests")), requests).alias("error_rate"),
        F.max("p95_latency_ms").alias("p95_latency_ms"),
        F.max("p99_latency_ms").alias("p99_latency_ms"),
        F.avg("avg_latency_ms").alias("avg_latency_ms"),
        requests.alias("total_requests"),
    ).withColumn("ingestion_timestamp", C.now(as_of))


def service_health_daily(hourly: DataFrame, interval: str | None = "90 DAYS", as_of: Column | None = None) -> DataFrame:
    """Days from hours: rates and means weighted by requests, the worst percentiles, and how many hours there were."""
    recent = lookback(hourly, "hour", interval, as_of)
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("total_requests")), F.sum("total_requests"))
    return recent.groupBy("service_name", F.to_date("hour").alias("day")).agg(
        weighted("error_rate").alias("error_rate"), F.max("p95_latency_ms").alias("p95_latency_ms"),
        F.max("p99_latency_ms").alias("p99_latency_ms"), weighted("avg_latency_ms").alias("avg_latency_ms"),
        F.sum("total_requests").alias("total_requests"), F.count("*").alias("hours"),
    )


def service_health_hourly_simple(
    h1: DataFrame, interval: str | None = None, as_of: Column | None = None
) -> DataFrame:
    """Hourly mean and maximum of the windowed signals, unweighted."""
    recent = lookback(h1, "timestamp", interval, as_of)
    return recent.groupBy("service_name", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.avg("error_rate").alias("avg_error_rate"),
        F.max("error_rate").alias("max_error_rate"),
        F.avg("latency_p95_ms").alias("avg_p95_latency_ms"),
        F.max("latency_p95_ms").alias("max_p95_latency_ms"),
        F.sum("request_count").alias("total_requests"),
    )


def window_gaps(h5: DataFrame, max_gap: int = 5) -> DataFrame:
    """Consecutive rows of a service that lie more than ``max_gap`` minutes apart.

    A service has one row per window here, so its history is bounded by time.
    """
    previous = F.lag("timestamp").over(Window.partitionBy("service_name").orderBy("timestamp"))
    gap = F.timestamp_diff("MINUTE", F.col("prev_timestamp"), F.col("timestamp"))
    return (
        h5.select("service_name", "timestamp", previous.alias("prev_timestamp"))
        .withColumn("gap_minutes", gap)
        .filter(F.col("gap_minutes") > max_gap)
    )


def span_volume(spans: DataFrame) -> DataFrame:
    """Spans per hour."""
    return (
        spans.groupBy(F.date_trunc("hour", "start_timestamp").alias("hour"))
        .agg(F.count("*").alias("span_count"))
        .orderBy(F.desc("hour"))
    )


def volume_change(spans: DataFrame) -> DataFrame:
    """Spans per hour as a percentage of the hour before.

    The ordered window runs over one row per hour, never over spans.
    """
    hourly = spans.groupBy(F.date_trunc("hour", "start_timestamp").alias("hour")).agg(
        F.count("*").alias("span_count")
    )
    before = F.lag("span_count").over(Window.orderBy("hour"))
    return hourly.withColumn("pct_change", F.col("span_count") * 100.0 / before).orderBy(F.desc("hour"))


def rows_per_day(df: DataFrame, ts: str = "timestamp", by: str = "service_name") -> DataFrame:
    """Row count, time span in days and rows per day of each group."""
    grouped = df.groupBy(by).agg(
        F.count("*").alias("row_count"), F.min(ts).alias("earliest"), F.max(ts).alias("latest")
    )
    days = F.datediff("latest", "earliest")
    return grouped.withColumns({"days": days, "rows_per_day": F.try_divide(F.col("row_count"), days)})


def records_per_date(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias("records")).orderBy("date")
