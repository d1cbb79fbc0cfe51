"""Filters: lookbacks, roots and children, thresholds, ranges, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .columns import lag_seconds, now


def lookback(df: DataFrame, ts: str, interval: str | None, as_of: Column | None = None) -> DataFrame:
    """Rows not older than ``interval`` before ``as_of``.

    The bare column is compared, so the bound reaches the file scan.
    """
    if interval is None:
        return df
    return df.filter(F.col(ts) >= now(as_of) - F.expr(f"INTERVAL {interval}"))


def children(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("parent_span_id").isNotNull())


def roots(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("parent_span_id").isNull())


def of_type(metrics: DataFrame, *types: str) -> DataFrame:
    return metrics.filter(F.col("metric_type").isin(*types))


def breaches(df: DataFrame, error: str = "error_rate", latency: str = "p95_latency_ms") -> DataFrame:
    """Rows above either threshold; a NULL threshold never fires."""
    return df.filter(
        (F.col(error) > F.col("error_rate_threshold")) | (F.col(latency) > F.col("latency_threshold"))
    )


def out_of_range(latency: str = "latency_p95_ms", count: str = "request_count") -> Column:
    """Impossible golden signals; NULLs are not out of range."""
    return F.coalesce(
        (F.col("error_rate") < 0)
        | (F.col("error_rate") > 1)
        | (F.col(latency) < 0)
        | (F.col(count) < 0),
        F.lit(False),
    )


def invalid_health(df: DataFrame, latency: str = "latency_p95_ms", count: str = "request_count") -> DataFrame:
    """Rows with missing or impossible golden signals."""
    missing = F.col("error_rate").isNull() | F.col(latency).isNull() | F.col(count).isNull()
    return df.filter(missing | out_of_range(latency, count))


def trace_spans(spans: DataFrame, trace_id: str) -> DataFrame:
    """The spans of one trace in time order."""
    return spans.filter(F.col("trace_id") == trace_id).orderBy("start_timestamp", "span_id")


def trace_logs(logs: DataFrame, trace_id: str) -> DataFrame:
    """The log records of one trace in time order."""
    return logs.filter(F.col("trace_id") == trace_id).orderBy("log_timestamp", "log_key")


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def body_matches(logs: DataFrame, word: str) -> DataFrame:
    return logs.filter(F.col("body").contains(word))


def laggards(df: DataFrame, ts: str, ingest: str, max_lag: int = 300) -> DataFrame:
    """Rows that arrived more than ``max_lag`` seconds after they happened."""
    lag = lag_seconds(F.col(ts), F.col(ingest))
    return df.withColumn("lag_minutes", F.round(lag / 60, 2)).filter(lag > max_lag)


def missing_buckets(metrics: DataFrame) -> DataFrame:
    """Histogram points without buckets, bounds or count."""
    lost = F.lit(False)
    for name in ("histogram_buckets", "histogram_bounds", "histogram_count"):
        lost = lost | F.col(name).isNull()
    return of_type(metrics, "histogram").filter(lost)
