"""Statistical baselines and threshold detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import breaches, lookback


def anomaly_baselines(
    health: DataFrame,
    sigma: float = 3,
    days: int | None = 7,
    as_of: Column | None = None,
    latency: str = "p95_latency_ms",
) -> DataFrame:
    """Mean, sample deviation and mean + sigma deviations per service.

    A service with a single row has no deviation, hence NULL thresholds.
    """
    recent = lookback(health, "timestamp", f"{days} DAYS" if days is not None else None, as_of)
    stats = recent.groupBy("service_name").agg(
        F.avg("error_rate").alias("baseline_error_rate"),
        F.stddev_samp("error_rate").alias("error_rate_stddev"),
        F.avg(latency).alias("baseline_p95_latency_ms"),
        F.stddev_samp(latency).alias("latency_stddev"),
        F.count("*").alias("sample_count"),
        F.min("timestamp").alias("baseline_start_timestamp"),
        F.max("timestamp").alias("baseline_end_timestamp"),
    )
    return stats.select(
        "service_name",
        "baseline_error_rate",
        "error_rate_stddev",
        (F.col("baseline_error_rate") + sigma * F.col("error_rate_stddev")).alias("error_rate_threshold"),
        "baseline_p95_latency_ms",
        "latency_stddev",
        (F.col("baseline_p95_latency_ms") + sigma * F.col("latency_stddev")).alias("latency_threshold"),
        "sample_count",
        "baseline_start_timestamp",
        "baseline_end_timestamp",
        C.now(as_of).alias("baseline_computed_at"),
    )


def detect_anomalies(
    health: DataFrame,
    baselines: DataFrame,
    minutes: int | None = 2,
    as_of: Column | None = None,
    latency: str = "latency_p95_ms",
) -> DataFrame:
    """Recent health rows above either threshold of their service, labelled by cause.

    Baselines have one row per service; Spark broadcasts them when their
    measured size allows, and shuffles both sides otherwise.
    """
    recent = lookback(health, "timestamp", f"{minutes} MINUTES" if minutes is not None else None, as_of)
    thresholds = baselines.select("service_name", "error_rate_threshold", "latency_threshold")
    hits = breaches(recent.join(thresholds, "service_name"), "error_rate", latency)
    return hits.select(
        "service_name",
        "timestamp",
        "error_rate",
        "error_rate_threshold",
        F.col(latency).alias("p95_latency_ms"),
        "latency_threshold",
        C.anomaly_type(
            F.col("error_rate") > F.col("error_rate_threshold"), F.col(latency) > F.col("latency_threshold")
        ).alias("anomaly_type"),
        C.now(as_of).alias("detected_at"),
    )


def zscores(
    health: DataFrame,
    baselines: DataFrame,
    minutes: int | None = 5,
    as_of: Column | None = None,
) -> DataFrame:
    """Distance of current error rates from the baseline in deviations; NULL where there is none."""
    recent = lookback(health, "timestamp", f"{minutes} MINUTES" if minutes is not None else None, as_of)
    base = baselines.select("service_name", "baseline_error_rate", "error_rate_stddev")
    off = F.col("error_rate") - F.col("baseline_error_rate")
    return (
        recent.join(base, "service_name")
        .select(
            "service_name",
            "timestamp",
            F.col("error_rate").alias("current_error_rate"),
            "baseline_error_rate",
            "error_rate_stddev",
            F.try_divide(off, F.col("error_rate_stddev")).alias("z_score"),
        )
        .orderBy(F.desc_nulls_last("z_score"), "service_name", "timestamp")
    )


def anomalies_by_service(anomalies: DataFrame, interval: str | None = None, as_of: Column | None = None) -> DataFrame:
    return (
        lookback(anomalies, "detected_at", interval, as_of)
        .groupBy("service_name")
        .agg(F.count("*").alias("anomaly_count"))
        .orderBy(F.desc("anomaly_count"), "service_name")
    )


def recent_anomalies(anomalies: DataFrame, k: int = 20) -> DataFrame:
    return anomalies.orderBy(F.desc("detected_at"), F.desc("timestamp"), "service_name").limit(k)


def baseline_freshness(baselines: DataFrame, ts: str = "baseline_computed_at") -> DataFrame:
    return baselines.agg(F.max(ts).alias("latest_baseline"))
