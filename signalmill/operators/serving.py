"""Report queries on the derived tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import lookback
from .rollups import resolutions


def health_points(hourly: DataFrame, hours: int | None = 12, as_of: Column | None = None) -> DataFrame:
    """Recent hourly health, in no order: what further reports start from."""
    recent = lookback(hourly, "hour", f"{hours} HOURS" if hours is not None else None, as_of)
    return recent.select(
        F.col("hour").alias("timestamp"),
        "service_name",
        F.col("avg_error_rate").alias("error_rate"),
        F.col("avg_p95_latency_ms").alias("p95_latency_ms"),
        F.col("max_p95_latency_ms").alias("p99_latency_ms"),
        "total_requests",
    )


def health_series(hourly: DataFrame, hours: int | None = 12, as_of: Column | None = None) -> DataFrame:
    """Recent hourly health, newest first."""
    return health_points(hourly, hours, as_of).orderBy(F.desc("timestamp"), "service_name")


def route_summary(
    spans: DataFrame, hours: int | None = 12, k: int | None = 100, as_of: Column | None = None
) -> DataFrame:
    """Requests, mean duration and error rate per service, route and method; the busiest ``k``."""
    recent = lookback(spans, "start_timestamp", f"{hours} HOURS" if hours is not None else None, as_of)
    grouped = recent.groupBy(
        "service_name", C.attr("http.route").alias("http_route"), C.attr("http.method").alias("http_method")
    ).agg(
        F.count("*").alias("request_count"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.avg(F.col("is_error").cast("double")).alias("error_rate"),
    )
    return grouped if k is None else top_routes(grouped, k)


def top_routes(routes: DataFrame, k: int = 100) -> DataFrame:
    return routes.orderBy(F.desc("request_count"), "service_name", "http_route", "http_method").limit(k)


def route_table(routes: DataFrame) -> DataFrame:
    """Routes for display, with "/" and "GET" for missing route and method."""
    return routes.select(
        "service_name",
        C.or_default(F.col("http_route"), "/").alias("http_route"),
        C.or_default(F.col("http_method"), "GET").alias("http_method"),
        "request_count", "avg_duration_ms", "error_rate",
    )


def route_latency(routes: DataFrame) -> DataFrame:
    return routes.select("service_name", C.or_default(F.col("http_route"), "/").alias("http_route"), "avg_duration_ms")


def health_kpis(series: DataFrame) -> DataFrame:
    return series.agg(
        F.sum("total_requests").alias("total_requests"),
        F.countDistinct("service_name").alias("service_count"),
        F.avg("total_requests").alias("avg_requests"),
        F.avg("error_rate").alias("avg_error_rate"),
    )


def rate_series(series: DataFrame) -> DataFrame:
    return series.select("service_name", "timestamp", "total_requests")


def p95_series(series: DataFrame) -> DataFrame:
    return series.select("service_name", "timestamp", "p95_latency_ms")


def share_by(df: DataFrame, column: Column, name: str, count: str) -> DataFrame:
    """Sum and share of the total per value.

    The total is a scalar subquery over the sums, whose shuffle Spark uses
    again, so a high-cardinality column is not gathered into one task.
    """
    summed = df.groupBy(column.alias(name)).agg(F.sum(count).alias(count))
    total = summed.agg(F.sum(count)).scalar()
    return summed.withColumn("share", F.try_divide(F.col(count), total))


RESOLUTIONS = {"1min": "1 minute", "5min": "5 minutes", "1hour": "1 hour"}


def multi_resolution(
    r1: DataFrame, service: str | None = None, as_of: Column | None = None, hours: tuple[int, int, int] = (2, 6, 24),
) -> DataFrame:
    """The rollups of a service as one labelled series, each over its own lookback, from one scan of the finest."""
    r1 = r1 if service is None else r1.filter(F.col("service_name") == service)
    every = resolutions(r1, RESOLUTIONS, dict(zip(RESOLUTIONS, hours)), as_of)
    return every.select(
        "rollup_window", F.col("window_start").alias("timestamp"), "name", "service_name", "metric_type",
        "avg_value", "min_value", "max_value", "sample_count",
    )


def union_labelled(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL with the name of the branch as a column."""
    tagged = [df.select(F.lit(name).alias(label), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def metric_names(rollup: DataFrame, service: str | None = None) -> DataFrame:
    rows = rollup if service is None else rollup.filter(F.col("service_name") == service)
    return rows.select("name").distinct().orderBy("name")


def metric_totals(combined: DataFrame) -> DataFrame:
    return combined.agg(
        F.countDistinct("name").alias("count_metrics"), F.sum("sample_count").alias("sum_samples")
    )


def metric_table(combined: DataFrame) -> DataFrame:
    """Summary per metric; the type shown is the first in name order."""
    return combined.groupBy("name").agg(
        F.min("metric_type").alias("metric_type"),
        F.avg("avg_value").alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("sample_count").alias("total_samples"),
    )


def stats_long(combined: DataFrame) -> DataFrame:
    """avg, min and max as rows instead of columns."""
    wide = combined.select(
        "timestamp", "name", F.col("avg_value").alias("avg"), F.col("min_value").alias("min"),
        F.col("max_value").alias("max"),
    )
    return wide.unpivot(["timestamp", "name"], ["avg", "min", "max"], "value_type", "value")


def status_grid(
    health: DataFrame, hours: int | None = 1, as_of: Column | None = None, with_latency: bool = False
) -> DataFrame:
    """Recent health rows with their traffic-light status, worst first."""
    recent = lookback(health, "timestamp", f"{hours} HOURS" if hours is not None else None, as_of)
    status = C.health_status(F.col("error_rate"), F.col("latency_p95_ms") if with_latency else None)
    return recent.select(
        "service_name", "timestamp", "request_count", "error_rate", "latency_p95_ms", status.alias("status")
    ).orderBy(F.desc("error_rate"), "service_name", "timestamp")


def current_health(health: DataFrame, minutes: int | None = 10, as_of: Column | None = None) -> DataFrame:
    recent = lookback(health, "timestamp", f"{minutes} MINUTES" if minutes is not None else None, as_of)
    return (
        recent.groupBy("service_name")
        .agg(
            F.avg("error_rate").alias("avg_error_rate"),
            F.avg("latency_p95_ms").alias("avg_p95_latency"),
            F.sum("request_count").alias("total_requests"),
        )
        .orderBy(F.desc("avg_error_rate"), "service_name")
    )


def trace_lookup(traces: DataFrame, trace_id: str) -> DataFrame:
    """The row (or parts) of one assembled trace."""
    return traces.filter(F.col("trace_id") == trace_id)


def latest_results(
    results: DataFrame, k: int = 10, ts: str = "validation_timestamp", ties: tuple[str, ...] = ()
) -> DataFrame:
    """The ``k`` newest rows; ``ties`` orders those of one time. Without it, all columns that can be ordered do."""
    ordered = ties or tuple(f.name for f in results.schema.fields if f.name != ts and "map<" not in f.dataType.simpleString())
    return results.orderBy(F.desc(ts), *[F.col(f"`{c}`") for c in ordered]).limit(k)


def sample(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def distinct_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def table_freshness(tables: dict[str, tuple[DataFrame, str]], as_of: Column | None = None) -> DataFrame:
    """Latest record of each table and its age in minutes."""
    latest = {name: df.agg(F.max(ts).alias("latest_record")) for name, (df, ts) in tables.items()}
    age = F.timestamp_diff("MINUTE", F.col("latest_record"), C.now(as_of))
    return union_labelled(latest, "table_name").withColumn("minutes_ago", age)


def pipeline_status(
    tables: dict[str, tuple[DataFrame, str]], as_of: Column | None = None, max_age: int = 10,
    layer: str = "silver",
) -> DataFrame:
    """Number of tables and of those with a record younger than ``max_age`` minutes."""
    return table_freshness(tables, as_of).agg(
        F.lit(layer).alias("layer"),
        F.count("*").alias("table_count"),
        F.count_if(F.col("minutes_ago") < max_age).alias("healthy_count"),
    )
