"""Data-quality checks. Every verdict is one row, computed in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import of_type, out_of_range
from ..schemas import DISTRIBUTION_TYPES, NUMBER_TYPES
from .traces import orphan_spans

# Lowest passing percentage of each check (fixed values).
COMPLETENESS_PASS = 95
CORRELATION_PASS = 80
HEALTH_PASS = 99


def _verdict(rate: Column, limit: int, otherwise: str) -> Column:
    return F.when(rate >= limit, "PASS").otherwise(otherwise)


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def validate_trace_completeness(spans: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Share of spans whose parent is known, with root counts.

    Spans and orphans are counted as labelled partial sums that one final
    aggregate puts together.
    """
    zero = F.lit(0).cast("bigint")
    root = F.col("parent_span_id").isNull()
    totals = spans.agg(
        F.count("*").alias("total"),
        F.count_if(root).alias("roots"),
        F.countDistinct(F.when(root, F.col("trace_id"))).alias("root_traces"),
        zero.alias("orphans"),
    )
    orphans = orphan_spans(spans).agg(
        zero.alias("total"), zero.alias("roots"), zero.alias("root_traces"), F.count("*").alias("orphans")
    )
    summed = totals.unionByName(orphans).agg(
        *[F.sum(n).alias(n) for n in ("total", "roots", "root_traces", "orphans")]
    )
    rate = _percent(F.col("total") - F.col("orphans"), F.col("total"))
    return summed.select(
        F.col("total").alias("total_spans"),
        F.col("orphans").alias("orphaned_spans"),
        rate.alias("completeness_rate"),
        F.col("roots").alias("traces_with_roots"),
        F.col("root_traces").alias("distinct_root_traces"),
        _verdict(rate, COMPLETENESS_PASS, "FAIL").alias("status"),
        C.now(as_of).alias("validation_timestamp"),
    )


def validate_cross_signal(spans: DataFrame, logs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Share of traces that have log records. Records without a trace id are not a trace.

    Both sides are reduced to distinct ids, and the join re-uses those shuffles.
    """
    traces = spans.filter(F.col("trace_id").isNotNull()).select("trace_id").distinct()
    logged = (
        logs.filter(F.col("trace_id").isNotNull()).select("trace_id").distinct().withColumn("_logged", F.lit(True))
    )
    counts = traces.join(logged, "trace_id", "left").agg(
        F.count("*").alias("total_traces"), F.count("_logged").alias("traces_with_logs")
    )
    rate = _percent(F.col("traces_with_logs"), F.col("total_traces"))
    return counts.withColumns(
        {
            "correlation_rate": rate,
            "status": _verdict(rate, CORRELATION_PASS, "WARN"),
            "validation_timestamp": C.now(as_of),
        }
    )


def validate_service_health(
    health: DataFrame,
    latency: str = "latency_p95_ms",
    count: str = "request_count",
    as_of: Column | None = None,
) -> DataFrame:
    """NULL counts, impossible values and the share of rows free of the latter."""
    counts = health.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("service_name").isNull()).alias("null_service_names"),
        F.count_if(F.col("error_rate").isNull()).alias("null_error_rates"),
        F.count_if(F.col(latency).isNull()).alias("null_latencies"),
        F.count_if(F.col(count).isNull()).alias("null_request_counts"),
        F.count_if(out_of_range(latency, count)).alias("invalid_ranges"),
    )
    score = _percent(F.col("total_records") - F.col("invalid_ranges"), F.col("total_records"))
    return counts.withColumns(
        {
            "data_quality_score": score,
            "status": _verdict(score, HEALTH_PASS, "FAIL"),
            "validation_timestamp": C.now(as_of),
        }
    )


# Expectations on the derived tables (fixed values): name -> predicate.
SPAN_EXPECTATIONS = {
    "valid_trace_id": "trace_id IS NOT NULL",
    "valid_timestamps": "start_timestamp <= end_timestamp",
    "valid_duration": "duration_ms >= 0",
}
LOG_EXPECTATIONS = {
    "valid_log_timestamp": "log_timestamp IS NOT NULL",
    "valid_severity": "try_cast(severity_number AS INT) BETWEEN 1 AND 24",
}
# Only gauges and sums have a value of their own.
METRIC_EXPECTATIONS = {
    "valid_metric_value": "value IS NOT NULL OR metric_type NOT IN ('gauge', 'sum')",
    "valid_metric_name": "name IS NOT NULL",
}
TRACE_EXPECTATIONS = {"valid_span_count": "span_count > 0"}
HEALTH_EXPECTATIONS = {
    "valid_service_name": "service_name IS NOT NULL",
    "valid_request_count": "request_count >= 0",
}


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect(
    df: DataFrame, predicates: dict[str, str], action: str = "warn", observation: str | None = None
) -> DataFrame:
    """Check rows against named predicates; a NULL outcome is a violation.

    warn keeps all rows, drop removes violating ones, fail stops the query at
    the first one. With ``observation``, violations per predicate are counted
    while the rows pass by and reach the query's listeners.
    """
    if observation is not None:
        failed = [F.count_if(~_holds(p)).alias(n) for n, p in predicates.items()]
        df = df.observe(observation, F.count("*").alias("rows"), *failed)
    if action == "warn":
        return df
    good = F.lit(True)
    for predicate in predicates.values():
        good = good & _holds(predicate)
    if action == "drop":
        return df.filter(good)
    if action == "fail":
        broken = F.concat_ws(", ", *[F.when(~_holds(p), F.lit(n)) for n, p in predicates.items()])
        stop = F.raise_error(F.concat(F.lit("expectation violated: "), broken)).cast("boolean")
        return df.filter(F.when(good, F.lit(True)).otherwise(stop))
    raise ValueError(f"unknown action {action!r}")


def expectation_report(df: DataFrame, predicates: dict[str, str]) -> DataFrame:
    """One row per expectation with passed and failed counts."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(_holds(p)).alias(n) for n, p in predicates.items()])
    entries = [F.struct(F.lit(n).alias("expectation"), F.col(n).alias("passed")) for n in predicates]
    return counts.select("total", F.explode(F.array(*entries)).alias("e")).select(
        "e.expectation", "e.passed", (F.col("total") - F.col("e.passed")).alias("failed")
    )


def null_profile(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """Row count and NULLs per column, overall or per group."""
    counts = [F.count("*").alias("total_count")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in columns]
    return df.groupBy(by).agg(*counts) if by else df.agg(*counts)


def zero_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows in which a divisor is zero or missing."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(column) == 0).alias("zero_count"),
        F.count_if(F.col(column).isNull()).alias("null_count"),
    )


def counts_by_type(metrics: DataFrame, ts: str = "metric_timestamp") -> DataFrame:
    return metrics.groupBy("metric_type").agg(
        F.count("*").alias("count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")
    )


def completeness_by_type(raw: DataFrame, flat: DataFrame) -> DataFrame:
    """Points per type before and after flattening, and the share that arrived."""
    before = raw.groupBy("metric_type").agg(F.count("*").alias("raw_count"))
    after = flat.groupBy(F.col("metric_type").alias("_type")).agg(F.count("*").alias("flat_count"))
    return before.join(after, F.col("metric_type").eqNullSafe(F.col("_type")), "left").select(
        "metric_type",
        "raw_count",
        F.coalesce("flat_count", F.lit(0)).alias("flat_count"),
        F.round(F.coalesce("flat_count", F.lit(0)) * 100.0 / F.col("raw_count"), 2).alias("completeness_pct"),
    )


def histogram_integrity(metrics: DataFrame) -> DataFrame:
    """A histogram needs one bucket more than it has bounds."""
    sizes = of_type(metrics, "histogram").filter(
        F.col("histogram_buckets").isNotNull() & F.col("histogram_bounds").isNotNull()
    )
    ok = F.size("histogram_buckets") == F.size("histogram_bounds") + 1
    return sizes.select(
        "name", "service_name", "metric_timestamp",
        F.size("histogram_buckets").alias("buckets_size"),
        F.size("histogram_bounds").alias("bounds_size"),
        F.when(ok, "VALID").otherwise("INVALID").alias("integrity_status"),
    )


def rollup_sanity(rollup: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """min <= avg <= max for every rollup row with samples, but for the rounding of the mean (relative ``tolerance``)."""
    slack = F.greatest(F.abs("min_value"), F.abs("max_value")) * tolerance
    ok = (F.col("min_value") - slack <= F.col("avg_value")) & (F.col("avg_value") <= F.col("max_value") + slack)
    return rollup.filter("sample_count > 0").select(
        "name", "service_name", "metric_type", "window_start", "sample_count", "min_value", "avg_value",
        "max_value", "sum_value", F.when(ok, "VALID").otherwise("INVALID").alias("validation_status"),
    )


def parent_coverage(spans: DataFrame) -> DataFrame:
    with_parent = F.count("parent_span_id")
    return spans.agg(
        F.count("*").alias("total_spans"),
        with_parent.alias("spans_with_parent"),
        F.count_if(F.col("parent_span_id").isNull()).alias("root_spans"),
        F.round(F.try_divide(with_parent * F.lit(100.0), F.count("*")), 2).alias("pct_with_parent"),
    )


def ingest_lag(
    df: DataFrame,
    ts: str,
    ingest: str,
    by: list[str],
    quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
    approx: bool = False,
) -> DataFrame:
    """Percentiles of the arrival delay in seconds per group.

    Exact ones are taken over (delay, frequency) pairs: rows with the same
    whole-second delay are counted before the percentile sees them.
    """
    lag = C.lag_seconds(F.col(ts), F.col(ingest))
    names = [f"p{round(q * 100)}_lag_seconds" for q in quantiles]
    if approx:
        sketch = df.groupBy(*by).agg(
            F.count("*").alias("sample_count"), F.percentile_approx(lag, list(quantiles)).alias("_q")
        )
    else:
        per_delay = df.groupBy(*by, lag.alias("_lag")).agg(F.count("*").alias("_n"))
        sketch = per_delay.groupBy(*by).agg(
            F.sum("_n").alias("sample_count"), F.percentile("_lag", list(quantiles), F.col("_n")).alias("_q")
        )
    picked = [F.round(F.get("_q", i), 2).alias(n) for i, n in enumerate(names)]
    return sketch.select(*by, "sample_count", *picked)


def freshness(df: DataFrame, ts: str, ingest: str | None = None, by: str | None = None,
              as_of: Column | None = None) -> DataFrame:
    """Row count, first and last event, minutes since the last, and arrival lag if stored."""
    stats = [F.count("*").alias("row_count"), F.min(ts).alias("earliest"), F.max(ts).alias("latest")]
    if ingest:
        stats.append(F.max(ingest).alias("latest_ingestion"))
    out = df.groupBy(by).agg(*stats) if by else df.agg(*stats)
    minutes = {"minutes_since_last": F.round(C.lag_seconds(F.col("latest"), C.now(as_of)) / 60, 2)}
    if ingest:
        minutes["lag_minutes"] = F.round(C.lag_seconds(F.col("latest"), F.col("latest_ingestion")) / 60, 2)
    return out.withColumns(minutes)


def rollup_progress(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.max("window_start").alias("latest_window"),
        F.countDistinct("name").alias("unique_metrics"),
        F.countDistinct("service_name").alias("unique_services"),
    )


def metric_type_coverage(rollup: DataFrame, histogram_rollup: DataFrame) -> DataFrame:
    """Metrics, services and samples of the two rollups side by side."""
    def one(df: DataFrame, label: str, samples: str) -> DataFrame:
        return df.agg(
            F.countDistinct("name").alias("unique_metrics"),
            F.countDistinct("service_name").alias("unique_services"),
            F.sum(samples).alias("total_samples"),
        ).select(F.lit(label).alias("rollup_type"), "*")

    return one(rollup, "numbers", "sample_count").unionByName(
        one(histogram_rollup, "distributions", "total_count")
    )


def coverage_report(raw: DataFrame, flat: DataFrame) -> DataFrame:
    """Metric names covered by number types alone against those in the flat table."""
    kind = F.col("metric_type")
    # One row per name first: several distinct counts over the raw rows would multiply them.
    by_name = raw.groupBy("name").agg(
        F.max(kind.isin(*NUMBER_TYPES)).alias("number"), F.max(kind.isin(*DISTRIBUTION_TYPES)).alias("other")
    )
    counts = by_name.agg(F.count_if("number").alias("a"), F.count_if("other").alias("b"), F.count("name").alias("c"))
    before = counts.select(
        F.lit("numbers only").alias("coverage"),
        F.col("a").alias("processed_metrics"),
        F.col("b").alias("dropped_metrics"),
        F.round(F.try_divide(F.col("a") * F.lit(100.0), F.col("c")), 2).alias("coverage_pct"),
    )
    after = flat.agg(F.countDistinct("name").alias("a")).select(
        F.lit("all types").alias("coverage"),
        F.col("a").alias("processed_metrics"),
        F.lit(0).cast("bigint").alias("dropped_metrics"),
        F.lit(100.0).alias("coverage_pct"),
    )
    return before.unionByName(after)


def distinct_profile(spans: DataFrame) -> DataFrame:
    # One row per service and trace first: two distinct counts over the spans would double them.
    pairs = spans.groupBy("service_name", "trace_id").agg(
        F.count("*").alias("n"), F.min("start_timestamp").alias("lo"), F.max("start_timestamp").alias("hi")
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_spans"),
        F.min("lo").alias("earliest_span"),
        F.max("hi").alias("latest_span"),
        F.countDistinct("service_name").alias("unique_services"),
        F.countDistinct("trace_id").alias("unique_traces"),
    )


def row_bytes(df: DataFrame) -> DataFrame:
    """Row count and approximate bytes of a table, by the length of its rows as JSON."""
    return df.agg(
        F.count("*").alias("state_rows"),
        F.sum(F.length(F.to_json(F.struct(*df.columns)))).alias("approx_state_bytes"),
    )


def profile_table(df: DataFrame, ts: str | None = None, columns: int | None = None) -> DataFrame:
    """Row count, latest time and NULLs of all columns, or of the first ones on request."""
    stats = [F.count("*").alias("row_count")]
    if ts:
        stats.append(F.max(ts).alias("latest_record"))
    stats += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls") for c in df.columns[:columns]]
    return df.agg(*stats)
