"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from . import adapters as A
from .book import query
from .health import h5
from .metrics import SERIES, distributions, rollup1


@query(
    "validate_trace_completeness",
    """SELECT total_spans, orphaned_spans, round((total_spans - orphaned_spans) / total_spans * 100, 6) AS completeness_rate,
       traces_with_roots, distinct_root_traces,
       CASE WHEN (total_spans - orphaned_spans) / total_spans * 100 >= 95 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) AS total_spans, (SELECT count(*) FROM orphans) AS orphaned_spans,
          count(*) FILTER (parent_span_id IS NULL) AS traces_with_roots,
          count(DISTINCT CASE WHEN parent_span_id IS NULL THEN trace_id END) AS distinct_root_traces FROM spans)""",
    uses=("spans", "orphans"),
)
def _(spark, d):
    return Q.validate_trace_completeness(A.spans(spark, d))


@query(
    "validate_cross_signal",
    """SELECT total_traces, traces_with_logs, round(traces_with_logs / total_traces * 100, 6) AS correlation_rate,
       CASE WHEN traces_with_logs / total_traces * 100 >= 80 THEN 'PASS' ELSE 'WARN' END AS status
    FROM (SELECT count(DISTINCT trace_id) AS total_traces,
          count(DISTINCT CASE WHEN trace_id IN (SELECT trace_id FROM logs WHERE trace_id IS NOT NULL) THEN trace_id END) AS traces_with_logs
          FROM spans)""",
    uses=("spans", "logs"),
)
def _(spark, d):
    return Q.validate_cross_signal(A.spans(spark, d), A.logs(spark, d))


@query(
    "validate_service_health",
    """SELECT total_records, null_service_names, CAST(0 AS BIGINT) AS null_error_rates, CAST(0 AS BIGINT) AS null_latencies,
       CAST(0 AS BIGINT) AS null_request_counts, invalid_ranges,
       round((total_records - invalid_ranges) / total_records * 100, 6) AS data_quality_score,
       CASE WHEN (total_records - invalid_ranges) / total_records * 100 >= 99 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) AS total_records, count(*) FILTER (service_name IS NULL) AS null_service_names,
          count(*) FILTER (p95_latency_ms - 1 < 0) AS invalid_ranges FROM h5)""",
    uses=("h5",),
)
def _(spark, d):
    shifted = h5(spark, d).withColumn("p95_latency_ms", F.col("p95_latency_ms") - 1)
    return Q.validate_service_health(shifted, "p95_latency_ms", "total_requests")


@query(
    "expect",
    """SELECT trace_id, span_id, log_timestamp, severity_number FROM logs
    WHERE log_timestamp IS NOT NULL AND TRY_CAST(severity_number AS INTEGER) BETWEEN 1 AND 24""",
    uses=("logs",),
)
def _(spark, d):
    kept = Q.expect(A.logs(spark, d), Q.LOG_EXPECTATIONS, "drop")
    return kept.select("trace_id", "span_id", "log_timestamp", "severity_number")


@query(
    "expectation_report",
    """SELECT 'valid_trace_id' AS expectation, count(trace_id) AS passed, count(*) - count(trace_id) AS failed FROM spans
    UNION ALL SELECT 'valid_timestamps', count(*) FILTER (start_timestamp <= end_timestamp),
       count(*) - count(*) FILTER (start_timestamp <= end_timestamp) FROM spans
    UNION ALL SELECT 'valid_duration', count(*) FILTER (duration_ms >= 0), count(*) - count(*) FILTER (duration_ms >= 0) FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    return Q.expectation_report(A.spans(spark, d), Q.SPAN_EXPECTATIONS)


@query(
    "expect_metrics",
    "SELECT metric_type, count(*) AS kept FROM metrics WHERE name IS NOT NULL GROUP BY 1",
    uses=("metrics",),
)
def _(spark, d):
    kept = Q.expect(A.metrics(spark, d), Q.METRIC_EXPECTATIONS, "fail")
    return kept.groupBy("metric_type").agg(F.count("*").alias("kept"))


@query(
    "null_profile",
    """SELECT metric_type, count(*) AS total_count, count(*) - count(name) AS null_name_count,
       count(*) - count(service_name) AS null_service_name_count,
       count(*) - count(metric_timestamp) AS null_metric_timestamp_count,
       count(*) - count(histogram_buckets) AS null_histogram_buckets_count FROM metrics GROUP BY 1""",
    uses=("metrics",),
)
def _(spark, d):
    names = ["name", "service_name", "metric_timestamp", "histogram_buckets"]
    return Q.null_profile(A.metrics(spark, d), names, "metric_type")


@query(
    "zero_profile",
    """SELECT count(*) AS total_rows, count(*) FILTER (exp_histogram_zero_count = 0) AS zero_count,
       count(*) FILTER (exp_histogram_zero_count IS NULL) AS null_count FROM metrics""",
    uses=("metrics",),
)
def _(spark, d):
    return Q.zero_profile(A.metrics(spark, d), "exp_histogram_zero_count")


@query(
    "counts_by_type",
    """SELECT metric_type, count(*) AS count, min(metric_timestamp) AS first_seen, max(metric_timestamp) AS last_seen
    FROM metrics GROUP BY 1""",
    uses=("metrics",),
)
def _(spark, d):
    return Q.counts_by_type(A.metrics(spark, d))


@query(
    "completeness_by_type",
    """SELECT r.metric_type, r.n AS raw_count, coalesce(f.n, 0) AS flat_count,
       round(coalesce(f.n, 0) * 100.0 / r.n, 2) AS completeness_pct
    FROM (SELECT metric_type, count(*) AS n FROM metrics GROUP BY 1) r
    LEFT JOIN (SELECT metric_type, count(*) AS n FROM metrics WHERE metric_type <> 'summary' AND l_tax > 0 GROUP BY 1) f USING (metric_type)""",
    uses=("metrics",),
)
def _(spark, d):
    # A lossy run: no summaries, and no points that came without delay.
    flat = A.metrics(spark, d).filter("metric_type <> 'summary' AND attributes['delay_s'] <> '0'")
    return Q.completeness_by_type(A.raw_metrics(spark, d), flat)


@query(
    "histogram_integrity",
    """SELECT name, service_name, metric_timestamp, CAST(len(histogram_buckets) AS BIGINT) AS buckets_size,
       CAST(len(histogram_bounds) AS BIGINT) AS bounds_size,
       CASE WHEN len(histogram_buckets) = len(histogram_bounds) + 1 THEN 'VALID' ELSE 'INVALID' END AS integrity_status
    FROM metrics WHERE metric_type = 'histogram' AND histogram_buckets IS NOT NULL""",
    uses=("metrics",),
)
def _(spark, d):
    return Q.histogram_integrity(A.metrics(spark, d))


@query(
    "rollup_sanity",
    f"""SELECT {SERIES}, window_start, sample_count, round(min_value, 6) AS min_value, round(avg_value, 6) AS avg_value,
       round(max_value, 6) AS max_value, round(sum_value, 6) AS sum_value,
       CASE WHEN min_value - greatest(abs(min_value), abs(max_value)) * 1e-9 <= avg_value
             AND avg_value <= max_value + greatest(abs(min_value), abs(max_value)) * 1e-9 THEN 'VALID' ELSE 'INVALID' END AS validation_status
    FROM rollup1""",
    uses=("rollup1",),
)
def _(spark, d):
    return Q.rollup_sanity(rollup1(spark, d))


@query(
    "parent_coverage",
    """SELECT count(*) AS total_spans, count(parent_span_id) AS spans_with_parent,
       count(*) - count(parent_span_id) AS root_spans, round(count(parent_span_id) * 100.0 / count(*), 2) AS pct_with_parent FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    return Q.parent_coverage(A.spans(spark, d))


LAG = """count(*) AS sample_count, round(quantile_cont(delay_s, 0.5), 2) AS p50_lag_seconds,
       round(quantile_cont(delay_s, 0.95), 2) AS p95_lag_seconds, round(quantile_cont(delay_s, 0.99), 2) AS p99_lag_seconds"""


@query("ingest_lag", f"SELECT metric_type, {LAG} FROM metrics GROUP BY 1", uses=("metrics",))
def _(spark, d):
    return Q.ingest_lag(A.metrics_with_arrival(spark, d), "metric_timestamp", "ingestion_timestamp", ["metric_type"])


@query("ingest_lag_by_name", f"SELECT name, metric_type, {LAG} FROM metrics GROUP BY 1, 2", uses=("metrics",))
def _(spark, d):
    points = A.metrics_with_arrival(spark, d)
    return Q.ingest_lag(points, "metric_timestamp", "ingestion_timestamp", ["name", "metric_type"])


@query(
    "ingest_lag_approx",
    """SELECT metric_type, count(*) AS sample_count, quantile_disc(delay_s, 0.5)::BIGINT AS p50_lag_seconds,
       quantile_disc(delay_s, 0.95)::BIGINT AS p95_lag_seconds, quantile_disc(delay_s, 0.99)::BIGINT AS p99_lag_seconds
    FROM metrics GROUP BY 1""",
    uses=("metrics",),
)
def _(spark, d):
    points = A.metrics_with_arrival(spark, d)
    return Q.ingest_lag(points, "metric_timestamp", "ingestion_timestamp", ["metric_type"], approx=True)


@query(
    "freshness",
    f"""SELECT metric_type, count(*) AS row_count, min(metric_timestamp) AS earliest, max(metric_timestamp) AS latest,
       max(ingestion_timestamp) AS latest_ingestion,
       round((epoch({A.AS_OF_SQL}) - epoch(max(metric_timestamp))) / 60, 2) AS minutes_since_last,
       round((epoch(max(ingestion_timestamp)) - epoch(max(metric_timestamp))) / 60, 2) AS lag_minutes
    FROM metrics GROUP BY 1""",
    uses=("metrics",),
)
def _(spark, d):
    points = A.metrics_with_arrival(spark, d)
    return Q.freshness(points, "metric_timestamp", "ingestion_timestamp", "metric_type", A.as_of())


@query(
    "rollup_progress",
    """SELECT max(window_start) AS latest_window, count(DISTINCT name) AS unique_metrics,
       count(DISTINCT service_name) AS unique_services FROM rollup1""",
    uses=("rollup1",),
)
def _(spark, d):
    return Q.rollup_progress(rollup1(spark, d))


@query(
    "metric_type_coverage",
    """SELECT 'numbers' AS rollup_type, count(DISTINCT name) AS unique_metrics, count(DISTINCT service_name) AS unique_services,
       CAST(sum(sample_count) AS BIGINT) AS total_samples FROM rollup1
    UNION ALL SELECT 'distributions', count(DISTINCT name), count(DISTINCT service_name), CAST(sum(total_count) AS BIGINT) FROM distributions""",
    uses=("rollup1", "distributions"),
)
def _(spark, d):
    return Q.metric_type_coverage(rollup1(spark, d), distributions(spark, d))


@query(
    "coverage_report",
    """SELECT 'numbers only' AS coverage, count(DISTINCT CASE WHEN metric_type IN ('gauge', 'sum') THEN name END) AS processed_metrics,
       count(DISTINCT CASE WHEN metric_type NOT IN ('gauge', 'sum') THEN name END) AS dropped_metrics,
       round(count(DISTINCT CASE WHEN metric_type IN ('gauge', 'sum') THEN name END) * 100.0 / count(DISTINCT name), 2) AS coverage_pct FROM metrics
    UNION ALL SELECT 'all types', count(DISTINCT name), 0, 100.0 FROM metrics""",
    uses=("metrics",),
)
def _(spark, d):
    return Q.coverage_report(A.raw_metrics(spark, d), A.metrics(spark, d))


@query(
    "distinct_profile",
    """SELECT count(*) AS total_spans, min(start_timestamp) AS earliest_span, max(start_timestamp) AS latest_span,
       count(DISTINCT service_name) AS unique_services, count(DISTINCT trace_id) AS unique_traces FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    return Q.distinct_profile(A.spans(spark, d))


# JSON as Spark writes it: NULL fields are left out, quotes, backslashes and controls escaped.
@query(
    "row_bytes",
    """SELECT count(*) AS state_rows,
       CAST(sum(length('{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":"' || role || '"'
         || CASE WHEN text IS NULL THEN '' ELSE ',"text":' || to_json(text)::VARCHAR END || '}')) AS BIGINT) AS approx_state_bytes
    FROM conversations""",
)
def _(spark, d):
    return Q.row_bytes(A.table(spark, d, "conversations").select("conv_id", "turn", "role", "text"))


@query(
    "profile_table",
    """SELECT count(*) AS row_count, max(log_timestamp) AS latest_record, count(*) - count(event_name) AS event_name_nulls,
       count(*) - count(trace_id) AS trace_id_nulls, count(*) - count(span_id) AS span_id_nulls,
       CAST(0 AS BIGINT) AS log_timestamp_nulls, CAST(0 AS BIGINT) AS observed_timestamp_nulls,
       count(*) - count(severity_number) AS severity_number_nulls, count(*) - count(severity_text) AS severity_text_nulls,
       count(*) - count(body) AS body_nulls, count(*) - count(service_name) AS service_name_nulls,
       CAST(0 AS BIGINT) AS attributes_nulls, CAST(0 AS BIGINT) AS ingestion_timestamp_nulls FROM logs""",
    uses=("logs",),
)
def _(spark, d):
    return Q.profile_table(A.logs(spark, d).drop("log_key"), "log_timestamp")
