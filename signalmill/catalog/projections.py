"""Column helpers one by one, and the run-time reports of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..operators import metrics as M
from ..operators.health import service_health
from ..plans import build
from ..session import work_dir
from ..sources import SourceConfig, read_table
from ..streaming import progress, run_stream
from . import adapters as A
from .anomalies import base5
from .book import query
from .health import h5
from .streams import span_stream


@query("res_attr", "SELECT span_id, service_name, service_version FROM spans", uses=("spans",))
def _(spark, d):
    return A.raw_spans(spark, d).select(
        "span_id", C.res_attr("service.name").alias("service_name"), C.res_attr("service.version").alias("service_version")
    )


@query(
    "attr",
    """SELECT span_id, http_method, CAST(http_status_code AS BIGINT) AS http_status_code, CAST(NULL AS VARCHAR) AS missing FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    return A.raw_spans(spark, d).select(
        "span_id", C.attr("http.method").alias("http_method"),
        C.attr("http.status_code", "int").alias("http_status_code"), C.attr("no.such.key").alias("missing"),
    )


@query("field", "SELECT span_id, status_message, 'demo' AS scope FROM spans", uses=("spans",))
def _(spark, d):
    return A.raw_spans(spark, d).select(
        "span_id", C.field("status.message").alias("status_message"), C.field("instrumentation_scope.name").alias("scope")
    )


@query("is_error", "SELECT span_id, is_error, round(duration_ms, 6) AS duration_ms FROM spans", uses=("spans",))
def _(spark, d):
    return A.raw_spans(spark, d).select(
        "span_id", C.is_error(F.col("status.code")).alias("is_error"),
        C.duration_ms(F.col("start_time_unix_nano"), F.col("end_time_unix_nano")).alias("duration_ms"),
    )


@query("stamp", f"SELECT event_id, {A.AS_OF_SQL} AS seen_at FROM events")
def _(spark, d):
    return C.stamp(A.table(spark, d, "events").select("event_id"), "seen_at", A.as_of())


@query(
    "hist_mean",
    "SELECT metric_timestamp, round(l_extendedprice / nullif(q - 1, 0), 8) AS mean FROM metrics WHERE metric_type = 'histogram'",
    uses=("metrics",),
    digits={"mean": 8},
)
def _(spark, d):
    points = P.of_type(A.metrics(spark, d), "histogram")
    return points.select("metric_timestamp", C.hist_mean(F.col("histogram_sum"), F.col("histogram_count") - 1).alias("mean"))


@query(
    "unnest_window",
    """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    ts = F.col("ts").cast("timestamp")
    return C.unnest_window(A.table(spark, d, "events").groupBy(F.window(ts, "1 hour").alias("window")).agg(F.count("*").alias("n")))


@query(
    "floor_to",
    "SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) AS slot, time_bucket(INTERVAL '5 minutes', ts) AS tumbled FROM events",
)
def _(spark, d):
    ts = F.col("ts").cast("timestamp")
    return A.table(spark, d, "events").select(
        "event_id", C.floor_to(ts, "5 minutes").alias("slot"), C.tumble(ts, "5 minutes").alias("tumbled")
    )


@query(
    "or_default",
    "SELECT span_id, coalesce(http_route, '/') AS http_route, coalesce(http_method, 'GET') AS http_method FROM spans",
    uses=("spans",),
)
def _(spark, d):
    return A.raw_spans(spark, d).select(
        "span_id", C.or_default(C.attr("http.route"), "/").alias("http_route"),
        C.or_default(C.attr("http.method"), "GET").alias("http_method"),
    )


@query(
    "union_metrics",
    """SELECT metric_type, metric_timestamp, round(value, 6) AS value, histogram_count FROM metrics
    WHERE metric_type IN ('gauge', 'histogram')""",
    uses=("metrics",),
)
def _(spark, d):
    points = A.metrics(spark, d)
    gauges = P.of_type(points, "gauge").select("metric_type", "metric_timestamp", "value")
    histograms = P.of_type(points, "histogram").select("metric_type", "metric_timestamp", "histogram_count")
    return M.union_metrics(gauges, histograms)


@query(
    "breaches",
    """SELECT service_name, "timestamp", round(error_rate, 6) AS error_rate, round(p95_latency_ms, 6) AS p95_latency_ms FROM hits5""",
    uses=("hits5",),
)
def _(spark, d):
    joined = h5(spark, d).join(base5(spark, d).select("service_name", "error_rate_threshold", "latency_threshold"), "service_name")
    return P.breaches(joined).select("service_name", "timestamp", "error_rate", "p95_latency_ms")


# Counts of a run over the whole table; batches and state follow the run, so
# only the rows taken in are compared.
@query("progress", "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM events")
def _(spark, d):
    target = work_dir(spark, "progress")
    stream = service_health(span_stream(spark, d), "1 minute", "5 minutes")
    run = run_stream(stream, target, f"{target}-checkpoint")
    run.awaitTermination()
    seen = [(p["input_rows"], p["late_rows"]) for p in progress(run)]
    return spark.createDataFrame(seen, "input_rows bigint, late_rows bigint").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows")
    )


# The registered datasets, built from written raw logs through their stream.
@query("build", "SELECT DISTINCT trace_id, span_id, observed_timestamp, body FROM logs", uses=("logs",))
def _(spark, d):
    root = work_dir(spark, "lake")
    A.raw_logs(spark, d).write.parquet(f"{root}/otel_logs")
    build(spark, SourceConfig(root=root), ["logs_silver"])
    return read_table(spark, f"{root}/logs_silver").select("trace_id", "span_id", "observed_timestamp", "body")
