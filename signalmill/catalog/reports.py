"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import serving as S
from . import adapters as A
from .book import cte, query
from .health import h1, hourly_simple
from .metrics import SERIES, rollup1

cte(
    "series",
    """SELECT hour AS "timestamp", service_name, avg_error_rate AS error_rate, avg_p95_latency_ms AS p95_latency_ms,
       max_p95_latency_ms AS p99_latency_ms, total_requests FROM hourly_simple""",
    ("hourly_simple",),
)
SERIES_COLUMNS = """"timestamp", service_name, round(error_rate, 6) AS error_rate, round(p95_latency_ms, 6) AS p95_latency_ms,
       round(p99_latency_ms, 6) AS p99_latency_ms, total_requests"""


def series(spark, d):
    return S.health_points(hourly_simple(spark, d), None)


@query(
    "health_series",
    f"""SELECT {SERIES_COLUMNS} FROM series WHERE "timestamp" >= {A.AS_OF_SQL} - INTERVAL 12 HOUR""",
    uses=("series",),
)
def _(spark, d):
    return S.health_series(hourly_simple(spark, d), 12, A.as_of())


@query("health_series_all", f"SELECT {SERIES_COLUMNS} FROM series", uses=("series",))
def _(spark, d):
    return series(spark, d)


@query(
    "health_kpis",
    """SELECT CAST(sum(total_requests) AS BIGINT) AS total_requests, count(DISTINCT service_name) AS service_count,
       round(avg(total_requests), 6) AS avg_requests, round(avg(error_rate), 6) AS avg_error_rate FROM series""",
    uses=("series",),
)
def _(spark, d):
    return S.health_kpis(series(spark, d))


@query("rate_series", 'SELECT service_name, "timestamp", total_requests FROM series', uses=("series",))
def _(spark, d):
    return S.rate_series(series(spark, d))


@query("p95_series", 'SELECT service_name, "timestamp", round(p95_latency_ms, 6) AS p95_latency_ms FROM series', uses=("series",))
def _(spark, d):
    return S.p95_series(series(spark, d))


cte(
    "routes",
    """SELECT service_name, http_route, http_method, count(*) AS request_count, avg(duration_ms) AS avg_duration_ms,
       avg(CASE WHEN is_error THEN 1.0 ELSE 0.0 END) AS error_rate FROM spans GROUP BY 1, 2, 3""",
    ("spans",),
)
ROUTE_COLUMNS = """service_name, http_route, http_method, request_count, round(avg_duration_ms, 6) AS avg_duration_ms,
       round(error_rate, 6) AS error_rate"""


def routes(spark, d):
    return S.route_summary(A.spans(spark, d), None, None)


@query("route_summary", f"SELECT {ROUTE_COLUMNS} FROM routes", uses=("routes",))
def _(spark, d):
    return routes(spark, d)


@query(
    "top_routes",
    f"""SELECT {ROUTE_COLUMNS} FROM (SELECT * FROM routes ORDER BY request_count DESC, service_name NULLS FIRST,
       http_route NULLS FIRST, http_method NULLS FIRST LIMIT 100)""",
    uses=("routes",),
)
def _(spark, d):
    return S.route_summary(A.spans(spark, d), None, 100)


@query(
    "route_summary_recent",
    f"""SELECT service_name, http_route, http_method, count(*) AS request_count, round(avg(duration_ms), 6) AS avg_duration_ms,
       round(avg(CASE WHEN is_error THEN 1.0 ELSE 0.0 END), 6) AS error_rate
    FROM spans WHERE start_timestamp >= {A.AS_OF_SQL} - INTERVAL 12 HOUR GROUP BY 1, 2, 3
    ORDER BY 4 DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 100""",
    uses=("spans",),
)
def _(spark, d):
    return S.route_summary(A.spans(spark, d), 12, 100, A.as_of())


@query(
    "route_table",
    """SELECT service_name, coalesce(http_route, '/') AS http_route, coalesce(http_method, 'GET') AS http_method,
       request_count, round(avg_duration_ms, 6) AS avg_duration_ms, round(error_rate, 6) AS error_rate FROM routes""",
    uses=("routes",),
)
def _(spark, d):
    return S.route_table(routes(spark, d))


@query(
    "route_latency",
    "SELECT service_name, coalesce(http_route, '/') AS http_route, round(avg_duration_ms, 6) AS avg_duration_ms FROM routes",
    uses=("routes",),
)
def _(spark, d):
    return S.route_latency(routes(spark, d))


@query(
    "share_by_service",
    """SELECT service_name, CAST(sum(total_requests) AS BIGINT) AS total_requests,
       round(sum(total_requests) / (SELECT sum(total_requests) FROM series), 6) AS share FROM series GROUP BY 1""",
    uses=("series",),
)
def _(spark, d):
    return S.share_by(series(spark, d), F.col("service_name"), "service_name", "total_requests")


@query(
    "share_by_route",
    """SELECT coalesce(http_route, '/') AS http_route, CAST(sum(request_count) AS BIGINT) AS request_count,
       round(sum(request_count) / (SELECT sum(request_count) FROM routes), 6) AS share FROM routes GROUP BY 1""",
    uses=("routes",),
)
def _(spark, d):
    return S.share_by(routes(spark, d), C.or_default(F.col("http_route"), "/"), "http_route", "request_count")


cte(
    "combined",
    f"""SELECT '1min' AS rollup_window, window_start AS "timestamp", {SERIES}, avg_value, min_value, max_value, sample_count FROM rollup1
    UNION ALL SELECT '5min', window_start, {SERIES}, avg_value, min_value, max_value, sample_count FROM rollup5
    UNION ALL SELECT '1hour', window_start, {SERIES}, avg_value, min_value, max_value, sample_count FROM rollup60""",
    ("rollup1", "rollup5", "rollup60"),
)


def combined(spark, d, service=None, as_of=None, hours=(9000, 9000, 9000)):
    return S.multi_resolution(rollup1(spark, d), service, A.as_of() if as_of is None else as_of, hours)


# Inside the time range of the metrics at every scale.
ROLLUP_AS_OF = "2024-01-01 06:00:00"


@query(
    "multi_resolution",
    f"""SELECT rollup_window, "timestamp", {SERIES}, round(avg_value, 6) AS avg_value, round(min_value, 6) AS min_value,
       round(max_value, 6) AS max_value, sample_count FROM combined
    WHERE service_name = 'svc-3' AND "timestamp" >= TIMESTAMP '{ROLLUP_AS_OF}' -
          CASE rollup_window WHEN '1min' THEN INTERVAL 2 HOUR WHEN '5min' THEN INTERVAL 6 HOUR ELSE INTERVAL 24 HOUR END""",
    uses=("combined",),
)
def _(spark, d):
    return combined(spark, d, "svc-3", F.lit(ROLLUP_AS_OF).cast("timestamp"), (2, 6, 24))


@query("metric_names", "SELECT DISTINCT name FROM rollup1 WHERE service_name = 'svc-3'", uses=("rollup1",))
def _(spark, d):
    return S.metric_names(rollup1(spark, d), "svc-3")


@query(
    "metric_totals",
    "SELECT count(DISTINCT name) AS count_metrics, CAST(sum(sample_count) AS BIGINT) AS sum_samples FROM combined",
    uses=("combined",),
)
def _(spark, d):
    return S.metric_totals(combined(spark, d))


@query(
    "metric_table",
    """SELECT name, min(metric_type) AS metric_type, round(avg(avg_value), 6) AS avg_value, round(min(min_value), 6) AS min_value,
       round(max(max_value), 6) AS max_value, CAST(sum(sample_count) AS BIGINT) AS total_samples FROM combined GROUP BY 1""",
    uses=("combined",),
)
def _(spark, d):
    return S.metric_table(combined(spark, d))


@query(
    "stats_long",
    """SELECT "timestamp", name, 'avg' AS value_type, round(avg_value, 6) AS value FROM combined
    UNION ALL SELECT "timestamp", name, 'min', round(min_value, 6) FROM combined
    UNION ALL SELECT "timestamp", name, 'max', round(max_value, 6) FROM combined""",
    uses=("combined",),
)
def _(spark, d):
    return S.stats_long(combined(spark, d))


GRID = """SELECT service_name, "timestamp", request_count, round(error_rate, 6) AS error_rate, round(latency_p95_ms, 6) AS latency_p95_ms,
       CASE WHEN error_rate > 0.05 THEN 'critical' WHEN error_rate > 0.01{slow} THEN 'warning' ELSE 'healthy' END AS status FROM h1"""


@query("status_grid", GRID.format(slow=""), uses=("h1",))
def _(spark, d):
    return S.status_grid(h1(spark, d), None)


@query("health_status", GRID.format(slow=" OR latency_p95_ms > 500"), uses=("h1",))
def _(spark, d):
    return S.status_grid(h1(spark, d), None, with_latency=True)


@query(
    "current_health",
    f"""SELECT service_name, round(avg(error_rate), 6) AS avg_error_rate, round(avg(latency_p95_ms), 6) AS avg_p95_latency,
       CAST(sum(request_count) AS BIGINT) AS total_requests FROM h1
    WHERE "timestamp" >= {A.AS_OF_SQL} - INTERVAL 60 MINUTE GROUP BY 1""",
    uses=("h1",),
)
def _(spark, d):
    return S.current_health(h1(spark, d), 60, A.as_of())


@query(
    "latest_results",
    """SELECT trace_id, span_id, log_timestamp, severity_text FROM logs ORDER BY log_timestamp DESC, trace_id NULLS FIRST, span_id NULLS FIRST, severity_text NULLS FIRST LIMIT 10""",
    uses=("logs",),
)
def _(spark, d):
    rows = A.logs(spark, d).select("trace_id", "span_id", "log_timestamp", "severity_text")
    return S.latest_results(rows, 10, "log_timestamp")


TABLES_SQL = """SELECT 'traces_silver' AS table_name, max(start_timestamp) AS latest_record FROM spans
    UNION ALL SELECT 'logs_silver', max(log_timestamp) FROM logs
    UNION ALL SELECT 'service_health_silver', max("timestamp") FROM h1"""
cte("latest", TABLES_SQL, ("spans", "logs", "h1"))


def tables(spark, d):
    return {
        "traces_silver": (A.spans(spark, d), "start_timestamp"),
        "logs_silver": (A.logs(spark, d), "log_timestamp"),
        "service_health_silver": (h1(spark, d), "timestamp"),
    }


# Whole minutes elapsed, as the engine counts them; crossing counts differ.
@query(
    "table_freshness",
    f"""SELECT table_name, latest_record, CAST(floor((epoch_us({A.AS_OF_SQL}) - epoch_us(latest_record)) / 60000000) AS BIGINT) AS minutes_ago FROM latest""",
    uses=("latest",),
)
def _(spark, d):
    return S.table_freshness(tables(spark, d), A.as_of())


@query(
    "pipeline_status",
    f"""SELECT 'silver' AS layer, count(*) AS table_count,
       count(*) FILTER (floor((epoch_us({A.AS_OF_SQL}) - epoch_us(latest_record)) / 60000000) < 10) AS healthy_count FROM latest""",
    uses=("latest",),
)
def _(spark, d):
    return S.pipeline_status(tables(spark, d), A.as_of())


@query(
    "union_labelled",
    """SELECT 'spans' AS signal, count(*) AS n FROM spans UNION ALL SELECT 'logs', count(*) FROM logs
    UNION ALL SELECT 'metrics', count(*) FROM metrics""",
    uses=("spans", "logs", "metrics"),
)
def _(spark, d):
    frames = {"spans": A.spans(spark, d), "logs": A.logs(spark, d), "metrics": A.metrics(spark, d)}
    return S.union_labelled({n: f.agg(F.count("*").alias("n")) for n, f in frames.items()}, "signal")
