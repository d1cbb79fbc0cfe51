"""Golden-signal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..operators import health as H
from . import adapters as A
from .book import cte, query


def h1_sql(step: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{step}', start_timestamp) AS "timestamp",
       time_bucket(INTERVAL '{step}', start_timestamp) + INTERVAL '{step}' AS window_end, service_name,
       count(*) AS request_count, count(*) FILTER (is_error) AS error_count,
       count(*) FILTER (is_error) / count(*) AS error_rate,
       quantile_disc(duration_ms, 0.5) AS latency_p50_ms, quantile_disc(duration_ms, 0.95) AS latency_p95_ms,
       quantile_disc(duration_ms, 0.99) AS latency_p99_ms, avg(duration_ms) AS latency_avg_ms,
       max(duration_ms) AS latency_max_ms, min(duration_ms) AS latency_min_ms
    FROM spans WHERE service_name IS NOT NULL GROUP BY 1, 2, 3"""


cte("h1", h1_sql("1 minute"), ("spans",))
cte("h60", h1_sql("1 hour"), ("spans",))
cte(
    "h5",
    """SELECT time_bucket(INTERVAL '5 minutes', start_timestamp) AS "timestamp", service_name,
       count(*) FILTER (is_error) / count(*) AS error_rate,
       quantile_disc(duration_ms, 0.5) AS p50_latency_ms, quantile_disc(duration_ms, 0.95) AS p95_latency_ms,
       quantile_disc(duration_ms, 0.99) AS p99_latency_ms, count(*) AS total_requests,
       avg(duration_ms) AS avg_latency_ms, min(duration_ms) AS min_latency_ms, max(duration_ms) AS max_latency_ms
    FROM spans GROUP BY 1, 2""",
    ("spans",),
)
cte(
    "hourly",
    """SELECT service_name, date_trunc('hour', "timestamp") AS hour,
       sum(error_rate * total_requests) / sum(total_requests) AS error_rate, max(p95_latency_ms) AS p95_latency_ms,
       max(p99_latency_ms) AS p99_latency_ms, avg(avg_latency_ms) AS avg_latency_ms,
       CAST(sum(total_requests) AS BIGINT) AS total_requests FROM h5 GROUP BY 1, 2""",
    ("h5",),
)
cte(
    "hourly_simple",
    """SELECT service_name, date_trunc('hour', "timestamp") AS hour, avg(error_rate) AS avg_error_rate,
       max(error_rate) AS max_error_rate, avg(latency_p95_ms) AS avg_p95_latency_ms,
       max(latency_p95_ms) AS max_p95_latency_ms, CAST(sum(request_count) AS BIGINT) AS total_requests
    FROM h1 GROUP BY 1, 2""",
    ("h1",),
)

H1_COLUMNS = """"timestamp", window_end, service_name, request_count, {rps} AS requests_per_second, error_count,
       round(error_rate, 6) AS error_rate, round(latency_p50_ms, 6) AS latency_p50_ms,
       round(latency_p95_ms, 6) AS latency_p95_ms, round(latency_p99_ms, 6) AS latency_p99_ms,
       round(latency_avg_ms, 6) AS latency_avg_ms, round(latency_max_ms, 6) AS latency_max_ms,
       round(latency_min_ms, 6) AS latency_min_ms"""
RPS_SQL = "round(request_count / (epoch(window_end) - epoch(\"timestamp\")), 6)"
H5_COLUMNS = """"timestamp", service_name, round(error_rate, 6) AS error_rate,
       round(p50_latency_ms, 6) AS p50_latency_ms, round(p95_latency_ms, 6) AS p95_latency_ms,
       round(p99_latency_ms, 6) AS p99_latency_ms, total_requests, round(avg_latency_ms, 6) AS avg_latency_ms,
       round(min_latency_ms, 6) AS min_latency_ms, round(max_latency_ms, 6) AS max_latency_ms"""


def h1(spark, d):
    return H.service_health(A.spans(spark, d), "1 minute")


def h5(spark, d):
    return H.service_health_5min(A.spans(spark, d), "90 DAYS", A.as_of())


def hourly(spark, d):
    return H.service_health_hourly(h5(spark, d), "40 DAYS", A.as_of())


def hourly_simple(spark, d):
    return H.service_health_hourly_simple(h1(spark, d))


@query("service_health_5min", f"SELECT {H5_COLUMNS} FROM h5", uses=("h5",))
def _(spark, d):
    return h5(spark, d)


@query("service_health", f"SELECT {H1_COLUMNS.format(rps=RPS_SQL)} FROM h1", uses=("h1",))
def _(spark, d):
    return h1(spark, d)


@query("service_health_1h_window", f"SELECT {H1_COLUMNS.format(rps=RPS_SQL)} FROM h60", uses=("h60",))
def _(spark, d):
    return H.service_health(A.spans(spark, d), "1 hour")


@query(
    "service_health_hourly",
    """SELECT service_name, hour, round(error_rate, 6) AS error_rate, round(p95_latency_ms, 6) AS p95_latency_ms,
       round(p99_latency_ms, 6) AS p99_latency_ms, round(avg_latency_ms, 6) AS avg_latency_ms, total_requests FROM hourly""",
    uses=("hourly",),
)
def _(spark, d):
    return hourly(spark, d)


@query(
    "service_health_daily",
    """SELECT service_name, CAST(hour AS DATE) AS day, round(sum(error_rate * total_requests) / sum(total_requests), 6) AS error_rate,
       round(max(p95_latency_ms), 6) AS p95_latency_ms, round(max(p99_latency_ms), 6) AS p99_latency_ms,
       round(sum(avg_latency_ms * total_requests) / sum(total_requests), 6) AS avg_latency_ms,
       CAST(sum(total_requests) AS BIGINT) AS total_requests, count(*) AS hours FROM hourly GROUP BY 1, 2""",
    uses=("hourly",),
)
def _(spark, d):
    return H.service_health_daily(hourly(spark, d), "90 DAYS", A.as_of())


@query(
    "service_health_hourly_simple",
    """SELECT service_name, hour, round(avg_error_rate, 6) AS avg_error_rate, round(max_error_rate, 6) AS max_error_rate,
       round(avg_p95_latency_ms, 6) AS avg_p95_latency_ms, round(max_p95_latency_ms, 6) AS max_p95_latency_ms,
       total_requests FROM hourly_simple""",
    uses=("hourly_simple",),
)
def _(spark, d):
    return hourly_simple(spark, d)


@query(
    "window_gaps",
    """SELECT service_name, "timestamp", prev_timestamp, date_diff('minute', prev_timestamp, "timestamp") AS gap_minutes FROM (
       SELECT service_name, "timestamp", lag("timestamp") OVER (PARTITION BY service_name ORDER BY "timestamp") AS prev_timestamp FROM h5)
    WHERE date_diff('minute', prev_timestamp, "timestamp") > 5""",
    uses=("h5",),
)
def _(spark, d):
    return H.window_gaps(h5(spark, d))


@query(
    "span_volume",
    "SELECT date_trunc('hour', start_timestamp) AS hour, count(*) AS span_count FROM spans GROUP BY 1",
    uses=("spans",),
)
def _(spark, d):
    return H.span_volume(A.spans(spark, d))


@query(
    "volume_change",
    """SELECT hour, span_count, round(span_count * 100.0 / lag(span_count) OVER (ORDER BY hour), 6) AS pct_change FROM (
       SELECT date_trunc('hour', start_timestamp) AS hour, count(*) AS span_count FROM spans GROUP BY 1)""",
    uses=("spans",),
)
def _(spark, d):
    return H.volume_change(A.spans(spark, d))


@query(
    "rows_per_day",
    """SELECT service_name, count(*) AS row_count, min("timestamp") AS earliest, max("timestamp") AS latest,
       date_diff('day', min("timestamp"), max("timestamp")) AS days,
       round(count(*) / date_diff('day', min("timestamp"), max("timestamp")), 6) AS rows_per_day FROM h5 GROUP BY 1""",
    uses=("h5",),
)
def _(spark, d):
    return H.rows_per_day(h5(spark, d))


@query(
    "records_per_date",
    """SELECT CAST("timestamp" AS DATE) AS date, count(*) AS records FROM h5 GROUP BY 1""",
    uses=("h5",),
)
def _(spark, d):
    return H.records_per_date(h5(spark, d), "timestamp")


@query(
    "sanitize_health",
    """SELECT "timestamp", coalesce(service_name, 'unknown') AS service_name, total_requests - 2 AS raw_count,
       greatest(total_requests - 2, 0) AS request_count, greatest(round(p95_latency_ms - 20, 6), 0) AS latency_p95_ms,
       round(CASE WHEN total_requests - 2 <= 0 THEN 0 ELSE least(errors / (total_requests - 2), 1) END, 6) AS error_rate
    FROM (SELECT *, CAST(round(error_rate * total_requests) AS BIGINT) AS errors FROM h5)""",
    uses=("h5",),
)
def _(spark, d):
    raw = h5(spark, d).select(
        "timestamp",
        "service_name",
        (F.col("total_requests") - 2).alias("raw_count"),
        (F.col("total_requests") - 2).alias("request_count"),
        F.round(F.col("error_rate") * F.col("total_requests")).cast("bigint").alias("error_count"),
        (F.col("p95_latency_ms") - 20).alias("latency_p95_ms"),
    )
    return C.sanitize_health(raw).drop("error_count")


@query(
    "gate_by_samples",
    """SELECT service_name, hour, total_requests, CASE WHEN total_requests >= 3 THEN round(avg_latency_ms, 6) END AS avg_latency_ms,
       CASE WHEN total_requests >= 3 THEN round(coalesce(error_rate, 0), 6) ELSE 0 END AS error_rate FROM hourly""",
    uses=("hourly",),
)
def _(spark, d):
    gated = C.gate_by_samples(hourly(spark, d), 3, "total_requests", avg_latency_ms="null", error_rate="zero")
    return gated.select("service_name", "hour", "total_requests", "avg_latency_ms", "error_rate")


@query(
    "invalid_health",
    """SELECT "timestamp", service_name, round(error_rate - 0.5, 6) AS error_rate, round(p95_latency_ms - 20, 6) AS latency_p95_ms
    FROM h5 WHERE error_rate - 0.5 < 0 OR error_rate - 0.5 > 1 OR p95_latency_ms - 20 < 0""",
    uses=("h5",),
)
def _(spark, d):
    shifted = h5(spark, d).select(
        "timestamp", "service_name", (F.col("error_rate") - 0.5).alias("error_rate"),
        (F.col("p95_latency_ms") - 20).alias("latency_p95_ms"), F.col("total_requests").alias("request_count"),
    )
    return P.invalid_health(shifted).drop("request_count")


@query(
    "rps",
    """SELECT window_start, window_end, n, round(n / 300.0, 6) AS rps FROM (
       SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
              time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 5 MINUTES AS window_end, count(*) AS n
       FROM events GROUP BY 1, 2)""",
)
def _(spark, d):
    ts = F.col("ts").cast("timestamp")
    counted = A.table(spark, d, "events").groupBy(F.window(ts, "5 minutes").alias("window")).agg(F.count("*").alias("n"))
    return C.unnest_window(counted.withColumn("rps", C.rps(F.col("n"), F.col("window"))))
