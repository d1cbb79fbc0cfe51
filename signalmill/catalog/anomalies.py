"""Baseline and detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as N
from . import adapters as A
from .book import cte, query
from .health import h1, h5


def baseline_sql(source: str, latency: str) -> str:
    return f"""SELECT service_name, avg(error_rate) AS baseline_error_rate, stddev_samp(error_rate) AS error_rate_stddev,
       avg(error_rate) + 3 * stddev_samp(error_rate) AS error_rate_threshold,
       avg({latency}) AS baseline_p95_latency_ms, stddev_samp({latency}) AS latency_stddev,
       avg({latency}) + 3 * stddev_samp({latency}) AS latency_threshold, count(*) AS sample_count,
       min("timestamp") AS baseline_start_timestamp, max("timestamp") AS baseline_end_timestamp
    FROM {source} WHERE "timestamp" >= {A.AS_OF_SQL} - INTERVAL 40 DAY GROUP BY 1"""


cte("base5", baseline_sql("h5", "p95_latency_ms"), ("h5",))
cte("base1", baseline_sql("h1", "latency_p95_ms"), ("h1",))
BASE_COLUMNS = """service_name, round(baseline_error_rate, 6) AS baseline_error_rate, round(error_rate_stddev, 6) AS error_rate_stddev,
       round(error_rate_threshold, 6) AS error_rate_threshold, round(baseline_p95_latency_ms, 6) AS baseline_p95_latency_ms,
       round(latency_stddev, 6) AS latency_stddev, round(latency_threshold, 6) AS latency_threshold,
       sample_count, baseline_start_timestamp, baseline_end_timestamp"""


def base5(spark, d):
    return N.anomaly_baselines(h5(spark, d), 3, 40, A.as_of())


def base1(spark, d):
    return N.anomaly_baselines(h1(spark, d), 3, 40, A.as_of(), "latency_p95_ms")


@query("anomaly_baselines", f"SELECT {BASE_COLUMNS} FROM base5", uses=("base5",))
def _(spark, d):
    return base5(spark, d)


@query("anomaly_baselines_1min", f"SELECT {BASE_COLUMNS} FROM base1", uses=("base1",))
def _(spark, d):
    return base1(spark, d)


def anomalies_sql(health: str, base: str, latency: str) -> str:
    return f"""SELECT h.service_name, h."timestamp", h.error_rate, b.error_rate_threshold, h.{latency} AS p95_latency_ms,
       b.latency_threshold, CASE WHEN h.error_rate > b.error_rate_threshold THEN 'error_rate' ELSE 'latency' END AS anomaly_type
    FROM {health} h JOIN {base} b ON h.service_name = b.service_name
    WHERE h.error_rate > b.error_rate_threshold OR h.{latency} > b.latency_threshold"""


cte("hits5", anomalies_sql("h5", "base5", "p95_latency_ms"), ("h5", "base5"))
cte("hits1", anomalies_sql("h1", "base1", "latency_p95_ms"), ("h1", "base1"))
HIT_COLUMNS = """service_name, "timestamp", round(error_rate, 6) AS error_rate, round(error_rate_threshold, 6) AS error_rate_threshold,
       round(p95_latency_ms, 6) AS p95_latency_ms, round(latency_threshold, 6) AS latency_threshold, anomaly_type"""


def hits5(spark, d):
    return N.detect_anomalies(h5(spark, d), base5(spark, d), None, A.as_of(), "p95_latency_ms")


@query("detect_anomalies", f"SELECT {HIT_COLUMNS} FROM hits5", uses=("hits5",))
def _(spark, d):
    return hits5(spark, d)


@query("detect_anomalies_1min", f"SELECT {HIT_COLUMNS} FROM hits1", uses=("hits1",))
def _(spark, d):
    return N.detect_anomalies(h1(spark, d), base1(spark, d), None, A.as_of())


@query(
    "detect_anomalies_recent",
    f"""SELECT {HIT_COLUMNS} FROM hits1 WHERE "timestamp" >= {A.AS_OF_SQL} - INTERVAL 1440 MINUTE""",
    uses=("hits1",),
)
def _(spark, d):
    return N.detect_anomalies(h1(spark, d), base1(spark, d), 1440, A.as_of())


@query("anomalies_by_service", "SELECT service_name, count(*) AS anomaly_count FROM hits5 GROUP BY 1", uses=("hits5",))
def _(spark, d):
    return N.anomalies_by_service(hits5(spark, d))


@query(
    "recent_anomalies",
    f"""SELECT {HIT_COLUMNS} FROM (SELECT * FROM hits5 ORDER BY "timestamp" DESC, service_name LIMIT 20)""",
    uses=("hits5",),
)
def _(spark, d):
    return N.recent_anomalies(hits5(spark, d))


@query(
    "zscores",
    """SELECT h.service_name, h."timestamp", round(h.error_rate, 6) AS current_error_rate,
       round(baseline_error_rate, 6) AS baseline_error_rate, round(error_rate_stddev, 6) AS error_rate_stddev,
       round((h.error_rate - baseline_error_rate) / nullif(error_rate_stddev, 0), 6) AS z_score
    FROM h1 h JOIN base1 b ON h.service_name = b.service_name""",
    uses=("h1", "base1"),
)
def _(spark, d):
    return N.zscores(h1(spark, d), base1(spark, d), None)


@query("baseline_freshness", "SELECT max(baseline_end_timestamp) AS latest_baseline FROM base5", uses=("base5",))
def _(spark, d):
    return N.baseline_freshness(base5(spark, d), "baseline_end_timestamp")


@query(
    "anomaly_type",
    """SELECT event_id, CASE WHEN value > 100 THEN 'error_rate' WHEN value > 20 THEN 'latency' ELSE 'unknown' END AS anomaly_type FROM events""",
)
def _(spark, d):
    from ..functions.columns import anomaly_type

    label = anomaly_type(F.col("value") > 100, F.col("value") > 20)
    return A.table(spark, d, "events").select("event_id", label.alias("anomaly_type"))
