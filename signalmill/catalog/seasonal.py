"""Baselines by the hour of the week, kept day by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import seasonal as S
from ..session import work_dir
from .book import cte, query
from .health import h5

DIGITS = {"error_rate": 6, "p95_latency_ms": 2, "total_requests": 0}

cte("weekly", """SELECT service_name, "timestamp", CAST((isodow("timestamp") - 1) * 24 + hour("timestamp") AS BIGINT) AS hour_of_week, metric, value, counted
    FROM (SELECT service_name, "timestamp", unnest(['error_rate', 'p95_latency_ms', 'total_requests']) AS metric,
          unnest([error_rate, p95_latency_ms, total_requests::DOUBLE]) AS value,
          unnest([round(error_rate, 6), round(p95_latency_ms, 2), total_requests::DOUBLE]) AS counted FROM h5)""", ("h5",))  # fmt: skip
cte("season", """SELECT service_name, hour_of_week, metric, any_value(med) AS median, quantile_cont(abs(counted - med), 0.5) AS mad, count(*) AS samples
    FROM (SELECT *, quantile_cont(counted, 0.5) OVER (PARTITION BY service_name, hour_of_week, metric) AS med FROM weekly)
    GROUP BY 1, 2, 3""", ("weekly",))  # fmt: skip


def day(text: str):
    return F.lit(text).cast("date")


def kept_counts(spark, d):
    """The state after three updates, the last of them run twice: each reads its own days only."""
    health, path = h5(spark, d).cache(), work_dir(spark, "seasonal")
    for since, until in (("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-01-29"), ("2024-01-29", "2024-02-01"), ("2024-01-30", "2024-02-01")):
        S.update_counts(health, path, day(since), day(until), DIGITS)
    health.unpersist()
    return S.read_counts(spark, path)


@query(
    "seasonal_baselines",
    "SELECT service_name, hour_of_week, metric, round(median, 6) AS median, round(mad, 6) AS mad, samples FROM season",
    uses=("season",),
)
def _(spark, d):
    return S.seasonal_baselines(kept_counts(spark, d))


@query(
    "seasonal_baselines_recent",
    """SELECT service_name, hour_of_week, metric, round(quantile_cont(counted, 0.5), 6) AS median, count(*) AS samples FROM weekly
    WHERE "timestamp" >= TIMESTAMP '2024-01-08' AND "timestamp" < TIMESTAMP '2024-01-29' GROUP BY 1, 2, 3""",
    uses=("weekly",),
)
def _(spark, d):
    return S.seasonal_baselines(kept_counts(spark, d), day("2024-01-08"), day("2024-01-29")).drop("mad")


@query(
    "seasonal_anomalies",
    """SELECT w.service_name, "timestamp", metric, round(value, 6) AS value, round(median, 6) AS median, round(mad, 6) AS mad,
       round((value - median) / (mad * 1.4826), 6) AS robust_z
    FROM weekly w JOIN season s USING (service_name, hour_of_week, metric) WHERE samples >= 4 AND mad > 0
      AND abs((value - median) / (mad * 1.4826)) > 2.5""",
    uses=("season",),
)
def _(spark, d):
    return S.seasonal_anomalies(h5(spark, d), S.seasonal_baselines(S.seasonal_counts(h5(spark, d), DIGITS)), 2.5, 4, DIGITS)
