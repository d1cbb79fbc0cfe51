"""Datasets built from written raw signals, their expectations, and refreshes of touched days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import health as H
from ..plans import build, datasets
from ..plans.checks import quarantined, valid_rows
from ..session import work_dir
from ..sinks import purge_days, refresh_days
from ..sources import SourceConfig, read_table
from . import adapters as A
from .book import cte, query
from .graph import DEPS
from .streams import in_files

NAMES = ["traces_silver", "logs_silver", "service_health_5min", "service_dependencies", "anomaly_baselines", "traces_assembled"]


def lake(spark, d, names=NAMES):
    """A folder of datasets, built from those of spans and logs that they read, in four batches each."""
    root, events, read = work_dir(spark, "lake"), A.table(spark, d, "events"), datasets().datasets
    at, each = F.unix_micros(F.col("ts").cast("timestamp")), 1
    for signal, make in (("spans", A.spans_of), ("logs", A.logs_of)):
        if any(f"otel_{signal}" in read[name].reads for name in names):
            _, each = in_files(spark, events, at, 4, f"{root}/otel_{signal}", make)  # as many for both: the rows are the same
    build(spark, SourceConfig(root=root), names, A.as_of(), parts=4, max_files=each)
    return root


VALID = "coalesce(try_cast(severity_number AS INTEGER) BETWEEN 1 AND 24, false)"


@query("build_dependencies", f"SELECT {DEPS} FROM deps", uses=("deps",))
def _(spark, d):
    return read_table(spark, f"{lake(spark, d, ['traces_silver', 'service_dependencies'])}/service_dependencies").select(*DEPS.split(", "))


@query(
    "build_quarantine",
    f"""SELECT DISTINCT trace_id, span_id, observed_timestamp, body, severity_number,
       CASE WHEN {VALID} THEN '' ELSE 'valid_severity' END AS violations, NOT {VALID} AS apart FROM logs""",
    uses=("logs",),
)
def _(spark, d):
    logs = read_table(spark, f"{lake(spark, d, ['logs_silver'])}/logs_silver")
    columns = ["trace_id", "span_id", "observed_timestamp", "body", "severity_number"]
    apart = quarantined(logs).select(*columns, F.array_join("_violations", ",").alias("violations"), F.lit(True).alias("apart"))
    return valid_rows(logs).select(*columns, F.lit("").alias("violations"), F.lit(False).alias("apart")).unionByName(apart)


@query(
    "build_expectations",
    f"""SELECT dataset, expectation, "rows", failed FROM (
      SELECT 'logs_silver' AS dataset, unnest(['valid_log_timestamp', 'valid_severity']) AS expectation, n AS "rows", unnest([t, s]) AS failed
      FROM (SELECT count(*) AS n, count(*) FILTER (log_timestamp IS NULL) AS t, count(*) FILTER (NOT {VALID}) AS s
            FROM (SELECT DISTINCT trace_id, span_id, observed_timestamp, body, log_timestamp, severity_number FROM logs))
      UNION ALL
      SELECT 'traces_silver', unnest(['valid_trace_id', 'valid_timestamps', 'valid_duration']), n, unnest([i, t, u])
      FROM (SELECT count(*) AS n, count(*) FILTER (trace_id IS NULL) AS i, count(*) FILTER (NOT start_timestamp <= end_timestamp) AS t,
                   count(*) FILTER (NOT duration_ms >= 0) AS u FROM spans)
      UNION ALL
      SELECT 'traces_assembled', 'valid_span_count', 0, 0)""",
    uses=("logs", "spans"),
)
def _(spark, d):
    names = ["traces_silver", "logs_silver", "traces_assembled"]
    found = read_table(spark, f"{lake(spark, d, names)}/expectation_results")
    # Rows of assembled traces depend on the parts that a trace's spans fall into.
    rows = F.when(F.col("dataset") == "traces_assembled", F.lit(0)).otherwise(F.col("rows"))
    return found.select("dataset", "expectation", rows.cast("bigint").alias("rows"), "failed")


# Rows arrive in two loads; the second brings the last days and, late, a few of the third day. A refresh makes
# the touched days again, and the purge empties the first two.
cte("hourly_days", """SELECT CAST(start_timestamp AS DATE) AS day, date_trunc('hour', start_timestamp) AS "timestamp", service_name,
       count(*) AS total_requests, count(*) FILTER (is_error) / count(*) AS error_rate, max(duration_ms) AS max_latency_ms
    FROM spans GROUP BY 1, 2, 3""", ("spans",))  # fmt: skip


@query(
    "refresh_days",
    """SELECT day, "timestamp", service_name, total_requests, round(error_rate, 6) AS error_rate, round(max_latency_ms, 6) AS max_latency_ms,
       CASE WHEN day = DATE '2024-01-03' OR day >= DATE '2024-01-20' THEN 'again' ELSE 'first' END AS made
    FROM hourly_days WHERE day >= DATE '2024-01-03'""",
    uses=("hourly_days",),
)
def _(spark, d):
    root, at = work_dir(spark, "days"), F.col("start_timestamp")
    # What comes in the second load; the rest is there before.
    second = (at >= F.lit("2024-01-20").cast("timestamp")) | ((F.to_date(at) == F.lit("2024-01-03").cast("date")) & (F.col("duration_ms") > 50))
    spans = A.spans(spark, d).drop("ingestion_timestamp")

    def make(load: str):
        def hourly(rows):
            hours = H.service_health_5min(rows, None, A.as_of(), "1 hour").select(
                "timestamp", "service_name", "total_requests", "error_rate", "max_latency_ms"
            )
            return hours.withColumns({"day": F.to_date("timestamp"), "made": F.lit(load)})

        return hourly

    for load, (arrived, rows) in {"first": ("2024-02-01", ~second), "again": ("2024-02-02", second)}.items():
        spans.filter(rows).withColumn("arrived", F.lit(arrived).cast("timestamp")).write.mode("append").parquet(f"{root}/spans")
        refresh_days(spark.read.parquet(f"{root}/spans"), f"{root}/hourly", make(load), "start_timestamp", "arrived")
    purge_days(spark, f"{root}/hourly", F.lit("2024-01-03").cast("date"))
    return spark.read.parquet(f"{root}/hourly")
