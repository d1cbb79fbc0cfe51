"""Reader and writer queries: what was written is read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions import columns as C
from ..operators import health as H
from ..operators.logs import flatten_logs
from ..operators.metrics import flatten_metrics
from ..operators.spans import flatten_spans
from ..plans import datasets
from ..session import work_dir
from ..sinks import (
    append_if_any, compact, purge_older_than, read_latest, rewrite_clustered, upsert_latest, write_table,
)
from ..sources import load_signal_csv, read_table
from . import adapters as A
from .book import query
from .graph import DEPS
from .health import H5_COLUMNS


@query("read_table", "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events")
def _(spark, d):
    return read_table(spark, f"{d}/events.parquet")


CSV_ROWS = 1_000_000  # rows of a file: compressed text can't be split, so larger inputs are more files


def _as_csv(raw: DataFrame, path: str) -> None:
    """An export: compressed, as JSON repeats its names in every row."""
    nested = [f.name for f in raw.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    text = raw.select(
        *[(F.to_json(f.name) if f.name in nested else F.col(f.name).cast("string")).alias(f.name) for f in raw.schema.fields]
    )
    text.write.mode("overwrite").options(header=True, escape='"', compression="lz4", maxRecordsPerFile=CSV_ROWS).csv(path)


@query(
    "load_signal_csv",
    """SELECT trace_id, span_id, parent_span_id, service_name, start_timestamp, round(duration_ms, 6) AS duration_ms,
       is_error, http_route FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    path = work_dir(spark, "spans-csv")
    _as_csv(A.raw_spans(spark, d), path)
    flat = flatten_spans(load_signal_csv(spark, path, "spans"))
    return flat.select(
        "trace_id", "span_id", "parent_span_id", "service_name", "start_timestamp", "duration_ms", "is_error",
        C.attr("http.route").alias("http_route"),
    )


@query(
    "load_logs_csv",
    "SELECT trace_id, span_id, log_timestamp, severity_number, body, service_name FROM logs",
    uses=("logs",),
)
def _(spark, d):
    path = work_dir(spark, "logs-csv")
    _as_csv(A.raw_logs(spark, d), path)
    flat = flatten_logs(load_signal_csv(spark, path, "logs"))
    return flat.select("trace_id", "span_id", "log_timestamp", "severity_number", "body", "service_name")


@query(
    "load_metrics_csv",
    """SELECT name, service_name, metric_type, metric_timestamp, round(value, 6) AS value, histogram_count,
       CAST(len(histogram_buckets) AS BIGINT) AS bucket_count, exp_histogram_zero_count FROM metrics""",
    uses=("metrics",),
)
def _(spark, d):
    path = work_dir(spark, "metrics-csv")
    _as_csv(A.raw_metrics(spark, d), path)
    flat = flatten_metrics(load_signal_csv(spark, path, "metrics"))
    return flat.select(
        "name", "service_name", "metric_type", "metric_timestamp", "value", "histogram_count",
        F.array_size("histogram_buckets").alias("bucket_count"), "exp_histogram_zero_count",
    )


@query("write_table", f"SELECT {H5_COLUMNS} FROM h5", uses=("h5",))
def _(spark, d):
    path = work_dir(spark, "health")
    write_table(H.service_health_5min(A.spans(spark, d), None), path)
    return read_table(spark, path)


@query(
    "append_if_any",
    "SELECT service_name, span_id FROM spans WHERE is_error",
    uses=("spans",),
)
def _(spark, d):
    path = work_dir(spark, "errors")
    flat = A.spans(spark, d).select("service_name", "span_id", "is_error")
    append_if_any(flat.filter("is_error").drop("is_error"), path)
    append_if_any(flat.filter("is_error IS NULL").drop("is_error"), path)
    return read_table(spark, path)


@query(
    "rewrite_clustered",
    "SELECT trace_id, span_id, service_name, start_timestamp FROM spans",
    uses=("spans",),
)
def _(spark, d):
    path = work_dir(spark, "clustered")
    rewrite_clustered(A.spans(spark, d).drop("ingestion_timestamp"), path, ["trace_id"])
    return read_table(spark, path).select("trace_id", "span_id", "service_name", "start_timestamp")


@query(
    "purge_older_than",
    f"SELECT trace_id, span_id FROM spans WHERE start_timestamp >= {A.AS_OF_SQL} - INTERVAL 7 DAY",
    uses=("spans",),
)
def _(spark, d):
    return purge_older_than(A.spans(spark, d), "start_timestamp", "7 DAYS", A.as_of()).select("trace_id", "span_id")


# Two batches of status updates per user; the later event of a user wins.
@query(
    "upsert_latest",
    """SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
       FROM events) WHERE r = 1""",
)
def _(spark, d):
    updates = A.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    target, order = work_dir(spark, "latest"), ["ts", "event_id"]
    write = upsert_latest(target, ["user_id"], order)
    write(updates.filter("event_type IN ('click', 'view')"), 0)
    write(updates.filter("event_type NOT IN ('click', 'view')"), 1)
    folded = work_dir(spark, "latest-folded")
    compact(spark, target, folded, ["user_id"], order)
    return read_latest(spark, folded, ["user_id"], order)


@query(
    "conform",
    """SELECT event_id, CAST(ts AS VARCHAR) IS NOT NULL AS has_ts, user_id AS user_id, CAST(NULL AS VARCHAR) AS region FROM events""",
)
def _(spark, d):
    wanted = StructType.fromDDL("user_id INT, event_id STRING, region STRING, ts TIMESTAMP")
    shaped = C.conform(A.table(spark, d, "events"), wanted)
    return shaped.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("ts").isNotNull().alias("has_ts"), "user_id", "region"
    )


@query("registry_dependencies", f"SELECT {DEPS} FROM deps", uses=("deps",))
def _(spark, d):
    return datasets(A.as_of()).frame("service_dependencies", {"otel_spans": A.raw_spans(spark, d)})


@query(
    "last_active",
    """SELECT user_id, greatest(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'view')) AS last_active
    FROM events GROUP BY 1""",
)
def _(spark, d):
    e = A.table(spark, d, "events")
    by_user = e.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "click", F.col("ts"))).alias("clicked"),
        F.max(F.when(F.col("event_type") == "view", F.col("ts"))).alias("viewed"),
    )
    active = by_user.withColumn("last_active", C.last_active(F.col("clicked"), F.col("viewed")))
    return C.drop_after_join(active, ["clicked", "viewed"])


@query(
    "trace_logs_and_spans",
    """SELECT s.trace_id, s.span_id, l.body FROM spans s JOIN logs l ON s.trace_id = l.trace_id AND s.span_id = l.span_id
    WHERE s.is_error""",
    uses=("spans", "logs"),
)
def _(spark, d):
    failed = A.spans(spark, d).filter("is_error").select("trace_id", "span_id")
    return failed.join(A.logs(spark, d).select("trace_id", "span_id", "body"), ["trace_id", "span_id"])
