"""Raw signal schemas and the keys of the derived tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

_ATTRS = "MAP<STRING,STRING>"
_RESOURCE = f"STRUCT<attributes:{_ATTRS},dropped_attributes_count:INT>"
_SCOPE = f"STRUCT<name:STRING,version:STRING,attributes:{_ATTRS},dropped_attributes_count:INT>"
_EXEMPLARS = (
    "ARRAY<STRUCT<time_unix_nano:BIGINT,value:DOUBLE,span_id:STRING,trace_id:STRING,"
    f"filtered_attributes:{_ATTRS}>>"
)
_BUCKET = "STRUCT<offset:INT,bucket_counts:ARRAY<BIGINT>>"
_POINT = "start_time_unix_nano:BIGINT,time_unix_nano:BIGINT"

# The OpenTelemetry data model as the raw tables store it (fixed values).
SPAN_COLUMNS = {
    "trace_id": "STRING",
    "span_id": "STRING",
    "trace_state": "STRING",
    "parent_span_id": "STRING",
    "flags": "INT",
    "name": "STRING",
    "kind": "STRING",
    "start_time_unix_nano": "BIGINT",
    "end_time_unix_nano": "BIGINT",
    "attributes": _ATTRS,
    "dropped_attributes_count": "INT",
    "events": f"ARRAY<STRUCT<time_unix_nano:BIGINT,name:STRING,attributes:{_ATTRS},dropped_attributes_count:INT>>",
    "dropped_events_count": "INT",
    "links": (
        f"ARRAY<STRUCT<trace_id:STRING,span_id:STRING,trace_state:STRING,attributes:{_ATTRS},"
        "dropped_attributes_count:INT,flags:INT>>"
    ),
    "dropped_links_count": "INT",
    "status": "STRUCT<message:STRING,code:STRING>",
    "resource": _RESOURCE,
    "resource_schema_url": "STRING",
    "instrumentation_scope": _SCOPE,
    "span_schema_url": "STRING",
}

LOG_COLUMNS = {
    "event_name": "STRING",
    "trace_id": "STRING",
    "span_id": "STRING",
    "time_unix_nano": "BIGINT",
    "observed_time_unix_nano": "BIGINT",
    "severity_number": "STRING",
    "severity_text": "STRING",
    "body": "STRING",
    "attributes": _ATTRS,
    "dropped_attributes_count": "INT",
    "flags": "INT",
    "resource": _RESOURCE,
    "resource_schema_url": "STRING",
    "instrumentation_scope": _SCOPE,
    "log_schema_url": "STRING",
}

METRIC_COLUMNS = {
    "name": "STRING",
    "description": "STRING",
    "unit": "STRING",
    "metric_type": "STRING",
    "gauge": f"STRUCT<{_POINT},value:DOUBLE,exemplars:{_EXEMPLARS},attributes:{_ATTRS},flags:INT>",
    "sum": (
        f"STRUCT<{_POINT},value:DOUBLE,exemplars:{_EXEMPLARS},attributes:{_ATTRS},flags:INT,"
        "aggregation_temporality:STRING,is_monotonic:BOOLEAN>"
    ),
    "histogram": (
        f"STRUCT<{_POINT},count:BIGINT,sum:DOUBLE,bucket_counts:ARRAY<BIGINT>,explicit_bounds:ARRAY<DOUBLE>,"
        f"exemplars:{_EXEMPLARS},attributes:{_ATTRS},flags:INT,min:DOUBLE,max:DOUBLE,aggregation_temporality:STRING>"
    ),
    "exponential_histogram": (
        f"STRUCT<attributes:{_ATTRS},{_POINT},count:BIGINT,sum:DOUBLE,scale:INT,zero_count:BIGINT,"
        f"positive_bucket:{_BUCKET},negative_bucket:{_BUCKET},flags:INT,exemplars:{_EXEMPLARS},"
        "min:DOUBLE,max:DOUBLE,zero_threshold:DOUBLE,aggregation_temporality:STRING>"
    ),
    "summary": (
        f"STRUCT<{_POINT},count:BIGINT,sum:DOUBLE,quantile_values:ARRAY<STRUCT<quantile:DOUBLE,value:DOUBLE>>,"
        f"attributes:{_ATTRS},flags:INT>"
    ),
    "metadata": _ATTRS,
    "resource": _RESOURCE,
    "resource_schema_url": "STRING",
    "instrumentation_scope": _SCOPE,
    "metric_schema_url": "STRING",
}

SIGNALS = {"spans": SPAN_COLUMNS, "logs": LOG_COLUMNS, "metrics": METRIC_COLUMNS}

# The five metric types (fixed values).
METRIC_TYPES = ("gauge", "sum", "histogram", "exponential_histogram", "summary")
NUMBER_TYPES = ("gauge", "sum")
DISTRIBUTION_TYPES = ("histogram", "exponential_histogram", "summary")

# Primary keys of the serving copies. Rollup rows are also told apart by type.
SERVING_KEYS = {
    "metrics_1min_rollup": ["name", "service_name", "metric_type", "window_start"],
    "traces_silver": ["trace_id", "span_id"],
    "logs_silver": ["log_key"],
    "service_dependencies": ["source_service", "target_service"],
    "traces_assembled": ["trace_id", "part"],
}

# Columns each table is laid out by, so that file statistics prune the usual lookups.
CLUSTER_KEYS = {
    "otel_spans": ["trace_id"],
    "otel_metrics": ["name"],
    "otel_logs": ["trace_id"],
    "traces_silver": ["trace_id"],
    "logs_silver": ["trace_id", "log_timestamp"],
    "metrics_silver": ["service_name", "metric_type", "metric_timestamp"],
    "service_health_silver": ["service_name", "timestamp"],
}


def ddl(signal: str) -> str:
    """DDL text of a raw signal table."""
    return ", ".join(f"`{name}` {kind}" for name, kind in SIGNALS[signal].items())


def struct(signal: str) -> StructType:
    """The same as a ``StructType``, for readers that must not infer."""
    return StructType.fromDDL(ddl(signal))
