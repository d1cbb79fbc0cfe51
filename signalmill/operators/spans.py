"""Raw spans to one flat row per span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C

# Columns of the flat and the wide span table.
FLAT = [
    "trace_id", "span_id", "parent_span_id", "name", "kind", "service_name", "start_timestamp",
    "end_timestamp", "duration_ms", "is_error", "status_message", "attributes", "events", "links",
    "ingestion_timestamp",
]

WIDE = [
    "trace_id", "span_id", "parent_span_id", "name", "kind", "service_name", "service_version",
    "telemetry_sdk_language", "telemetry_sdk_name", "telemetry_sdk_version", "http_method",
    "http_status_code", "http_url", "http_target", "rpc_service", "rpc_method",
    "rpc_grpc_status_code", "start_timestamp", "end_timestamp", "duration_ms", "is_error",
    "status_message", "instrumentation_scope_name", "instrumentation_scope_version", "attributes",
    "events", "links", "ingestion_timestamp",
]


def flatten_spans(
    raw: DataFrame, wide: bool = False, precision: str = "micro", as_of: Column | None = None
) -> DataFrame:
    """Flat spans; ``wide`` adds SDK, HTTP, RPC and scope columns. Works on streams."""
    start, end = F.col("start_time_unix_nano"), F.col("end_time_unix_nano")
    parts = {
        "trace_id": C.blank_to_null(F.col("trace_id")),
        "parent_span_id": C.blank_to_null(F.col("parent_span_id")),
        "service_name": C.res_attr("service.name"),
        "start_timestamp": C.nanos_to_ts(start, precision),
        "end_timestamp": C.nanos_to_ts(end, precision),
        "duration_ms": C.duration_ms(start, end),
        "is_error": C.is_error(C.field("status.code")),
        "status_message": C.field("status.message"),
        "ingestion_timestamp": C.now(as_of),
    }
    if wide:
        parts |= {
            "service_version": C.res_attr("service.version"),
            "telemetry_sdk_language": C.res_attr("telemetry.sdk.language"),
            "telemetry_sdk_name": C.res_attr("telemetry.sdk.name"),
            "telemetry_sdk_version": C.res_attr("telemetry.sdk.version"),
            "http_method": C.attr("http.method"),
            "http_status_code": C.attr("http.status_code", "int"),
            "http_url": C.attr("http.url"),
            "http_target": C.attr("http.target"),
            "rpc_service": C.attr("rpc.service"),
            "rpc_method": C.attr("rpc.method"),
            "rpc_grpc_status_code": C.attr("rpc.grpc.status_code", "int"),
            "instrumentation_scope_name": C.field("instrumentation_scope.name"),
            "instrumentation_scope_version": C.field("instrumentation_scope.version"),
        }
    return raw.select(*[parts[n].alias(n) if n in parts else F.col(n) for n in (WIDE if wide else FLAT)])
