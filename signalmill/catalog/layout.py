"""Tables laid out by several keys, and lookups in them."""

from __future__ import annotations

from ..operators.spans import flatten_spans
from ..session import work_dir
from ..sinks import raw_lookback, rewrite_z_ordered
from ..sources import read_table
from . import adapters as A
from .book import query
from .spans import FLAT_SQL

KEYS = ["service_name", "http_method", "start_timestamp"]
WIDE = "trace_id, span_id, parent_span_id, service_name, http_method, start_timestamp, end_timestamp, round(duration_ms, 6) AS duration_ms, is_error"


def laid_out(spark, d):
    path = work_dir(spark, "z-ordered")
    spans = A.wide_spans(spark, d).drop("ingestion_timestamp", "events", "attributes", "links")
    rewrite_z_ordered(spans, path, KEYS, {"trace_id": 20_000}, options={"parquet.block.size": str(64 << 10)})
    return read_table(spark, path)


def columns_of(df):
    return df.select("trace_id", "span_id", "parent_span_id", "service_name", "http_method", "start_timestamp", "end_timestamp", "duration_ms", "is_error")


@query("rewrite_z_ordered", f"SELECT {WIDE} FROM spans", uses=("spans",))
def _(spark, d):
    return columns_of(laid_out(spark, d))


@query("z_ordered_by_service", f"SELECT {WIDE} FROM spans WHERE service_name = 'svc-click'", uses=("spans",))
def _(spark, d):
    return columns_of(laid_out(spark, d)).filter("service_name = 'svc-click'")


@query("z_ordered_by_trace", f"SELECT {WIDE} FROM spans WHERE trace_id = 't77'", uses=("spans",))
def _(spark, d):
    return columns_of(laid_out(spark, d)).filter("trace_id = 't77'")


@query("raw_lookback", f"SELECT {FLAT_SQL} FROM spans WHERE start_timestamp >= {A.AS_OF_SQL} - INTERVAL 3 DAY", uses=("spans",))
def _(spark, d):
    path = work_dir(spark, "raw-spans")
    A.raw_spans(spark, d).write.parquet(path)
    recent = raw_lookback(read_table(spark, path, A.raw_spans(spark, d).schema), "start_time_unix_nano", "3 DAYS", A.as_of())
    return flatten_spans(recent).drop("attributes", "events", "links")
