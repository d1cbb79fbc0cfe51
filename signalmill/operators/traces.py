"""Trees of spans: assembly, parent/child edges, orphans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import children, lookback
from .gather import Total, gather, total

# The columns of a span in an assembled trace.
SPAN_DETAIL = ["span_id", "parent_span_id", "name", "kind", "service_name", "duration_ms", "is_error"]


def _totals() -> dict[str, Total]:
    mean = {"_duration_sum": F.sum("duration_ms"), "_duration_count": F.count("duration_ms")}
    services = {"_services": F.collect_set("service_name")}
    return {
        "span_count": total(F.count("*"), F.sum, "_spans"),
        "trace_start": total(F.min("start_timestamp"), F.min, "_start"),
        "trace_end": total(F.max("end_timestamp"), F.max, "_end"),
        "services_involved": Total(
            services, lambda over: F.array_sort(F.array_distinct(over(F.collect_list, "_services", F.flatten)))
        ),
        "error_count": total(F.sum(F.col("is_error").cast("int")), F.sum, "_errors"),
        "max_span_duration_ms": total(F.max("duration_ms"), F.max, "_longest"),
        "avg_span_duration_ms": Total(
            mean, lambda over: F.try_divide(over(F.sum, "_duration_sum"), over(F.sum, "_duration_count"))
        ),
    }


def _span_list() -> Column:
    return F.sort_array(F.collect_list(F.struct(*SPAN_DETAIL)))


def trace_summaries(spans: DataFrame, interval: str | None = None, as_of: Column | None = None) -> DataFrame:
    """One row per trace without its span list: a single, map-side combined aggregate."""
    recent = lookback(spans, "start_timestamp", interval, as_of)
    return C.trace_derived(gather(recent, ["trace_id"], _totals(), {}, 1, []).drop("part"))


def trace_totals(spans: DataFrame, size: str = "5 minutes", delay: str | None = "10 minutes") -> DataFrame:
    """Summaries per trace and start window, batch or stream: state is bounded, nothing is listed.

    The detail of a stream is ``trace_details``, written as it comes; ``with_span_lists`` puts the
    two written tables together.
    """
    if delay:
        spans = spans.withWatermark("start_timestamp", delay)
    windowed = spans.withColumn("window", F.window("start_timestamp", size))
    return C.trace_derived(gather(windowed, ["trace_id", "window"], _totals(), {}, 1, []).drop("part"))


def trace_details(spans: DataFrame, size: str = "5 minutes") -> DataFrame:
    """The spans themselves by trace, window, time and id: a projection, batch or stream."""
    window = F.window("start_timestamp", size).alias("window")
    return spans.select("trace_id", window, "start_timestamp", *SPAN_DETAIL)


def with_span_lists(totals: DataFrame, details: DataFrame, parts: int = 1) -> DataFrame:
    """Written totals with the lists of their written spans: one row per trace, window and part."""
    lists = gather(details, ["trace_id", "window"], {}, {"span_details": _span_list()}, parts, ["span_id", "start_timestamp", "name"])
    key = F.struct("trace_id", "window").alias("_key")
    return totals.select(key, *[c for c in totals.columns if c not in ("trace_id", "window")]).join(
        lists.select(key, "part", "span_details"), "_key"
    ).select("_key.*", "*").drop("_key")


def assemble_traces(
    spans: DataFrame, interval: str | None = "24 hours", as_of: Column | None = None, parts: int = 1
) -> DataFrame:
    """Traces with all their spans as an array of structs: ``parts`` rows per trace, one by default.

    Each row has the totals of the whole trace and a share of its spans. Where a trace may be too
    large for a row, use ``trace_summaries`` with the spans themselves, or more ``parts``; the number
    holds for every trace. ``interval`` looks at span starts: a trace that straddles the edge is
    assembled from its recent spans.
    """
    recent = lookback(spans, "start_timestamp", interval, as_of)
    spread = ["span_id", "start_timestamp", "name"]
    out = C.trace_derived(gather(recent, ["trace_id"], _totals(), {"span_details": _span_list()}, parts, spread))
    return C.stamp(out, as_of=as_of).select(
        "trace_id", "part", "span_count", "trace_start", "trace_end", "total_trace_duration_ms",
        "services_involved", "service_count", "error_count", "has_errors", "max_span_duration_ms",
        "avg_span_duration_ms", "span_details", "ingestion_timestamp",
    )


def assemble_traces_windowed(
    spans: DataFrame, size: str = "5 minutes", parts: int = 1, as_of: Column | None = None
) -> DataFrame:
    """Assembly per trace and start window of a batch; streams keep ``trace_totals`` and ``trace_details``."""
    windowed = spans.withColumn("window", F.window("start_timestamp", size))
    spread = ["span_id", "start_timestamp", "name"]
    out = gather(windowed, ["trace_id", "window"], _totals(), {"span_details": _span_list()}, parts, spread)
    return C.stamp(C.trace_derived(out), as_of=as_of)


def span_edges(
    spans: DataFrame,
    child_interval: str | None = None,
    parent_interval: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Every child span with the service of its parent in the same trace.

    The parent side may look back further than the child side. Both sides are
    narrow projections; (trace_id, span_id) spreads even one giant trace over
    all partitions, and a parent with very many children is a skewed probe
    side, which adaptive execution splits.
    """
    child = children(lookback(spans, "start_timestamp", child_interval, as_of)).select(
        "trace_id", "parent_span_id", "span_id", F.col("service_name").alias("target_service"),
        F.col("start_timestamp").alias("call_timestamp"), "duration_ms", "is_error",
    )
    parent = lookback(spans, "start_timestamp", parent_interval, as_of).select(
        "trace_id", F.col("span_id").alias("parent_span_id"), F.col("service_name").alias("source_service"),
        F.col("start_timestamp").alias("parent_timestamp"),
    )
    return child.join(parent, ["trace_id", "parent_span_id"], "inner")


def orphan_spans(spans: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Child spans whose parent is not in their trace."""
    parents = spans if parents is None else parents
    known = parents.select("trace_id", F.col("span_id").alias("parent_span_id"))
    return children(spans).join(known, ["trace_id", "parent_span_id"], "left_anti")


def orphans_by_service(spans: DataFrame) -> DataFrame:
    return (
        orphan_spans(spans)
        .groupBy("service_name")
        .agg(F.count("*").alias("orphaned_count"))
        .orderBy(F.desc("orphaned_count"), "service_name")
    )


def traces_with_logs(spans: DataFrame, logs: DataFrame) -> DataFrame:
    """Distinct trace ids that occur in both signals."""
    seen = logs.filter(F.col("trace_id").isNotNull()).select("trace_id").distinct()
    return spans.filter(F.col("trace_id").isNotNull()).select("trace_id").distinct().join(seen, "trace_id", "left_semi")


def edge_split(spans: DataFrame) -> DataFrame:
    """Calls that stay in a service against calls that leave it."""
    kind = F.when(F.col("source_service") == F.col("target_service"), "same_service").otherwise("cross_service")
    return (
        span_edges(spans)
        .groupBy(kind.alias("call_type"))
        .agg(F.count("*").alias("call_count"), F.countDistinct("trace_id").alias("unique_traces"))
    )


def edges_per_trace(spans: DataFrame) -> DataFrame:
    return (
        span_edges(spans)
        .groupBy("source_service", "target_service", "trace_id")
        .agg(F.count("*").alias("span_count"))
    )


def unique_traces_approx(spans: DataFrame, rsd: float = 0.05) -> DataFrame:
    return spans.groupBy("service_name").agg(F.approx_count_distinct("trace_id", rsd).alias("trace_count"))
