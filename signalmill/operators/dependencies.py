"""Service-to-service call graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import lookback
from .traces import span_edges


def service_activity(spans: DataFrame) -> DataFrame:
    """Latest span start per service."""
    return spans.groupBy("service_name").agg(F.max("start_timestamp").alias("service_last_active"))


def service_dependencies(
    spans: DataFrame,
    interval: str | None = "90 days",
    as_of: Column | None = None,
    parent_interval: str | None = None,
    with_stats: bool = False,
) -> DataFrame:
    """Edges with call count, distinct traces and times.

    ``last_active`` is the latest span of either service, in a call or not.
    ``with_stats`` adds mean duration and errors of the calls. The activity
    frame is joined without a hint: it has one row per service, and Spark
    broadcasts it only when its measured size allows.
    """
    recent = lookback(spans, "start_timestamp", interval, as_of)
    if parent_interval is None:
        edges = span_edges(recent)
    else:
        edges = span_edges(spans, interval, parent_interval, as_of)
    stats = [
        F.count("*").alias("call_count"),
        F.countDistinct("trace_id").alias("unique_traces"),
        F.min("call_timestamp").alias("first_seen"),
        F.max("call_timestamp").alias("last_seen"),
    ]
    if with_stats:
        stats += [F.avg("duration_ms").alias("avg_duration_ms"), F.count_if("is_error").alias("error_count")]
    graph = edges.groupBy("source_service", "target_service").agg(*stats)
    activity = service_activity(recent)
    source = activity.select(
        F.col("service_name").alias("source_service"), F.col("service_last_active").alias("_source_active")
    )
    target = activity.select(
        F.col("service_name").alias("target_service"), F.col("service_last_active").alias("_target_active")
    )
    joined = graph.join(source, "source_service", "left").join(target, "target_service", "left")
    out = joined.withColumn("last_active", C.last_active(F.col("_source_active"), F.col("_target_active")))
    names = ["source_service", "target_service", "call_count", "unique_traces", "first_seen", "last_seen", "last_active"]
    names += ["avg_duration_ms", "error_count"] if with_stats else []
    return C.stamp(out.select(*names), as_of=as_of)


def call_counts(spans: DataFrame, interval: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Edges with their call count only."""
    return (
        span_edges(lookback(spans, "start_timestamp", interval, as_of))
        .groupBy("source_service", "target_service")
        .agg(F.count("*").alias("call_count"))
    )


def infer_dependencies(spans: DataFrame) -> DataFrame:
    """Edges for traces without parent links, from the order services join a trace.

    Each service of a multi-service trace points to the next one to appear.
    The list per trace has one entry per distinct service, and it yields one
    edge fewer than that.
    """
    arrivals = (
        spans.filter(F.col("service_name").isNotNull() & F.col("trace_id").isNotNull())
        .groupBy("trace_id", "service_name")
        .agg(F.min("start_timestamp").alias("first_seen"))
    )
    chains = (
        arrivals.groupBy("trace_id")
        .agg(F.sort_array(F.collect_list(F.struct("first_seen", "service_name"))).alias("chain"))
        .filter(F.size("chain") > 1)
    )
    service = F.transform("chain", lambda s: s["service_name"])
    sources = F.slice(service, 1, F.size("chain") - 1)
    targets = F.slice(service, 2, F.size("chain") - 1)
    pairs = F.explode(F.arrays_zip(sources.alias("source"), targets.alias("target")))
    return (
        chains.select(pairs.alias("edge"))
        .groupBy(F.col("edge.source").alias("source_service"), F.col("edge.target").alias("target_service"))
        .agg(F.count("*").alias("trace_count"))
    )


def multi_service_traces(spans: DataFrame) -> DataFrame:
    """Traces that touch more than one service, with the set of services."""
    return (
        spans.groupBy("trace_id")
        .agg(F.sort_array(F.collect_set("service_name")).alias("services"))
        .filter(F.size("services") > 1)
    )


def http_dependencies(spans: DataFrame, target: Column | None = None) -> DataFrame:
    """Edges from the peer a client span names in its attributes."""
    target = C.attr("peer.service") if target is None else target
    return (
        spans.select("service_name", target.alias("http_target_service"))
        .filter(F.col("http_target_service").isNotNull())
        .groupBy("service_name", "http_target_service")
        .agg(F.count("*").alias("call_count"))
    )


def top_edges(graph: DataFrame, k: int = 20) -> DataFrame:
    return graph.orderBy(F.desc("call_count"), "source_service", "target_service").limit(k)


def call_graph(graph: DataFrame) -> DataFrame:
    return graph.orderBy(F.desc("call_count"), "source_service", "target_service")
