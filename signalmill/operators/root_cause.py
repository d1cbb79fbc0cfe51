"""How errors move up a trace, and where they come from.

A failing span hands its error on if its parent fails too. Failing spans so form trees of their own: the
deepest, without a failing child, are origins; the top one, whose parent does not fail or is not there, is the
entry, where the error leaves the trace's failing part. Spans are told apart as in ``waterfall``; a row without
an error flag does not fail. Failing spans that lead into a cycle have no entry, chain and hops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written
from .forest import climb
from .waterfall import KEY, linked, span_nodes


def _failing(spans: DataFrame) -> DataFrame:
    """Failing spans with up, the parent if it fails too."""
    return linked(span_nodes(spans.filter("is_error"), "service_name")).select(*KEY, "service_name", "start_us", "up")


def _climbed(failing: DataFrame) -> DataFrame:
    links = failing.select(
        F.col("trace_id").alias("group"), F.col("span_id").alias("id"), "up", F.col("service_name").alias("item"), F.lit(True).alias("passes")
    )
    return climb(links).select(
        F.col("group").alias("trace_id"), F.col("id").alias("span_id"), F.col("root").alias("entry_span_id"),
        F.col("depth").alias("hops"), F.col("path").alias("services"), "in_cycle",
    )


def error_origins(spans: DataFrame) -> DataFrame:
    """Failing spans without a failing child, and the way of their error.

    trace_id, span_id, service_name, start_us, entry_span_id, entry_service, hops (calls up to the entry) and
    services (from the entry to the origin).
    """
    failing = written(_failing(spans), "failing")
    parents = failing.filter("up IS NOT NULL").select("trace_id", F.col("up").alias("span_id")).distinct()
    deepest = failing.join(parents, KEY, "left_anti").select(*KEY, "service_name", "start_us")
    return deepest.join(_climbed(failing), KEY).select(
        *KEY, "service_name", "start_us", "entry_span_id", F.get("services", F.lit(0)).alias("entry_service"), "hops", "services"
    )


def root_causes(origins: DataFrame) -> DataFrame:
    """One row per entry: the origin to blame, which is the one most calls below; ties: the earliest, then the least span id.

    trace_id, entry_span_id, entry_service, origins (how many it has), origin_span_id, origin_service, hops.
    """
    blamed = F.min_by(
        F.struct(F.col("span_id").alias("origin_span_id"), F.col("service_name").alias("origin_service"), "hops"),
        F.struct(-F.col("hops"), F.col("start_us").isNull(), "start_us", "span_id"),
    )
    per_entry = origins.filter("entry_span_id IS NOT NULL").groupBy("trace_id", "entry_span_id")
    found = per_entry.agg(F.any_value("entry_service").alias("entry_service"), F.count("*").alias("origins"), blamed.alias("blamed"))
    return found.select("trace_id", "entry_span_id", "entry_service", "origins", "blamed.*")


def error_chains(origins: DataFrame) -> DataFrame:
    """Errors by the chain of services they passed: services, origin_service, entry_service, hops, error_count, trace_count."""
    by_trace = origins.filter("entry_span_id IS NOT NULL").groupBy("services", "trace_id").agg(F.count("*").alias("n"))
    return by_trace.groupBy("services").agg(F.sum("n").alias("error_count"), F.count("*").alias("trace_count")).select(
        "services", F.get("services", F.size("services") - 1).alias("origin_service"), F.get("services", F.lit(0)).alias("entry_service"),
        (F.size("services") - 1).cast("bigint").alias("hops"), "error_count", "trace_count",
    )


def error_reach(causes: DataFrame) -> DataFrame:
    """Per blamed service the entry services it breaks: origin_service, entry_service, entry_count, trace_count, max_hops, avg_hops."""
    by_trace = causes.groupBy("origin_service", "entry_service", "trace_id").agg(
        F.count("*").alias("n"), F.max("hops").alias("most"), F.sum("hops").alias("hops")
    )
    return by_trace.groupBy("origin_service", "entry_service").agg(
        F.sum("n").alias("entry_count"), F.count("*").alias("trace_count"), F.max("most").alias("max_hops"),
        (F.sum("hops") / F.sum("n")).alias("avg_hops"),
    )
