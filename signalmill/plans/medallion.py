"""The standard datasets, from raw signals to baselines."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import anomaly, dependencies, health, logs, metrics, quality, rollups, spans, traces
from ..functions.columns import now
from ..operators.dedup import dedup
from ..schemas import ddl
from ..sinks.tables import write_table
from ..sources import SourceConfig, read_stream, read_table
from ..sources.tables import is_path
from ..streaming import StreamWatch, run_stream
from .checks import RESULTS, Checked, results_of, valid_rows
from .registry import Registry

RAW = {"otel_spans": "spans", "otel_logs": "logs", "otel_metrics": "metrics"}


# How long each stream dataset waits for late rows; None keeps every row and all state.
DELAYS: dict[str, str | None] = {
    "traces_silver": "10 minutes", "logs_silver": "10 minutes", "metrics_silver": "2 minutes",
    "metrics_1min_rollup": "30 seconds", "histogram_metrics_1min_totals": "30 seconds", "service_health_silver": "5 minutes",
    "spans_wide_silver": "10 minutes", "trace_totals": "10 minutes",
}
# How many days each resolution of health is kept (``sinks.purge_days`` of tables by day).
TIERS = {"service_health_5min": 7, "service_health_hourly": 30, "service_health_daily": 90}


# What becomes of rows that break an expectation, where it is not a mere warning.
ACTIONS: dict[str, str] = {"traces_silver": "quarantine", "logs_silver": "quarantine", "metrics_silver": "quarantine"}


def datasets(
    as_of: Column | None = None, delays: dict[str, str | None] | None = None, parts: int = 1, actions: dict[str, str] | None = None,
    alert_minutes: int | None = 10,
) -> Registry:
    """All datasets. ``delays`` replaces single entries of ``DELAYS``, ``actions`` those of ``ACTIONS``.

    ``parts`` is the number of rows that a trace or a histogram window with its lists is split into;
    ``alert_minutes`` is how far back anomalies are looked for (None: everywhere).

    Rows that come later than that are dropped from a stream dataset; a batch
    build over the raw tables has them all.
    """
    r = Registry()
    wait, act = {**DELAYS, **(delays or {})}, {**ACTIONS, **(actions or {})}

    def checks(name: str, predicates: dict[str, str]) -> dict:
        return {"expectations": predicates, "action": act.get(name, "warn")}

    def flat_spans(raw: DataFrame, name: str = "traces_silver", wide: bool = False) -> DataFrame:
        flat = spans.flatten_spans(raw, wide)
        keys, delay = ["trace_id", "span_id"], wait[name]
        if not flat.isStreaming:
            return dedup(flat, keys)
        return dedup(flat, keys, ("start_timestamp", delay), within=True) if delay else flat.dropDuplicates(keys)

    def flat_logs(raw: DataFrame) -> DataFrame:
        flat = logs.flatten_logs(raw)
        delay = wait["logs_silver"]
        if not flat.isStreaming:
            return dedup(flat, logs.DEDUP_KEYS)
        return dedup(flat, logs.DEDUP_KEYS, ("observed_timestamp", delay)) if delay else flat.dropDuplicates(logs.DEDUP_KEYS)

    def flat_metrics(raw: DataFrame) -> DataFrame:
        flat = metrics.flatten_metrics(raw)
        return metrics.dedup_metrics(flat, late(flat, "metrics_silver"))

    def late(df: DataFrame, name: str) -> str | None:
        if df.isStreaming and wait[name] is None:
            raise ValueError(f"{name} needs a delay: its windows close by it")
        return wait[name] if df.isStreaming else None

    r.register("traces_silver", flat_spans, ("otel_spans",), "stream", **checks("traces_silver", quality.SPAN_EXPECTATIONS))
    r.register("logs_silver", flat_logs, ("otel_logs",), "stream", **checks("logs_silver", quality.LOG_EXPECTATIONS))
    r.register("metrics_silver", flat_metrics, ("otel_metrics",), "stream", **checks("metrics_silver", quality.METRIC_EXPECTATIONS))
    r.register(
        "metrics_1min_rollup",
        lambda m: rollups.metrics_rollup(m, "1 minute", late(m, "metrics_1min_rollup")), ("metrics_silver",), "stream",
    )
    r.register(
        "histogram_metrics_1min_totals",
        lambda m: rollups.histogram_totals(m, "1 minute", late(m, "histogram_metrics_1min_totals")), ("metrics_silver",), "stream",
    )
    r.register(
        "histogram_metrics_1min_rollup",
        lambda m: rollups.histogram_rollup(m, "1 minute", as_of=as_of, parts=parts), ("metrics_silver",),
    )
    r.register(
        "service_health_silver",
        lambda s: health.service_health(s, "1 minute", late(s, "service_health_silver")), ("traces_silver",), "stream",
        **checks("service_health_silver", quality.HEALTH_EXPECTATIONS),
    )
    r.register(
        "traces_assembled", lambda s: traces.assemble_traces(s, as_of=as_of, parts=parts), ("traces_silver",),
        **checks("traces_assembled", quality.TRACE_EXPECTATIONS),
    )
    r.register("service_health_5min", lambda s: health.service_health_5min(s, as_of=as_of), ("traces_silver",))
    r.register(
        "service_health_hourly", lambda h: health.service_health_hourly(h, as_of=as_of), ("service_health_5min",)
    )
    r.register(
        "service_dependencies", lambda s: dependencies.service_dependencies(s, as_of=as_of), ("traces_silver",)
    )
    r.register("anomaly_baselines", lambda h: anomaly.anomaly_baselines(h, as_of=as_of), ("service_health_5min",))
    r.register(
        "metric_rollups_hourly", lambda m: rollups.metric_rollups_hourly(m, as_of=as_of), ("metrics_silver",)
    )
    # Streams of bounded state beside the lists: totals per window, and the rows they are made of.
    r.register("trace_totals", lambda s: traces.trace_totals(s, delay=late(s, "trace_totals")), ("traces_silver",), "stream")
    r.register("trace_details", traces.trace_details, ("traces_silver",), "stream")
    r.register("histogram_metrics_1min_points", rollups.distribution_points, ("metrics_silver",), "stream")
    r.register(
        "traces_assembled_windowed", lambda s: traces.assemble_traces_windowed(s, parts=parts, as_of=as_of), ("traces_silver",),
        **checks("traces_assembled_windowed", quality.TRACE_EXPECTATIONS),
    )
    r.register(
        "spans_wide_silver", lambda raw: flat_spans(raw, "spans_wide_silver", True), ("otel_spans",), "stream",
        **checks("spans_wide_silver", quality.SPAN_EXPECTATIONS),
    )
    r.register("logs_enriched", lambda lo, s: logs.enrich_logs(lo, s, dedup_spans=False), ("logs_silver", "spans_wide_silver"))
    r.register("service_health_daily", lambda h: health.service_health_daily(h, as_of=as_of), ("service_health_hourly",))
    r.register(
        "anomalies", lambda h, b: anomaly.detect_anomalies(h, b, alert_minutes, as_of, "p95_latency_ms"),
        ("service_health_5min", "anomaly_baselines"),
    )
    r.register("trace_completeness", lambda s: quality.validate_trace_completeness(s, as_of), ("traces_silver",))
    r.register("cross_signal_correlation", lambda s, lo: quality.validate_cross_signal(s, lo, as_of), ("traces_silver", "logs_silver"))
    r.register("service_health_quality", lambda h: quality.validate_service_health(h, as_of=as_of), ("service_health_silver",))
    return r


def build(
    spark: SparkSession,
    config: SourceConfig,
    names: Iterable[str] | None = None,
    as_of: Column | None = None,
    trigger: str = "availableNow",
    delays: dict[str, str | None] | None = None,
    checkpoints: str | None = None,
    parts: int = 1,
    actions: dict[str, str] | None = None,
    max_files: int | None = None,
) -> list[str]:
    """Bring datasets up to date in order, each from the written form of what it reads.

    Stream datasets append what is new since their checkpoint; batch datasets
    are recomputed. Tables lie below ``config.root`` or, without it, in the
    catalog that ``config`` names; stream checkpoints then need a folder of
    their own. With a processing-time ``trigger`` stream datasets run on, as
    queries of their names, and each has taken what there is before the next starts.

    Every dataset's expectations are counted as its rows pass by, and appended to the dataset
    ``expectation_results`` (``plans.checks``); a stream that runs on is counted by its own listener.
    ``max_files`` bounds what a stream takes into one micro-batch.
    """
    if checkpoints is None:
        if config.root is None:
            raise ValueError("a build into catalog tables needs a folder for checkpoints")
        checkpoints = f"{config.root}/_checkpoints"
    registry = datasets(as_of, delays, parts, actions)
    wanted = list(registry.datasets) if names is None else list(names)
    schemas: dict[str, StructType] = {}
    results: list[tuple] = []
    watch = StreamWatch().watch(spark)

    def place(name: str) -> str:
        return config.raw(RAW[name]) if name in RAW else config.table(name)

    def schema_of(name: str) -> StructType | str:
        return ddl(RAW[name]) if name in RAW else schemas.get(name) or read_table(spark, place(name)).schema

    try:
        for name in wanted:
            entry, target = registry.datasets[name], place(name)
            checked = Checked(entry)
            if entry.kind == "stream":
                reads = [valid_rows(read_stream(spark, place(r), schema_of(r), max_files)) for r in entry.reads]
                out = checked.watched(entry.make(*reads))
                query = run_stream(out, target, f"{checkpoints}/{name}", trigger, name=name, partition_by=checked.partition_by)
                schemas[name] = out.schema
                if trigger == "availableNow":
                    query.awaitTermination()
                    results += results_of(entry, watch.counts(query).observed.get(name), str(query.runId))
                else:
                    query.processAllAvailable()
            else:
                reads = [
                    valid_rows(read_table(spark, place(r), schema_of(r) if r in RAW or is_path(place(r)) else None)) for r in entry.reads
                ]
                out, taken = checked.observed(entry.make(*reads))
                write_table(out, target, partition_by=checked.partition_by)
                schemas[name] = out.schema
                results += results_of(entry, taken(), uuid.uuid4().hex)
    finally:
        watch.stop(spark)
    if results:
        write_table(spark.createDataFrame(results, RESULTS).withColumn("checked_at", now(as_of)), config.table("expectation_results"), "append")
    return wanted
