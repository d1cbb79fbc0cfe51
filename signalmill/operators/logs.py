"""Raw log records to flat rows, and their enrichment with span context."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from .dedup import dedup

# Keys and columns of the log tables.
DEDUP_KEYS = ["observed_timestamp", "trace_id", "span_id", "body"]
# The narrower key of tables that are enriched before they are deduplicated.
ENRICHED_DEDUP_KEYS = ["observed_timestamp", "service_name", "body"]

FLAT = [
    "log_key", "event_name", "trace_id", "span_id", "log_timestamp", "observed_timestamp",
    "severity_number", "severity_text", "body", "service_name", "attributes", "ingestion_timestamp",
]

def flatten_logs(
    raw: DataFrame,
    precision: str = "micro",
    as_of: Column | None = None,
    with_version: bool = False,
    resolve_trace: bool = False,
) -> DataFrame:
    """Flat log records with a stable key; ``resolve_trace`` looks for the trace id in attributes too."""
    trace_id = C.resolve_trace_id() if resolve_trace else C.blank_to_null(F.col("trace_id"))
    observed = C.nanos_to_ts(F.col("observed_time_unix_nano"), precision)
    parts = {
        "trace_id": trace_id,
        "log_timestamp": C.nanos_to_ts(F.col("time_unix_nano"), precision),
        "observed_timestamp": observed,
        "log_key": C.log_key(observed, trace_id, F.col("span_id"), F.col("body")),
        "service_name": C.res_attr("service.name"),
        "service_version": C.res_attr("service.version"),
        "ingestion_timestamp": C.now(as_of),
    }
    names = FLAT[:-2] + (["service_version"] if with_version else []) + FLAT[-2:]
    return raw.select(*[parts[n].alias(n) if n in parts else F.col(n) for n in names])


def span_context(wide_spans: DataFrame) -> DataFrame:
    """The span columns a log record is enriched with."""
    return wide_spans.select(
        "trace_id", "span_id", F.col("name").alias("span_name"), "kind", "http_url", "http_method",
        "http_status_code",
    )


def _with_join_keys(logs: DataFrame) -> DataFrame:
    # A left join sends all rows with a NULL key to one task. Such rows match
    # nothing, so they get keys that no span has and that spread them.
    loose = F.col("trace_id").isNull() | F.col("span_id").isNull()
    nowhere = F.concat(F.lit("\u0000"), F.xxhash64("observed_timestamp", "body", "service_name").cast("string"))
    return logs.withColumns(
        {
            "_trace_id": F.when(loose, nowhere).otherwise(F.col("trace_id")),
            "_span_id": F.when(loose, F.lit("")).otherwise(F.col("span_id")),
        }
    )


def enrich_logs(logs: DataFrame, wide_spans: DataFrame, dedup_spans: bool = True) -> DataFrame:
    """Left join of log records to the span they were written in.

    Takes a batch or a stream of logs; the spans are a batch table. Repeated
    spans are reduced first, so that a log record stays one row; pass
    ``dedup_spans=False`` for a table that has none, which saves that shuffle.
    The key is packed after this step, so that both inputs of the join come
    straight from a shuffle: a span with very many records is then a skewed
    partition that Spark splits.
    """
    context = span_context(wide_spans)
    if dedup_spans:
        context = dedup(context, ["trace_id", "span_id"])
    context = context.withColumn("_span", F.struct("trace_id", "span_id")).drop("trace_id", "span_id")
    keyed = _with_join_keys(logs)
    key = F.struct(F.col("_trace_id").alias("trace_id"), F.col("_span_id").alias("span_id"))
    return keyed.withColumn("_span", key).join(context, "_span", "left").drop("_span", "_trace_id", "_span_id")


def enrich_logs_streaming(
    logs: DataFrame, wide_spans: DataFrame, delay: str = "10 minutes", max_gap: str = "10 minutes"
) -> DataFrame:
    """The same with both sides streamed, so that a span may arrive after its log.

    A span is looked for within ``max_gap`` around the log time; that bound,
    with the watermarks, is what lets Spark drop state and emit unmatched rows.
    Records in spans that began earlier come out without context; ``fill_contexts``
    gives it to them from the written tables.
    """
    context = wide_spans.select(
        F.col("trace_id").alias("_span_trace_id"),
        F.col("span_id").alias("_span_span_id"),
        F.col("start_timestamp").alias("span_start"),
        F.col("name").alias("span_name"),
        "kind", "http_url", "http_method", "http_status_code",
    ).withWatermark("span_start", delay)
    gap = F.expr(f"INTERVAL {max_gap}")
    near = (
        (F.col("_trace_id") == F.col("_span_trace_id"))
        & (F.col("_span_id") == F.col("_span_span_id"))
        & (F.col("span_start") >= F.col("log_timestamp") - gap)
        & (F.col("span_start") <= F.col("log_timestamp") + gap)
    )
    keyed = _with_join_keys(logs.withWatermark("log_timestamp", delay))
    return keyed.join(context, near, "left").drop("_trace_id", "_span_id", "_span_trace_id", "_span_span_id")


# What a log record takes over from its span.
CONTEXT = ["span_name", "kind", "http_url", "http_method", "http_status_code"]


def fill_contexts(enriched: DataFrame, wide_spans: DataFrame) -> DataFrame:
    """Written rows of ``enrich_logs_streaming``, with the contexts that lay beyond its gap.

    Only rows that name a span and have no context are joined, with all written spans (each once), so
    whatever the gap was, the result is that of ``enrich_logs``.
    """
    lost = F.col("span_name").isNull() & F.col("trace_id").isNotNull() & F.col("span_id").isNotNull()
    key = F.struct("trace_id", "span_id").alias("_span")
    context = span_context(wide_spans).select(key, *CONTEXT)
    again = enriched.filter(lost).drop(*CONTEXT).withColumn("_span", key).join(context, "_span", "left").drop("_span")
    return enriched.filter(~lost).unionByName(again.select(*enriched.columns))


def near_spans(spans: DataFrame, logs: DataFrame, before: str = "1 hour", after: str = "10 minutes") -> DataFrame:
    """Spans that start from ``before`` the first log record on until ``after`` the last: bounds on the bare start, which reach the scan."""
    first, last = logs.agg(F.min("log_timestamp"), F.max("log_timestamp")).first()
    if first is None:
        return spans.limit(0)
    since, until = F.lit(first) - F.expr(f"INTERVAL {before}"), F.lit(last) + F.expr(f"INTERVAL {after}")
    return spans.filter((F.col("start_timestamp") >= since) & (F.col("start_timestamp") <= until))


def enrich_batches(target: str, wide_spans: DataFrame, before: str = "1 hour", after: str = "10 minutes") -> Callable[[DataFrame, int], None]:
    """For ``run_stream``: enriches each micro-batch from a span table without repeats, of which it reads the batch's time alone.

    A batch that is run again replaces its folder (``batch=n``). Records in spans that lie outside come out
    without context, for ``fill_contexts``.
    """

    def one(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            near = near_spans(wide_spans, batch, before, after)
            enrich_logs(batch, near, dedup_spans=False).write.mode("overwrite").parquet(f"{target}/batch={number}")
        finally:
            batch.unpersist()

    return one


def trace_id_profile(logs: DataFrame) -> DataFrame:
    """How many records carry a trace id, overall."""
    return logs.agg(
        F.count("*").alias("total_logs"),
        F.count("trace_id").alias("logs_with_trace_id"),
        F.try_divide(F.count("trace_id") * F.lit(100.0), F.count("*")).alias("percentage"),
    )


def trace_id_lengths(logs: DataFrame) -> DataFrame:
    """Records per trace-id length; more than one length means mixed formats."""
    return (
        logs.filter(F.col("trace_id").isNotNull())
        .groupBy(F.length("trace_id").alias("trace_id_length"))
        .agg(F.count("*").alias("log_count"))
    )


def trace_log_counts(logs: DataFrame, k: int = 10) -> DataFrame:
    """The trace ids with the most records."""
    return (
        logs.filter(F.col("trace_id").isNotNull())
        .groupBy("trace_id", F.length("trace_id").alias("trace_id_length"))
        .agg(F.count("*").alias("log_count"))
        .orderBy(F.desc("log_count"), "trace_id")
        .limit(k)
    )


def log_error_patterns(logs: DataFrame, severity: str = "severity_text", word: str = "error") -> DataFrame:
    """Records by severity and by whether the whole body holds the keyword."""
    return (
        logs.groupBy(F.col(severity).alias("severity"), F.col("body").contains(word).alias("has_error_keyword"))
        .agg(F.count("*").alias("log_count"))
        .orderBy(F.desc("log_count"), "severity", "has_error_keyword")
    )
