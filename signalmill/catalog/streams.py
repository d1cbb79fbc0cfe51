"""Streaming queries: each runs its stream over the whole table to the end and reads the sink.

An append stream emits a window only once the watermark has passed its end, so
the SQL leaves out what is still open when the table ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import columns as C
from ..operators import logs as L
from ..operators import metrics as M
from ..operators import rollups as R
from ..operators import traces as T
from ..operators.dedup import dedup
from ..operators.health import service_health
from ..operators.spans import flatten_spans
from ..session import tune, work_dir
from ..sinks import read_latest, upsert_latest
from ..sources import read_stream
from ..streaming import StreamWatch, amended, batches, run_stream, split_late, watermark, with_event_time, with_window
from . import adapters as A
from .book import cte, joined, query
from .health import H1_COLUMNS, RPS_SQL
from .logs import ENRICHED
from .metrics import DISTRIBUTION_COLUMNS, ROLLUP_COLUMNS, _distribution_texts
from .spans import FLAT_SQL


def stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    schema = A.table(spark, d, name).schema
    return read_stream(tune(spark), d, schema, max_files=100, files=f"{name}.parquet")


FILE_ROWS = 100_000  # a batch of more rows is several files, written and read side by side


def in_files(
    spark: SparkSession, df: DataFrame, order: str | Column, files: int = 6, folder: str | None = None,
    make: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[str, int]:
    """A folder with the rows of ``df`` in batches of ascending ``order``, and the number of files of each, for ``max_files``.

    A stream takes files by their age, so batches are written one after the other and have equally many files;
    one with too few rows for that gets empty ones. ``make`` is applied to the rows as they are written, after they
    were dealt to the files.
    """
    folder = folder or work_dir(spark, "in-files")
    at = F.col(order) if isinstance(order, str) else order
    low, high, rows = df.agg(F.min(at), F.max(at), F.count(at)).first()
    step, each, schema = (high - low) // files + 1, max(1, rows // files // FILE_ROWS), make(df).schema
    count = lambda: len(spark.read.schema(schema).parquet(folder).inputFiles())
    there = None
    for i in range(files):
        part = df.filter((at >= low + i * step) & (at < low + (i + 1) * step))
        make(part.coalesce(1) if each == 1 else part.repartition(each)).write.mode("append").parquet(folder)
        if each > 1:
            there, wanted = count(), each if there is None else there + each
            for _ in range(there, wanted):
                spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(folder)
            there = wanted
    return folder, each


def in_batches(spark: SparkSession, df: DataFrame, order: str, files: int = 6) -> DataFrame:
    """The rows of ``df`` as a stream of so many batches of ascending ``order``."""
    folder, each = in_files(spark, df, order, files)
    return read_stream(spark, folder, df.schema, max_files=each)


def drain(spark: SparkSession, df: DataFrame, name: str, each_batch: Callable | None = None) -> str:
    """Run a stream to the end of its input; returns the folder it wrote."""
    target = work_dir(spark, name)
    query = run_stream(df, target, f"{target}-checkpoint", each_batch=each_batch)
    query.awaitTermination()
    return target


def drained(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    schema = df.schema
    return spark.read.schema(schema).parquet(drain(spark, df, name))


def span_stream(spark, d, wide=False):
    return flatten_spans(A.spans_of(stream(spark, d, "events")), wide=wide)


CLOSED_SPANS = "(SELECT max(start_timestamp) FROM spans)"


@query("read_stream", f"SELECT {FLAT_SQL} FROM spans", uses=("spans",))
def _(spark, d):
    return drained(spark, span_stream(spark, d).drop("attributes", "events", "links"), "flat-spans")


@query(
    "stream_service_health",
    f"SELECT {H1_COLUMNS.format(rps=RPS_SQL)} FROM h1 WHERE window_end <= {CLOSED_SPANS} - INTERVAL 5 MINUTE",
    uses=("h1",),
)
def _(spark, d):
    return drained(spark, service_health(span_stream(spark, d), "1 minute", "5 minutes"), "health-stream")


@query(
    "stream_tumble",
    """SELECT window_start, window_end, event_type, n FROM (
       SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end,
              event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
    WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE""",
)
def _(spark, d):
    timed = with_event_time(stream(spark, d, "events"), "ts", "2 minutes")
    counted = timed.groupBy(F.window("ts", "1 hour").alias("window"), "event_type").agg(F.count("*").alias("n"))
    return drained(spark, C.unnest_window(counted), "tumble")


@query(
    "stream_assemble_traces",
    f"""SELECT trace_id, time_bucket(INTERVAL '5 minutes', start_timestamp) AS window_start, count(*) AS span_count,
       min(start_timestamp) AS trace_start, max(end_timestamp) AS trace_end,
       CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       coalesce(string_agg(DISTINCT service_name, ',' ORDER BY service_name), '') AS services_involved,
       string_agg(span_id, ',' ORDER BY span_id) AS span_ids
    FROM spans GROUP BY 1, 2
    HAVING time_bucket(INTERVAL '5 minutes', start_timestamp) + INTERVAL 5 MINUTE <= {CLOSED_SPANS} - INTERVAL 10 MINUTE""",
    uses=("spans",),
)
def _(spark, d):
    totals = drained(spark, T.trace_totals(span_stream(spark, d)), "totals-stream")
    details = drained(spark, T.trace_details(span_stream(spark, d)), "details-stream")
    out = T.with_span_lists(totals, details)
    return out.select(
        "trace_id", F.col("window.start").alias("window_start"), "span_count", "trace_start", "trace_end", "error_count",
        joined("services_involved").alias("services_involved"),
        F.array_join(F.transform("span_details", lambda s: s["span_id"]), ",").alias("span_ids"),
    )


# Every event is delivered twice; state is bounded by the watermark.
@query("stream_dedup", f"SELECT {FLAT_SQL} FROM spans", uses=("spans",))
def _(spark, d):
    twice = stream(spark, d, "events").withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    flat = flatten_spans(A.spans_of(twice)).drop("attributes", "events", "links")
    once = dedup(flat, ["trace_id", "span_id"], ("start_timestamp", "10 minutes"), within=True)
    return drained(spark, once, "dedup-stream")


@query(
    "stream_dedup_metrics",
    "SELECT DISTINCT name, service_name, metric_timestamp, metric_type FROM metrics",
    uses=("metrics",),
)
def _(spark, d):
    flat = M.flatten_metrics(A.metrics_of(stream(spark, d, "lineitem"))).select(*M.DEDUP_KEYS, "attributes")
    once = M.dedup_metrics(flat, "2 minutes", by_attributes=False).select(*M.DEDUP_KEYS)
    return drained(spark, once, "dedup-metrics-stream")


CLOSED_METRICS = "(SELECT max(metric_timestamp) FROM metrics WHERE metric_type IN ({types}))"


# A cascade: the rollup stream reads the table the flattening stream has written.
@query(
    "stream_metrics_rollup",
    f"""SELECT {ROLLUP_COLUMNS} FROM rollup1
    WHERE window_end <= {CLOSED_METRICS.format(types="'gauge', 'sum'")} - INTERVAL 30 SECOND""",
    uses=("rollup1",),
)
def _(spark, d):
    flat = M.flatten_metrics(A.metrics_of(stream(spark, d, "lineitem")))
    silver = drain(spark, flat, "metrics-silver")
    rollup = R.metrics_rollup(read_stream(spark, silver, flat.schema), "1 minute", "30 seconds")
    return drained(spark, rollup, "rollup-stream")


@query(
    "stream_histogram_rollup",
    f"""SELECT {DISTRIBUTION_COLUMNS} FROM distributions
    WHERE window_end <= {CLOSED_METRICS.format(types="'histogram', 'exponential_histogram', 'summary'")} - INTERVAL 30 SECOND""",
    uses=("distributions",),
    digits={"avg_value": 9},
)
def _(spark, d):
    flat = M.flatten_metrics(A.metrics_of(stream(spark, d, "lineitem")))
    totals = drained(spark, R.histogram_totals(flat, "1 minute", "30 seconds"), "histogram-stream")
    points = drained(spark, R.distribution_points(flat), "points-stream")
    out = _distribution_texts(R.with_point_lists(totals, points))
    return out.withColumn("buckets", F.array_join(F.array_sort("_buckets"), ";")).drop("_buckets")


STREAM_ENRICHED = """SELECT l.trace_id, l.span_id, l.log_timestamp, l.severity_text, l.body, l.service_name,
       l.service_version, s.name AS span_name, s.kind, s.http_url, s.http_method,
       CAST(s.http_status_code AS BIGINT) AS http_status_code
    FROM logs l LEFT JOIN spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id"""


@query("stream_enrich_logs", STREAM_ENRICHED, uses=("logs", "spans"))
def _(spark, d):
    logs = L.flatten_logs(A.logs_of(stream(spark, d, "events")), with_version=True)
    enriched = L.enrich_logs(logs, A.wide_spans(spark, d)).select(*ENRICHED)
    return drained(spark, enriched, "enrich-stream")


# Unmatched records come out once no span within the gap can arrive any more.
@query(
    "enrich_logs_streaming",
    STREAM_ENRICHED
    + f""" WHERE s.span_id IS NOT NULL
       OR l.log_timestamp < (SELECT min(t) FROM (SELECT max(start_timestamp) AS t FROM spans UNION ALL SELECT max(log_timestamp) FROM logs)) - INTERVAL 20 MINUTE""",
    uses=("logs", "spans"),
)
def _(spark, d):
    logs = L.flatten_logs(A.logs_of(stream(spark, d, "events")), with_version=True)
    enriched = L.enrich_logs_streaming(logs, span_stream(spark, d, wide=True)).select(*ENRICHED)
    return drained(spark, enriched, "enrich-both-stream")


# Five files, a batch each, of which each reads the written spans of its own time.
@query("stream_enrich_near", STREAM_ENRICHED, uses=("logs", "spans"))
def _(spark, d):
    spans, target = work_dir(spark, "near-spans"), work_dir(spark, "near-logs")
    A.wide_spans(spark, d).drop("attributes", "events", "links").write.parquet(spans)
    events = A.table(spark, d, "events")
    logs = L.flatten_logs(A.logs_of(in_batches(spark, events, "event_id", 5)), with_version=True)
    drain(spark, logs, "near-run", L.enrich_batches(target, spark.read.parquet(spans), "1 minute", "1 minute"))
    return spark.read.parquet(target).select(*ENRICHED)


# A gap below the distance of all records from their spans: the stream finds no context, the written tables have them all.
@query(
    "enrich_logs_filled",
    STREAM_ENRICHED
    + """ WHERE l.log_timestamp < (SELECT min(t) FROM (SELECT max(start_timestamp) AS t FROM spans UNION ALL SELECT max(log_timestamp) FROM logs))
       - INTERVAL 10 MINUTE""",
    uses=("logs", "spans"),
)
def _(spark, d):
    logs = L.flatten_logs(A.logs_of(stream(spark, d, "events")), with_version=True)
    spans = span_stream(spark, d, wide=True)
    enriched = drained(spark, L.enrich_logs_streaming(logs, spans, max_gap="1 millisecond").select(*ENRICHED), "enrich-near")
    return L.fill_contexts(enriched, drained(spark, spans, "wide-spans")).select(*ENRICHED)


@query(
    "stream_upsert_latest",
    """SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
       FROM events) WHERE r = 1""",
)
def _(spark, d):
    updates = stream(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    target, order = work_dir(spark, "latest-stream"), ["ts", "event_id"]
    drain(spark, updates, "latest-run", upsert_latest(target, ["user_id"], order))
    return read_latest(spark, target, ["user_id"], order)


# Deliveries out of order: events of a value above 90 come a third of the table later. Six files, a batch each;
# a file holds what is delivered in its sixth, and the watermark of a batch is that of the files before it.
FILES, LATE_BY = 6, 10
cte(
    "delivered",
    f"""SELECT e.*, first_id, step, (place - first_id) // step AS file FROM (
      SELECT event_id, event_id + CASE WHEN value > 90 THEN n // 3 ELSE 0 END AS place FROM events, (SELECT count(*) AS n FROM events)) p
    JOIN events e USING (event_id), (SELECT min(place) AS first_id, (max(place) - min(place)) // {FILES} + 1 AS step FROM (
      SELECT event_id + CASE WHEN value > 90 THEN n // 3 ELSE 0 END AS place FROM events, (SELECT count(*) AS n FROM events)))""",
)
cte("marks", f"""SELECT f.file, (SELECT max(ts) FROM delivered d WHERE d.file < f.file) - INTERVAL {LATE_BY} MINUTE AS mark
    FROM (SELECT DISTINCT file FROM delivered) f""", ("delivered",))  # fmt: skip
cte("late_events", "SELECT d.* FROM delivered d JOIN marks m ON m.file = d.file AND d.ts < m.mark", ("marks",))


def delivered(spark: SparkSession, d: str) -> DataFrame:
    """The stream of events in the order of delivery."""
    events = A.table(spark, d, "events")
    late_by = events.count() // 3
    placed = events.withColumn("place", F.col("event_id") + F.when(F.col("value") > 90, F.lit(late_by)).otherwise(F.lit(0)))
    placed = placed.withColumn("ts", F.col("ts").cast("timestamp"))
    return in_batches(spark, placed, "place", FILES)


def split(spark: SparkSession, d: str) -> tuple[str, str, str, DataFrame]:
    """Folders of on-time rows, late rows and marks after the whole stream, and its schema's frame."""
    root, stream = work_dir(spark, "split"), delivered(spark, d)
    folders = [f"{root}/{n}" for n in ("on-time", "late", "marks")]
    drain(spark, stream, "split-run", split_late(*folders, "ts", f"{LATE_BY} minutes"))
    return (*folders, stream)


@query("stream_late_rows", "SELECT event_id, ts, user_id, event_type, value, props FROM late_events", uses=("late_events",))
def _(spark, d):
    _, late, _, stream = split(spark, d)
    return spark.read.schema(stream.schema).parquet(batches(late)).drop("place")


# The stream of totals reads the on-time rows and drops none; windows that late rows touch are made again. Totals
# and lists then hold the same spans.
@query(
    "stream_amended_totals",
    f"""SELECT trace_id, time_bucket(INTERVAL '5 minutes', start_timestamp) AS window_start, count(*) AS span_count,
       CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count, max(duration_ms) AS max_span_duration_ms,
       string_agg(span_id, ',' ORDER BY span_id) AS span_ids, count(*) AS listed, CAST(0 AS BIGINT) AS dropped
    FROM spans GROUP BY 1, 2
    HAVING time_bucket(INTERVAL '5 minutes', start_timestamp) + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL {LATE_BY} MINUTE""",
    uses=("spans",),
)
def _(spark, d):
    on_time, late, marks, stream = split(spark, d)
    spans = lambda df: with_window(flatten_spans(A.spans_of(df)), "start_timestamp", "5 minutes")
    kept = read_stream(spark, batches(on_time), stream.schema, max_files=8)
    watch = StreamWatch().watch(spark)
    try:
        target = work_dir(spark, "late-totals")
        totals = T.trace_totals(flatten_spans(A.spans_of(kept)), delay=f"{LATE_BY} minutes")
        run = run_stream(totals, target, f"{target}-checkpoint")
        run.awaitTermination()
        dropped = watch.counts(run).late_rows
    finally:
        watch.stop(spark)
    read = lambda folder: spans(spark.read.schema(stream.schema).parquet(batches(folder)))
    every = read(on_time).unionByName(read(late))
    closed = F.col("window.end") <= watermark(spark, marks, f"{LATE_BY} minutes")
    whole = amended(
        spark.read.schema(totals.schema).parquet(target), every, read(late), ["trace_id", "window"],
        lambda df: T.trace_totals(df.drop("window"), delay=None), closed,
    )
    out = T.with_span_lists(whole, T.trace_details(every.drop("window")))
    return out.select(
        "trace_id", F.col("window.start").alias("window_start"), "span_count", "error_count", "max_span_duration_ms",
        F.array_join(F.transform("span_details", lambda s: s["span_id"]), ",").alias("span_ids"),
        F.size("span_details").cast("bigint").alias("listed"), F.lit(dropped).cast("bigint").alias("dropped"),
    )


# Without the split, a stateful operator drops late rows: those behind the watermark that the batch before began with.
# The listener's counts are of all batches.
@query(
    "stream_late_counts",
    f"""SELECT (SELECT count(*) FROM events) AS input_rows, count(*) AS late_rows, CAST({FILES} AS BIGINT) AS files
    FROM delivered d JOIN marks m ON m.file = d.file - 1 AND d.ts < m.mark""",
    uses=("marks",),
)
def _(spark, d):
    watch = StreamWatch().watch(spark)
    try:
        target = work_dir(spark, "late-counts")
        once = delivered(spark, d).withWatermark("ts", f"{LATE_BY} minutes").dropDuplicates(["event_id", "ts"])
        run = run_stream(once, target, f"{target}-checkpoint")
        run.awaitTermination()
        watch.counts(run)
        seen = watch.take(spark).filter(F.col("run_id") == str(run.runId))
    finally:
        watch.stop(spark)
    return seen.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), F.count_if(F.col("input_rows") > 0).alias("files"))


# Eight files, a batch each; the sink folds with every third batch, so a read takes one fold and two batches.
@query(
    "stream_upsert_folded",
    """SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
       FROM events) WHERE r = 1""",
)
def _(spark, d):
    updates = A.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    stream = in_batches(spark, updates, "event_id", 8)
    target, order = work_dir(spark, "folded-stream"), ["ts", "event_id"]
    drain(spark, stream, "folded-run", upsert_latest(target, ["user_id"], order, fold_every=3))
    return read_latest(spark, target, ["user_id"], order)


# Half of the files, a stop, the other half with copies of the first: the second run goes on from the checkpoint, knows
# the first run's keys, and repeats nothing.
@query("stream_restart", f"SELECT {FLAT_SQL}, CAST(2 AS BIGINT) AS runs FROM spans", uses=("spans",))
def _(spark, d):
    events, folder, target = A.table(spark, d, "events"), work_dir(spark, "restart-in"), work_dir(spark, "restart")
    half = events.count() // 2
    runs = 0
    for part in (events.filter(F.col("event_id") < half), events.filter(F.col("event_id") >= half - half // 4)):
        _, each = in_files(spark, part, "event_id", 2, folder)
        flat = flatten_spans(A.spans_of(read_stream(spark, folder, events.schema, max_files=each))).drop("attributes", "events", "links")
        once = dedup(flat, ["trace_id", "span_id"], ("start_timestamp", "30 days"), within=True)
        run_stream(once, target, f"{target}-checkpoint").awaitTermination()
        runs += 1
    return spark.read.schema(once.schema).parquet(target).withColumn("runs", F.lit(runs))


# A stream that runs on takes files as they come, and is stopped when it has them all.
@query("stream_continuous", f"SELECT {FLAT_SQL} FROM spans", uses=("spans",))
def _(spark, d):
    events, folder, target = A.table(spark, d, "events"), work_dir(spark, "continuous-in"), work_dir(spark, "continuous")
    half = events.count() // 2
    in_files(spark, events.filter(F.col("event_id") < half), "event_id", 1, folder)
    flat = flatten_spans(A.spans_of(read_stream(spark, folder, events.schema))).drop("attributes", "events", "links")
    run = run_stream(flat, target, f"{target}-checkpoint", trigger="200 milliseconds")
    try:
        run.processAllAvailable()
        in_files(spark, events.filter(F.col("event_id") >= half), "event_id", 1, folder)
        run.processAllAvailable()
    finally:
        run.stop()
    return spark.read.schema(flat.schema).parquet(target)
