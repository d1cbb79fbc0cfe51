"""Span queries: flattening, duplicates, assembly, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..operators import traces
from ..operators.dedup import dedup
from ..operators.serving import sample, trace_lookup
from ..operators.spans import flatten_spans
from . import adapters as A
from .book import cte, joined, query

FLAT_SQL = """trace_id, span_id, parent_span_id, name, kind, service_name, start_timestamp, end_timestamp,
       round(duration_ms, 6) AS duration_ms, is_error, status_message"""


@query(
    "flatten_spans",
    f"""SELECT {FLAT_SQL}, http_route, CAST(CASE WHEN duration_ms > 100 THEN 1 ELSE 0 END AS BIGINT) AS event_count
    FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    flat = flatten_spans(A.raw_spans(spark, d))
    return flat.select(
        *[c for c in flat.columns if c not in ("attributes", "events", "links")],
        C.attr("http.route").alias("http_route"),
        F.coalesce(F.size("events"), F.lit(0)).alias("event_count"),
    )


@query(
    "flatten_spans_wide",
    f"""SELECT {FLAT_SQL}, service_version, 'python' AS telemetry_sdk_language,
       'opentelemetry' AS telemetry_sdk_name, '1.30' AS telemetry_sdk_version, http_method,
       CAST(http_status_code AS BIGINT) AS http_status_code, http_url, http_target, rpc_service,
       'Call' AS rpc_method, CAST(rpc_grpc_status_code AS BIGINT) AS rpc_grpc_status_code,
       'demo' AS instrumentation_scope_name, '0.1' AS instrumentation_scope_version
    FROM spans""",
    uses=("spans",),
)
def _(spark, d):
    return A.wide_spans(spark, d).drop("attributes", "events", "links")


@query(
    "nanos_to_ts",
    """SELECT event_id, ts AS micros, date_trunc('second', ts) AS seconds, round(value, 6) AS duration FROM events""",
)
def _(spark, d):
    start = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 999
    end = start + F.round(F.col("value") * 1e6).cast("bigint")
    return A.table(spark, d, "events").select(
        "event_id",
        C.nanos_to_ts(start).alias("micros"),
        C.nanos_to_ts(start, "second").alias("seconds"),
        C.duration_ms(start, end).alias("duration"),
    )


# At-least-once delivery: error events arrive twice.
@query("dedup_spans", f"SELECT {FLAT_SQL} FROM spans", uses=("spans",))
def _(spark, d):
    once = A.table(spark, d, "events")
    twice = once.unionByName(once.filter("event_type = 'error'"))
    flat = flatten_spans(A.spans_of(twice))
    return dedup(flat, ["trace_id", "span_id"]).drop("attributes", "events", "links")


@query(
    "dedup",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice, 6) AS l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1""",
)
def _(spark, d):
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    rows = dedup(A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "find_duplicates",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS duplicate_count
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, d):
    return P.find_duplicates(A.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


ASSEMBLED = """
  SELECT trace_id, count(*) AS span_count, min(start_timestamp) AS trace_start, max(end_timestamp) AS trace_end,
         round((epoch_us(max(end_timestamp)) - epoch_us(min(start_timestamp))) / 1000.0, 6) AS total_trace_duration_ms,
         list_sort(list(DISTINCT service_name) FILTER (service_name IS NOT NULL)) AS services,
         CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
         round(max(duration_ms), 6) AS max_span_duration_ms, round(avg(duration_ms), 6) AS avg_span_duration_ms,
         list_sort(list(span_id)) AS span_ids
  FROM spans GROUP BY trace_id"""
cte("assembled", ASSEMBLED, ("spans",))

ASSEMBLED_COLUMNS = """span_count, trace_start, trace_end, total_trace_duration_ms,
       coalesce(array_to_string(services, ','), '') AS services_involved, CAST(len(coalesce(services, [])) AS BIGINT) AS service_count, error_count, error_count > 0 AS has_errors,
       max_span_duration_ms, avg_span_duration_ms"""


@query(
    "assemble_traces",
    f"""SELECT trace_id, CAST(0 AS BIGINT) AS part, {ASSEMBLED_COLUMNS},
       array_to_string(span_ids, ',') AS span_details FROM assembled""",
    uses=("assembled",),
)
def _(spark, d):
    out = traces.assemble_traces(A.spans(spark, d), "40 DAYS", A.as_of())
    ids = F.transform("span_details", lambda s: s["span_id"])
    return out.withColumns({"services_involved": joined("services_involved"), "span_details": F.array_join(ids, ",")})


# The same with three rows for every trace: parts are put together again, so
# the result shows that totals are those of the whole and nothing is lost.
@query(
    "assemble_traces_in_parts",
    f"""SELECT trace_id, {ASSEMBLED_COLUMNS}, span_count AS listed_spans,
       array_to_string(span_ids, ',') AS span_ids FROM assembled""",
    uses=("assembled",),
)
def _(spark, d):
    out = traces.assemble_traces(A.spans(spark, d), "40 DAYS", A.as_of(), parts=3)
    out = out.withColumn("services_involved", joined("services_involved")).drop("ingestion_timestamp")
    scalars = [c for c in out.columns if c not in ("part", "span_details")]
    ids = F.flatten(F.collect_list(F.transform("span_details", lambda s: s["span_id"])))
    return out.groupBy(*scalars).agg(
        F.sum(F.size("span_details")).alias("listed_spans"), F.array_join(F.array_sort(ids), ",").alias("span_ids")
    )


@query("trace_summaries", f"SELECT trace_id, {ASSEMBLED_COLUMNS} FROM assembled", uses=("assembled",))
def _(spark, d):
    out = traces.trace_summaries(A.spans(spark, d))
    return out.withColumn("services_involved", joined("services_involved"))


@query(
    "assemble_traces_windowed",
    """SELECT trace_id, time_bucket(INTERVAL '5 minutes', start_timestamp) AS window_start,
       time_bucket(INTERVAL '5 minutes', start_timestamp) + INTERVAL 5 MINUTES AS window_end,
       count(*) AS span_count, min(start_timestamp) AS trace_start, max(end_timestamp) AS trace_end,
       CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       CAST(count(DISTINCT service_name) AS BIGINT) AS service_count,
       round(avg(duration_ms), 6) AS avg_span_duration_ms,
       string_agg(span_id, ',' ORDER BY span_id) AS span_ids
    FROM spans GROUP BY 1, 2, 3""",
    uses=("spans",),
)
def _(spark, d):
    out = C.unnest_window(traces.assemble_traces_windowed(A.spans(spark, d)))
    return out.select(
        "trace_id", "window_start", "window_end", "span_count", "trace_start", "trace_end", "error_count",
        "service_count", "avg_span_duration_ms",
        F.array_join(F.transform("span_details", lambda s: s["span_id"]), ",").alias("span_ids"),
    )


@query(
    "trace_spans",
    "SELECT span_id, name, round(duration_ms, 6) AS duration_ms, CAST(http_status_code AS BIGINT) AS http_status_code, start_timestamp FROM spans WHERE trace_id = 't42'",
    uses=("spans",),
)
def _(spark, d):
    return P.trace_spans(A.wide_spans(spark, d), "t42").select(
        "span_id", "name", "duration_ms", "http_status_code", "start_timestamp"
    )


@query(
    "trace_lookup",
    f"SELECT trace_id, {ASSEMBLED_COLUMNS} FROM assembled WHERE trace_id = 't42'",
    uses=("assembled",),
)
def _(spark, d):
    found = trace_lookup(traces.assemble_traces(A.spans(spark, d), None), "t42")
    return found.withColumn("services_involved", joined("services_involved")).drop("part", "span_details")


@query("lookback", f"SELECT {FLAT_SQL} FROM spans WHERE start_timestamp >= {A.AS_OF_SQL} - INTERVAL 7 DAY", uses=("spans",))
def _(spark, d):
    return P.lookback(A.spans(spark, d), "start_timestamp", "7 DAYS", A.as_of()).drop("attributes", "events", "links")


@query("roots", "SELECT trace_id, span_id, kind FROM spans WHERE parent_span_id IS NULL", uses=("spans",))
def _(spark, d):
    return P.roots(A.spans(spark, d)).select("trace_id", "span_id", "kind")


@query("children", "SELECT trace_id, span_id, parent_span_id FROM spans WHERE parent_span_id IS NOT NULL", uses=("spans",))
def _(spark, d):
    return P.children(A.spans(spark, d)).select("trace_id", "span_id", "parent_span_id")


@query("distinct_ids", "SELECT DISTINCT trace_id FROM spans", uses=("spans",))
def _(spark, d):
    from ..operators.serving import distinct_ids

    return distinct_ids(A.spans(spark, d), "trace_id")


# Which rows a plain limit returns is free, so only their number is compared.
@query("sample", "SELECT count(*) AS sampled FROM (SELECT * FROM spans LIMIT 20)", uses=("spans",))
def _(spark, d):
    return sample(A.spans(spark, d), 20).agg(F.count("*").alias("sampled"))


# An estimate has no exact SQL: compared are the exact counts, and that the estimate is within three deviations of them.
@query(
    "unique_traces_approx",
    "SELECT service_name, count(DISTINCT trace_id) AS exact_count, true AS estimate_is_close FROM spans GROUP BY 1",
    uses=("spans",),
)
def _(spark, d):
    spans, rsd = A.spans(spark, d), 0.05
    exact = spans.groupBy(F.col("service_name").alias("_service")).agg(F.countDistinct("trace_id").alias("exact_count"))
    both = traces.unique_traces_approx(spans, rsd).join(exact, F.col("service_name").eqNullSafe(F.col("_service")))
    close = F.abs(F.col("trace_count") - F.col("exact_count")) <= 3 * rsd * F.col("exact_count")
    return both.select("service_name", "exact_count", close.alias("estimate_is_close"))
