"""Log queries: flattening, enrichment, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..operators import logs as L
from ..operators.dedup import dedup
from . import adapters as A
from .book import query

FLAT_SQL = """event_name, trace_id, span_id, log_timestamp, observed_timestamp, severity_number, severity_text,
       body, service_name"""


# All columns: what survives is a whole record.
WHOLE = [c.strip() for c in FLAT_SQL.split(",")] + ["service_version"]
LOG_KEY_SQL = """md5(concat_ws('||', CAST(epoch_us(observed_timestamp) AS VARCHAR),
       coalesce(trace_id, ''), coalesce(span_id, ''), coalesce(body, ''))) AS log_key"""


@query("flatten_logs", f"SELECT {FLAT_SQL}, service_version, {LOG_KEY_SQL} FROM logs", uses=("logs",))
def _(spark, d):
    flat = L.flatten_logs(A.raw_logs(spark, d), with_version=True)
    return flat.drop("attributes")


@query("log_key", f"SELECT trace_id, span_id, {LOG_KEY_SQL} FROM logs", uses=("logs",))
def _(spark, d):
    key = C.log_key(F.col("observed_timestamp"), F.col("trace_id"), F.col("span_id"), F.col("body"))
    return A.logs(spark, d).select("trace_id", "span_id", key.alias("log_key"))


@query(
    "dedup_logs",
    f"SELECT DISTINCT {FLAT_SQL}, service_version FROM logs",
    uses=("logs",),
)
def _(spark, d):
    once = A.table(spark, d, "events")
    twice = once.unionByName(once.filter("event_type = 'view'"))
    return dedup(L.flatten_logs(A.logs_of(twice), with_version=True), L.DEDUP_KEYS).select(*WHOLE)


@query(
    "dedup_logs_narrow",
    f"SELECT DISTINCT {FLAT_SQL}, service_version FROM logs",
    uses=("logs",),
)
def _(spark, d):
    once = A.table(spark, d, "events")
    twice = once.unionByName(once.filter("event_type = 'click'"))
    return dedup(L.flatten_logs(A.logs_of(twice), with_version=True), L.ENRICHED_DEDUP_KEYS).select(*WHOLE)


ENRICHED_SQL = """SELECT l.trace_id, l.span_id, l.log_timestamp, l.severity_text, l.body, l.service_name,
       l.service_version, s.name AS span_name, s.kind, s.http_url, s.http_method,
       CAST(s.http_status_code AS BIGINT) AS http_status_code
    FROM logs l LEFT JOIN spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id"""
ENRICHED = [
    "trace_id", "span_id", "log_timestamp", "severity_text", "body", "service_name", "service_version",
    "span_name", "kind", "http_url", "http_method", "http_status_code",
]


@query("enrich_logs", ENRICHED_SQL, uses=("logs", "spans"))
def _(spark, d):
    flat = L.flatten_logs(A.raw_logs(spark, d), with_version=True)
    return L.enrich_logs(flat, A.wide_spans(spark, d)).select(*ENRICHED)


@query(
    "resolve_trace_id",
    """SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN 't' || (event_id // 8)
              WHEN event_type = 'view' THEN 'attr-' || user_id
              WHEN user_id % 50 <> 0 THEN 'res-' || user_id END AS trace_id FROM events""",
)
def _(spark, d):
    e = A.table(spark, d, "events")
    shaped = e.select(
        "event_id",
        F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("t"), F.expr("event_id div 8"))).alias("trace_id"),
        F.create_map(
            F.lit("trace_id"), F.when(F.col("event_type") == "view", F.concat(F.lit("attr-"), "user_id"))
        ).alias("attributes"),
        F.struct(
            F.create_map(
                F.lit("trace_id"), F.when(F.col("user_id") % 50 != 0, F.concat(F.lit("res-"), "user_id"))
            ).alias("attributes")
        ).alias("resource"),
    )
    return shaped.select("event_id", C.resolve_trace_id().alias("trace_id"))


@query(
    "trace_logs",
    "SELECT log_timestamp, severity_text, body, service_name FROM logs WHERE trace_id = 't42'",
    uses=("logs",),
)
def _(spark, d):
    return P.trace_logs(A.logs(spark, d), "t42").select("log_timestamp", "severity_text", "body", "service_name")


@query("body_matches", "SELECT log_timestamp, body FROM logs WHERE body LIKE '%error%'", uses=("logs",))
def _(spark, d):
    return P.body_matches(A.logs(spark, d), "error").select("log_timestamp", "body")


@query(
    "body_matches_documents",
    "SELECT doc_id, source FROM documents WHERE contains(text, 'th')",
)
def _(spark, d):
    documents = A.table(spark, d, "documents").withColumnRenamed("text", "body")
    return P.body_matches(documents, "th").select("doc_id", "source")


@query(
    "log_error_patterns",
    """SELECT severity_text AS severity, body LIKE '%error%' AS has_error_keyword, count(*) AS log_count
    FROM logs GROUP BY ALL""",
    uses=("logs",),
)
def _(spark, d):
    return L.log_error_patterns(A.logs(spark, d))


@query(
    "log_error_patterns_documents",
    """SELECT source AS severity, text LIKE '%the%' AS has_error_keyword, count(*) AS log_count
    FROM documents GROUP BY ALL""",
)
def _(spark, d):
    documents = A.table(spark, d, "documents").withColumnRenamed("text", "body")
    return L.log_error_patterns(documents, "source", "the")


@query(
    "trace_id_profile",
    """SELECT count(*) AS total_logs, count(trace_id) AS logs_with_trace_id,
       round(count(trace_id) * 100.0 / count(*), 6) AS percentage FROM logs""",
    uses=("logs",),
)
def _(spark, d):
    return L.trace_id_profile(A.logs(spark, d))


@query(
    "trace_id_lengths",
    """SELECT CAST(length(trace_id) AS BIGINT) AS trace_id_length, count(*) AS log_count
    FROM logs WHERE trace_id IS NOT NULL GROUP BY 1""",
    uses=("logs",),
)
def _(spark, d):
    return L.trace_id_lengths(A.logs(spark, d))


@query(
    "trace_log_counts",
    """SELECT trace_id, CAST(length(trace_id) AS BIGINT) AS trace_id_length, count(*) AS log_count
    FROM logs WHERE trace_id IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""",
    uses=("logs",),
)
def _(spark, d):
    return L.trace_log_counts(A.logs(spark, d))
