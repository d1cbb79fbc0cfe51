"""Call-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dependencies as D
from ..operators import traces as T
from . import adapters as A
from .book import cte, joined, query

cte(
    "edges",
    """SELECT p.service_name AS source_service, c.service_name AS target_service, c.trace_id, c.span_id,
       c.parent_span_id, c.start_timestamp AS call_timestamp, p.start_timestamp AS parent_timestamp, c.duration_ms, c.is_error
    FROM spans c JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id""",
    ("spans",),
)
cte(
    "deps",
    """SELECT source_service, target_service, count(*) AS call_count, count(DISTINCT trace_id) AS unique_traces,
       min(call_timestamp) AS first_seen, max(call_timestamp) AS last_seen, avg(duration_ms) AS avg_duration_ms,
       count(*) FILTER (is_error) AS error_count,
       greatest((SELECT max(start_timestamp) FROM spans WHERE service_name = source_service),
                (SELECT max(start_timestamp) FROM spans WHERE service_name = target_service)) AS last_active
    FROM edges GROUP BY source_service, target_service""",
    ("edges",),
)
DEPS = "source_service, target_service, call_count, unique_traces, first_seen, last_seen, last_active"


def deps(spark, d, **options):
    return D.service_dependencies(A.spans(spark, d), "90 DAYS", A.as_of(), **options)


@query(
    "span_edges",
    "SELECT source_service, target_service, trace_id, span_id, parent_span_id, call_timestamp, parent_timestamp FROM edges",
    uses=("edges",),
)
def _(spark, d):
    return T.span_edges(A.spans(spark, d)).drop("duration_ms", "is_error")


@query("span_edges_count", "SELECT count(*) AS potential_dependencies FROM edges", uses=("edges",))
def _(spark, d):
    return T.span_edges(A.spans(spark, d)).agg(F.count("*").alias("potential_dependencies"))


@query(
    "span_edges_asymmetric",
    f"""SELECT source_service, target_service, trace_id, span_id FROM edges
    WHERE call_timestamp >= {A.AS_OF_SQL} - INTERVAL 7 DAY AND parent_timestamp >= {A.AS_OF_SQL} - INTERVAL 30 DAY""",
    uses=("edges",),
)
def _(spark, d):
    edges = T.span_edges(A.spans(spark, d), "7 DAYS", "30 DAYS", A.as_of())
    return edges.select("source_service", "target_service", "trace_id", "span_id")


@query("edges_per_trace", "SELECT source_service, target_service, trace_id, count(*) AS span_count FROM edges GROUP BY ALL", uses=("edges",))
def _(spark, d):
    return T.edges_per_trace(A.spans(spark, d))


@query("service_dependencies", f"SELECT {DEPS} FROM deps", uses=("deps",))
def _(spark, d):
    return deps(spark, d)


@query(
    "service_dependencies_stats",
    f"SELECT {DEPS}, round(avg_duration_ms, 9) AS avg_duration_ms, error_count FROM deps",
    uses=("deps",),
    digits={"avg_duration_ms": 9},
)
def _(spark, d):
    return deps(spark, d, with_stats=True)


@query("call_counts", "SELECT source_service, target_service, call_count FROM deps", uses=("deps",))
def _(spark, d):
    return D.call_counts(A.spans(spark, d))


@query("service_activity", "SELECT service_name, max(start_timestamp) AS service_last_active FROM spans GROUP BY 1", uses=("spans",))
def _(spark, d):
    return D.service_activity(A.spans(spark, d))


@query(
    "edge_split",
    """SELECT CASE WHEN source_service = target_service THEN 'same_service' ELSE 'cross_service' END AS call_type,
       count(*) AS call_count, count(DISTINCT trace_id) AS unique_traces FROM edges GROUP BY 1""",
    uses=("edges",),
)
def _(spark, d):
    return T.edge_split(A.spans(spark, d))


@query(
    "infer_dependencies",
    """SELECT source_service, target_service, count(*) AS trace_count FROM (
       SELECT trace_id, service_name AS source_service,
              lead(service_name) OVER (PARTITION BY trace_id ORDER BY first_seen, service_name) AS target_service
       FROM (SELECT trace_id, service_name, min(start_timestamp) AS first_seen FROM spans
             WHERE service_name IS NOT NULL GROUP BY 1, 2)) WHERE target_service IS NOT NULL GROUP BY 1, 2""",
    uses=("spans",),
)
def _(spark, d):
    return D.infer_dependencies(A.spans(spark, d))


@query(
    "multi_service_traces",
    """SELECT trace_id, string_agg(service_name, ',' ORDER BY service_name) AS services FROM (
       SELECT DISTINCT trace_id, service_name FROM spans WHERE service_name IS NOT NULL) GROUP BY 1 HAVING count(*) > 1""",
    uses=("spans",),
)
def _(spark, d):
    return D.multi_service_traces(A.spans(spark, d)).withColumn("services", joined("services"))


@query(
    "http_dependencies",
    """SELECT service_name, peer_service AS http_target_service, count(*) AS call_count
    FROM spans WHERE peer_service IS NOT NULL GROUP BY 1, 2""",
    uses=("spans",),
)
def _(spark, d):
    return D.http_dependencies(A.spans(spark, d))


@query("top_edges", f"SELECT {DEPS} FROM deps ORDER BY call_count DESC, source_service NULLS FIRST, target_service NULLS FIRST LIMIT 20", uses=("deps",))
def _(spark, d):
    return D.top_edges(deps(spark, d))


@query(
    "call_graph",
    "SELECT source_service, target_service, call_count, round(avg_duration_ms, 9) AS avg_duration_ms, error_count FROM deps",
    uses=("deps",),
    digits={"avg_duration_ms": 9},
)
def _(spark, d):
    graph = deps(spark, d, with_stats=True)
    return D.call_graph(graph).select("source_service", "target_service", "call_count", "avg_duration_ms", "error_count")


ORPHANS = """SELECT c.* FROM spans c WHERE c.parent_span_id IS NOT NULL AND NOT EXISTS (
       SELECT 1 FROM spans p WHERE p.trace_id = c.trace_id AND p.span_id = c.parent_span_id)"""
cte("orphans", ORPHANS, ("spans",))


@query("orphan_spans", "SELECT trace_id, span_id, parent_span_id, service_name FROM orphans", uses=("orphans",))
def _(spark, d):
    return T.orphan_spans(A.spans(spark, d)).select("trace_id", "span_id", "parent_span_id", "service_name")


@query("orphans_by_service", "SELECT service_name, count(*) AS orphaned_count FROM orphans GROUP BY 1", uses=("orphans",))
def _(spark, d):
    return T.orphans_by_service(A.spans(spark, d))


@query("traces_with_logs", "SELECT DISTINCT trace_id FROM spans WHERE trace_id IN (SELECT trace_id FROM logs)", uses=("spans", "logs"))
def _(spark, d):
    return T.traces_with_logs(A.spans(spark, d), A.logs(spark, d))


# The same operators over an order tree: an order is a trace, its lines are
# spans, and each line was called by the line before it. Lines repeat here, as
# spans do in raw data, so they are reduced first.
cte(
    "line_spans",
    """SELECT DISTINCT 'o' || l_orderkey AS trace_id, 'l' || l_linenumber AS span_id,
       CASE WHEN l_linenumber > 1 THEN 'l' || (l_linenumber - 1) END AS parent_span_id FROM lineitem""",
)


@query(
    "orphan_order_lines",
    """SELECT c.trace_id, c.span_id, c.parent_span_id FROM line_spans c WHERE c.parent_span_id IS NOT NULL AND NOT EXISTS (
       SELECT 1 FROM line_spans p WHERE p.trace_id = c.trace_id AND p.span_id = c.parent_span_id)""",
    uses=("line_spans",),
)
def _(spark, d):
    line = F.col("l_linenumber")
    lines = A.table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), "l_orderkey").alias("trace_id"),
        F.concat(F.lit("l"), line).alias("span_id"),
        F.when(line > 1, F.concat(F.lit("l"), line - 1)).alias("parent_span_id"),
    )
    return T.orphan_spans(lines.distinct())
