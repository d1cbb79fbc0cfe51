"""Queries over traces as trees: waterfall, self time, critical path, and where errors come from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import root_cause as R
from ..operators import waterfall as W
from . import adapters as A
from .book import cte, query

cte("tree", """SELECT c.*, CASE WHEN p.span_id IS NOT NULL THEN c.parent END AS up, c.parent IS NOT NULL AND p.span_id IS NULL AS parent_lost
    FROM nested c LEFT JOIN nested p ON p.trace_id = c.trace_id AND p.span_id = c.parent""", ("nested",))  # fmt: skip
CLIMB = """climb AS (
      SELECT trace_id, span_id, span_id AS root, 0::BIGINT AS depth, [span_id] AS path FROM tree WHERE up IS NULL
      UNION ALL
      SELECT c.trace_id, c.span_id, p.root, p.depth + 1, list_append(p.path, c.span_id)
      FROM tree c JOIN climb p ON p.trace_id = c.trace_id AND p.span_id = c.up)"""
cte("kids", """SELECT c.trace_id, c.parent, c.span_id, greatest(c.start_us, p.start_us) AS begin_us, least(c.end_us, p.end_us) AS finish_us
    FROM nested c JOIN nested p ON p.trace_id = c.trace_id AND p.span_id = c.parent
    WHERE c.start_us <= p.end_us AND c.end_us >= p.start_us AND c.span_id <> c.parent""", ("nested",))  # fmt: skip
cte("covered", """SELECT trace_id, parent, sum(greatest(finish_us - greatest(begin_us, coalesce(seen, begin_us)), 0))::BIGINT AS us FROM (
      SELECT *, max(finish_us) OVER (PARTITION BY trace_id, parent ORDER BY begin_us, finish_us, span_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM kids) GROUP BY 1, 2""", ("kids",))  # fmt: skip
# From a span to the child it waited for last, and from a child to the sibling before it.
cte("waits", """SELECT trace_id, parent AS waiting, arg_max(span_id, (finish_us, begin_us, span_id)) AS span_id FROM kids GROUP BY 1, 2
    UNION ALL
    SELECT c.trace_id, c.span_id, arg_max(d.span_id, (d.finish_us, d.begin_us, d.span_id)) FROM kids c JOIN kids d
      ON d.trace_id = c.trace_id AND d.parent = c.parent AND d.finish_us <= c.begin_us
      AND (d.finish_us, d.begin_us, d.span_id) < (c.finish_us, c.begin_us, c.span_id)
    GROUP BY 1, 2""", ("kids",))  # fmt: skip
ON_PATH = """crit AS (
      SELECT trace_id, span_id FROM tree WHERE up IS NULL
      UNION
      SELECT w.trace_id, w.span_id FROM crit JOIN waits w ON w.trace_id = crit.trace_id AND w.waiting = crit.span_id)"""


@query(
    "span_tree",
    f"""SELECT * FROM (WITH RECURSIVE {CLIMB}
      SELECT t.trace_id, t.span_id, root AS root_span_id, depth, array_to_string(path, '/') AS path, parent_lost, root IS NULL AS in_cycle
      FROM tree t LEFT JOIN climb c ON c.trace_id = t.trace_id AND c.span_id = t.span_id)""",
    uses=("tree",),
)
def _(spark, d):
    return W.span_tree(A.nested_spans(spark, d)).withColumn("path", F.array_join("path", "/"))


@query(
    "self_times",
    """SELECT n.trace_id, n.span_id, (n.end_us - n.start_us) / 1000 AS duration_ms, coalesce(us, 0) / 1000 AS child_ms,
       (n.end_us - n.start_us - coalesce(us, 0)) / 1000 AS self_ms
    FROM nested n LEFT JOIN covered c ON c.trace_id = n.trace_id AND c.parent = n.span_id""",
    uses=("covered",),
)
def _(spark, d):
    return W.self_times(A.nested_spans(spark, d))


@query(
    "trace_waterfall",
    f"""SELECT * FROM (WITH RECURSIVE {CLIMB}, {ON_PATH}
      SELECT t.trace_id, t.span_id, t.parent AS parent_span_id, service_name, name,
             (start_us - min(start_us) OVER (PARTITION BY t.trace_id)) / 1000 AS offset_ms, (end_us - start_us) / 1000 AS duration_ms,
             (end_us - start_us - coalesce(us, 0)) / 1000 AS self_ms, depth, root AS root_span_id, array_to_string(path, '/') AS path,
             crit.span_id IS NOT NULL AS on_critical_path, parent_lost, root IS NULL AS in_cycle
      FROM tree t LEFT JOIN climb c ON c.trace_id = t.trace_id AND c.span_id = t.span_id
      LEFT JOIN crit ON crit.trace_id = t.trace_id AND crit.span_id = t.span_id
      LEFT JOIN covered v ON v.trace_id = t.trace_id AND v.parent = t.span_id)""",
    uses=("tree", "covered", "waits"),
)
def _(spark, d):
    return W.trace_waterfall(A.nested_spans(spark, d)).withColumn("path", F.array_join("path", "/"))


# Failing spans and the failing parent of each; origins are those without a failing child.
cte("failing", """SELECT c.trace_id, c.span_id, c.service_name, c.start_us, p.span_id AS up FROM nested c
    LEFT JOIN nested p ON p.trace_id = c.trace_id AND p.span_id = c.parent AND p.is_error WHERE c.is_error""", ("nested",))  # fmt: skip
CHAIN = """chain AS (
      SELECT trace_id, span_id, span_id AS entry, 0::BIGINT AS hops, [coalesce(service_name, '?')] AS services, service_name AS entry_service
      FROM failing WHERE up IS NULL
      UNION ALL
      SELECT c.trace_id, c.span_id, p.entry, p.hops + 1, list_append(p.services, coalesce(c.service_name, '?')), p.entry_service
      FROM failing c JOIN chain p ON p.trace_id = c.trace_id AND p.span_id = c.up),
    origins AS (
      SELECT f.trace_id, f.span_id, f.service_name, f.start_us, entry AS entry_span_id, entry_service, hops, array_to_string(services, '>') AS services
      FROM failing f LEFT JOIN chain c ON c.trace_id = f.trace_id AND c.span_id = f.span_id
      WHERE NOT EXISTS (SELECT 1 FROM failing k WHERE k.trace_id = f.trace_id AND k.up = f.span_id))"""
CAUSES = """causes AS (
      SELECT trace_id, entry_span_id, any_value(entry_service) AS entry_service, count(*) AS origins,
             arg_min(span_id, (-hops, start_us, span_id)) AS origin_span_id,
             arg_min(struct_pack(s := service_name), (-hops, start_us, span_id)).s AS origin_service, max(hops) AS hops
      FROM origins WHERE entry_span_id IS NOT NULL GROUP BY 1, 2)"""


def origins(spark, d):
    return R.error_origins(A.nested_spans(spark, d))


def chained(column: str):
    return F.array_join(F.transform(column, lambda x: F.coalesce(x, F.lit("?"))), ">")


@query("error_origins", f"SELECT * FROM (WITH RECURSIVE {CHAIN} SELECT * FROM origins)", uses=("failing",))
def _(spark, d):
    return origins(spark, d).withColumn("services", chained("services"))


@query("root_causes", f"SELECT * FROM (WITH RECURSIVE {CHAIN}, {CAUSES} SELECT * FROM causes)", uses=("failing",))
def _(spark, d):
    return R.root_causes(origins(spark, d))


@query(
    "error_chains",
    f"""SELECT * FROM (WITH RECURSIVE {CHAIN}
      SELECT services, any_value(service_name) AS origin_service, any_value(entry_service) AS entry_service, any_value(hops) AS hops,
             count(*) AS error_count, count(DISTINCT trace_id) AS trace_count
      FROM origins WHERE entry_span_id IS NOT NULL GROUP BY services)""",
    uses=("failing",),
)
def _(spark, d):
    return R.error_chains(origins(spark, d)).withColumn("services", chained("services"))


@query(
    "error_reach",
    f"""SELECT * FROM (WITH RECURSIVE {CHAIN}, {CAUSES}
      SELECT origin_service, entry_service, count(*) AS entry_count, count(DISTINCT trace_id) AS trace_count, max(hops) AS max_hops,
             round(avg(hops), 6) AS avg_hops FROM causes GROUP BY 1, 2)""",
    uses=("failing",),
)
def _(spark, d):
    return R.error_reach(R.root_causes(origins(spark, d)))
