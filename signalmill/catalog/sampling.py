"""Queries over samples of traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as S
from . import adapters as A
from .book import cte, query
from .streams import drained, in_batches

RULES = S.KeepRules(rate=0.2, slow_ms=600.0, rates={"svc-click": 0.5})


def chance_sql(key: str, seed: str = "sample") -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 13))::BIGINT / 4503599627370496.0"


cte("flat_nested", "SELECT *, parent AS parent_span_id, (end_us - start_us) / 1000 AS duration_ms FROM nested", ("nested",))


def decisions_sql(source: str, by: str = "") -> str:
    return f"""SELECT *, CASE WHEN has_error THEN 'error' WHEN duration_ms >= 600 THEN 'slow' ELSE 'chance' END AS reason,
       1.0::DOUBLE / share AS weight, {chance_sql("key")} < share AS kept FROM (
      SELECT *, CASE WHEN has_error OR duration_ms >= 600 THEN 1.0 WHEN entry_service = 'svc-click' THEN 0.5 ELSE 0.2 END::DOUBLE AS share FROM (
        SELECT trace_id AS key{by}, arg_min(struct_pack(s := service_name), (parent IS NOT NULL, start_us, span_id)).s AS entry_service,
               count(*) AS span_count, (max(end_us) - min(start_us)) / 1000 AS duration_ms, coalesce(bool_or(is_error), false) AS has_error
        FROM {source} GROUP BY trace_id{by}))"""


cte("decisions", decisions_sql("flat_nested"), ("flat_nested",))
cte("tail", """SELECT s.*, reason, weight FROM flat_nested s JOIN decisions d ON d.key = s.trace_id WHERE kept""", ("decisions",))
# Sessions: a span that starts more than a gap after the one before it begins another.
cte("sessions", """SELECT *, sum(new) OVER (PARTITION BY trace_id ORDER BY start_us, span_id) AS session FROM (
      SELECT *, CASE WHEN start_us - lag(start_us) OVER (PARTITION BY trace_id ORDER BY start_us, span_id) <= 60000 THEN 0 ELSE 1 END AS new
      FROM flat_nested)""", ("flat_nested",))  # fmt: skip
cte("session_decisions", decisions_sql("sessions", ", session"), ("sessions",))
cte("session_tail", """SELECT s.*, reason, weight FROM sessions s JOIN session_decisions d ON d.key = s.trace_id AND d.session = s.session
    WHERE kept""", ("session_decisions",))  # fmt: skip
SAMPLED = "trace_id, span_id, parent_span_id, service_name, duration_ms, is_error, reason, weight"


@query("sample_traces", f"SELECT trace_id, span_id, service_name, 4.0::DOUBLE AS weight FROM spans WHERE {chance_sql('trace_id')} < 0.25", uses=("spans",))
def _(spark, d):
    return S.sample_traces(A.spans(spark, d), 0.25).select("trace_id", "span_id", "service_name", "weight")


@query(
    "trace_decisions",
    "SELECT key, entry_service, span_count, duration_ms, has_error, reason, round(weight, 6) AS weight, kept FROM decisions",
    uses=("decisions",),
)
def _(spark, d):
    return S.trace_decisions(A.nested_spans(spark, d), RULES)


@query("tail_sample", f"SELECT {SAMPLED} FROM tail", uses=("tail",))
def _(spark, d):
    return S.tail_sample(A.nested_spans(spark, d), RULES).select(*SAMPLED.split(", "))


@query(
    "weighted_totals",
    """SELECT service_name, count(*) AS sampled_traces, round(sum(w), 6) AS traces,
       round(sum(w * n), 6) AS span_count, round(sum(w * e), 6) AS error_count, round(sum(w * t), 6) AS duration_ms,
       round(sqrt(sum(w * (w - 1) * n * n)), 6) AS span_count_error, round(sqrt(sum(w * (w - 1) * e * e)), 6) AS error_count_error,
       round(sqrt(sum(w * (w - 1) * t * t)), 6) AS duration_ms_error
    FROM (SELECT service_name, trace_id, any_value(weight) AS w, count(*) AS n, count(*) FILTER (is_error) AS e, sum(duration_ms) AS t
          FROM tail GROUP BY 1, 2) GROUP BY 1""",
    uses=("tail",),
)
def _(spark, d):
    return S.weighted_totals(S.tail_sample(A.nested_spans(spark, d), RULES), ["service_name"])


@query("tail_sample_sessions", f"SELECT {SAMPLED} FROM session_tail", uses=("session_tail",))
def _(spark, d):
    return S.tail_sample_sessions(A.nested_spans(spark, d), RULES, "60 milliseconds").select(*SAMPLED.split(", "))


# Six files, a batch each; a session comes out once the watermark has passed its end.
@query(
    "stream_tail_sample",
    f"""SELECT {SAMPLED} FROM session_tail t WHERE (SELECT max(start_us) FROM sessions s WHERE s.trace_id = t.trace_id AND s.session = t.session)
        + 60000 <= (SELECT max(start_us) FROM nested) - 60000000""",
    uses=("session_tail",),
)
def _(spark, d):
    events = A.table(spark, d, "events")
    stream = in_batches(spark, events, "event_id")
    out = S.tail_sample_stream(A.nested_of(stream), RULES, "60 milliseconds", "1 minute")
    return drained(spark, out.select(*SAMPLED.split(", ")), "tail-stream")
