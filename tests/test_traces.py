from __future__ import annotations

import datetime as dt

import pytest
from helpers import log, span
from pyspark.sql import functions as F

from signalmill.operators import anomaly as N
from signalmill.operators import dependencies as D
from signalmill.operators import health as H
from signalmill.operators import quality as Q
from signalmill.operators import traces as T
from signalmill.operators.logs import enrich_logs, flatten_logs
from signalmill.operators.spans import flatten_spans


def flat(raw, rows):
    return flatten_spans(raw("spans", rows))


TREE = [
    span(), span(span_id="b", parent="a", service="db", start=1), span(span_id="c", parent="a", service="db", start=2, code="ERROR"),
    # The same span id in another trace is another span.
    span(trace="t2", span_id="x", parent="a", service="web", start=3),
]


def test_edges_need_both_keys(raw):
    deps = D.service_dependencies(flat(raw, TREE), None, with_stats=True).collect()
    assert [(r.source_service, r.target_service, r.call_count, r.unique_traces, r.error_count) for r in deps] == [("api", "db", 2, 1, 1)]
    assert deps[0].last_active == deps[0].last_seen
    assert [r.span_id for r in T.orphan_spans(flat(raw, TREE)).collect()] == ["x"]


def test_last_active_counts_every_span(raw):
    rows = TREE + [span(trace="t3", span_id="q", service="db", start=100)]
    r = D.service_dependencies(flat(raw, rows), None).first()
    assert r.last_seen.second == 2 and r.last_active.minute == 1


def test_asymmetric_lookback(raw):
    day = 86_400
    rows = [span(start=-20 * day), span(span_id="b", parent="a", service="db", start=-day), span(span_id="c", parent="a", start=-20 * day)]
    as_of = F.lit("2024-01-01").cast("timestamp")
    spans = flat(raw, rows)
    assert T.span_edges(spans, "7 DAYS", "30 DAYS", as_of).count() == 1
    assert T.span_edges(spans, "7 DAYS", "7 DAYS", as_of).count() == 0


def test_assembly_is_one_row_per_trace(raw):
    rows = [span(start=299), span(span_id="b", parent="a", service="db", start=301, ms=20.5, code="ERROR")]
    out = T.assemble_traces(flat(raw, rows), None).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.part, r.span_count, r.services_involved, r.service_count, r.error_count, r.has_errors) == (0, 2, ["api", "db"], 2, 1, True)
    assert abs(r.total_trace_duration_ms - 2020.5) < 1e-9
    assert [s.span_id for s in r.span_details] == ["a", "b"]
    assert T.assemble_traces_windowed(flat(raw, rows)).count() == 2


# The plan for data too large to broadcast, with skew found at any size.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500b",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_span_in_logs_and_hot_parent_are_split(spark, raw, large):
    spans = flatten_spans(raw("spans", [span(span_id=str(i), parent=None if i == 0 else "0", start=i * 1.37, service=f"s{i}") for i in range(600)] + [span(trace=f"t{i}") for i in range(100)]), wide=True)
    logs = flatten_logs(raw("logs", [log(span_id="0", at=i) for i in range(600)] + [log(trace=f"t{i}") for i in range(100)]))
    enriched = enrich_logs(logs, spans)
    assert sum(r.span_name is not None for r in enriched.collect()) == 700
    assert "skew=true" in final_plan(enriched)
    edges = T.span_edges(spans)
    assert len(edges.collect()) == 599
    assert "skew=true" in final_plan(edges)


def test_hot_trace_is_cut_into_bounded_parts_and_stays_whole(spark, large):
    # A third of all spans belong to one trace, and a few have no trace at all.
    n, parts = 3000, 10
    spans = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 20, F.lit(None)).otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("trace_id"),
        F.col("id").cast("string").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"),
        F.lit("op").alias("name"), F.lit("SERVER").alias("kind"), F.concat(F.lit("s"), F.col("id") % 7).alias("service_name"),
        F.timestamp_seconds(F.col("id")).alias("start_timestamp"), F.timestamp_seconds(F.col("id") + 1).alias("end_timestamp"),
        F.col("id").cast("double").alias("duration_ms"), (F.col("id") % 10 == 0).alias("is_error"),
    )
    assembled = T.assemble_traces(spans, None, parts=parts)
    rows = assembled.collect()
    plan = final_plan(assembled)
    assert plan.split("Initial Plan")[0].count("Range (") == 1 and "SortAggregate" not in plan and "Join" not in plan
    hot = [r for r in rows if r.trace_id == "hot"]
    assert len(hot) == 10 and {r.span_count for r in hot} == {1000}
    assert {r.avg_span_duration_ms for r in hot} == {sum(range(0, n, 3)) / 1000}
    assert max(len(r.span_details) for r in rows) < 200
    ids = [s.span_id for r in rows for s in r.span_details]
    assert len(ids) == n and len(set(ids)) == n
    none = [r for r in rows if r.trace_id is None]
    assert {r.span_count for r in none} == {sum(1 for i in range(20) if i % 3)}
    whole = {r.trace_id: r for r in T.assemble_traces(spans, None).collect()}
    for r in rows:
        w = whole[r.trace_id]
        assert (r.services_involved, r.trace_end, r.error_count) == (w.services_involved, w.trace_end, w.error_count)
    assert all(0 <= r.part < parts for r in rows)


def test_inferred_chain_has_no_pairs_beyond_neighbours(raw):
    rows = [span(service=s, span_id=s, start=i) for i, s in enumerate("cab")] + [span(trace="t2", service="c"), span(trace="t2", service="a", span_id="z", start=5)]
    got = {(r.source_service, r.target_service): r.trace_count for r in D.infer_dependencies(flat(raw, rows)).collect()}
    assert got == {("c", "a"): 2, ("a", "b"): 1}


def test_completeness_and_correlation(raw):
    spans, logs = flat(raw, TREE), flatten_logs(raw("logs", [log(), log(trace=None)]))
    r = Q.validate_trace_completeness(spans).first()
    assert (r.total_spans, r.orphaned_spans, r.completeness_rate, r.traces_with_roots, r.distinct_root_traces, r.status) == (4, 1, 75.0, 1, 1, "FAIL")
    c = Q.validate_cross_signal(spans, logs).first()
    assert (c.total_traces, c.traces_with_logs, c.correlation_rate, c.status) == (2, 1, 50.0, "WARN")


def test_checks_on_empty_input(raw):
    spans, logs = flat(raw, []), flatten_logs(raw("logs", []))
    r = Q.validate_trace_completeness(spans).first()
    assert (r.total_spans, r.orphaned_spans, r.completeness_rate, r.status) == (0, 0, 0.0, "FAIL")
    assert Q.validate_cross_signal(spans, logs).first().status == "WARN"
    h = Q.validate_service_health(H.service_health(spans)).first()
    assert (h.total_records, h.data_quality_score, h.status) == (0, 0.0, "FAIL")
    assert T.assemble_traces(spans).count() == 0 and D.service_dependencies(spans).count() == 0


def test_health_windows(raw):
    rows = [span(ms=float(i), span_id=str(i), code="ERROR" if i < 2 else "OK") for i in range(1, 11)] + [span(service=None, span_id="n")]
    one = H.service_health(flat(raw, rows), "2 minutes").collect()
    assert len(one) == 1 and one[0].request_count == 10 and one[0].error_rate == 0.1
    assert one[0].requests_per_second == 10 / 120 and one[0].latency_p50_ms == 5.0 and one[0].latency_p99_ms == 10.0
    five = H.service_health_5min(flat(raw, rows), None).collect()
    assert sorted(str(r.service_name) for r in five) == ["None", "api"]


def test_hourly_rate_is_weighted(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0), "a", 1.0, 5.0, 6.0, 1, 2.0), (dt.datetime(2024, 1, 1, 0, 5), "a", 0.0, 9.0, 7.0, 3, 4.0)]
    h5 = spark.createDataFrame(rows, "timestamp timestamp, service_name string, error_rate double, p95_latency_ms double, p99_latency_ms double, total_requests bigint, avg_latency_ms double")
    r = H.service_health_hourly(h5, None).first()
    assert (r.error_rate, r.p95_latency_ms, r.avg_latency_ms, r.total_requests) == (0.25, 9.0, 3.0, 4)


def _health(spark, rows):
    schema = "timestamp timestamp, service_name string, error_rate double, p95_latency_ms double"
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(minutes=5 * i), s, e, p) for i, s, e, p in rows], schema)


def test_single_sample_service_never_alerts(spark):
    h = _health(spark, [(0, "one", 0.5, 10.0)])
    base = N.anomaly_baselines(h, days=None)
    assert base.first().error_rate_threshold is None
    assert N.detect_anomalies(h, base, None, latency="p95_latency_ms").count() == 0
    assert N.zscores(h.withColumnRenamed("p95_latency_ms", "latency_p95_ms"), base, None).first().z_score is None


def test_detection_names_the_cause(spark):
    calm = _health(spark, [(i, "s", 0.01 * (i % 2), 10.0 + i % 2) for i in range(20)])
    base = N.anomaly_baselines(calm, days=None)
    now = _health(spark, [(100, "s", 0.9, 10.0), (101, "s", 0.0, 99.0), (102, "s", 0.9, 99.0), (103, "s", 0.0, 10.0)])
    got = [r.anomaly_type for r in N.detect_anomalies(now, base, None, latency="p95_latency_ms").orderBy("timestamp").collect()]
    assert got == ["error_rate", "latency", "error_rate"]
    tight = N.anomaly_baselines(calm, sigma=0, days=None).first()
    assert abs(tight.error_rate_threshold - tight.baseline_error_rate) < 1e-12


def test_window_gaps(spark):
    h = _health(spark, [(0, "s", 0.0, 1.0), (1, "s", 0.0, 1.0), (4, "s", 0.0, 1.0), (0, "t", 0.0, 1.0)])
    got = H.window_gaps(h).collect()
    assert [(r.service_name, r.gap_minutes) for r in got] == [("s", 15)]


def test_near_spans_bound_the_scan(spark, tmp_path, raw):
    from signalmill.operators.logs import enrich_batches, fill_contexts, flatten_logs, near_spans
    from signalmill.operators.spans import flatten_spans

    path = str(tmp_path / "spans")
    flatten_spans(raw("spans", [span(span_id=str(i), start=i * 600.0) for i in range(100)]), wide=True).write.parquet(path)
    spans = spark.read.parquet(path)
    logs = flatten_logs(raw("logs", [log(span_id=str(i), at=i * 600.0 + 30) for i in (50, 52)] + [log(span_id="10", at=52 * 600.0)]))
    near = near_spans(spans, logs, "10 minutes", "10 minutes")
    assert {r["span_id"] for r in near.collect()} == {"50", "51", "52", "53"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = near_spans(spans, logs, "10 minutes", "10 minutes")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(start_timestamp," in plan and "LessThanOrEqual(start_timestamp," in plan
    assert near_spans(spans, logs.limit(0)).count() == 0
    once = enrich_batches(str(tmp_path / "out"), spans, "10 minutes", "10 minutes")
    once(logs, 0)
    once(logs, 0)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted((r["span_id"], r["span_name"]) for r in got.collect()) == [("10", None), ("50", "op"), ("52", "op")]
    assert {r["span_name"] for r in fill_contexts(got, spans).collect()} == {"op"}
