"""Expectations of built datasets, and refreshes that touch only their days."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import log, span
from pyspark.sql import functions as F

from signalmill.catalog import QUERIES, builds, streams
from signalmill.plans import build
from signalmill.plans.checks import quarantined, valid_rows
from signalmill.plans.registry import Registry
from signalmill.sinks import purge_days, refresh_days
from signalmill.sources import SourceConfig, read_table


def as_of():
    return F.lit("2024-01-02").cast("timestamp")


def test_rows_that_break_an_expectation_are_kept_apart(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    raw("spans", [span(span_id=str(i), start=i, ms=-5.0 if i == 3 else 5.0) for i in range(10)]).coalesce(1).write.parquet(f"{root}/otel_spans")
    raw("logs", [log(at=i, body=str(i), severity_number="99" if i < 2 else "9") for i in range(6)]).coalesce(1).write.parquet(f"{root}/otel_logs")
    names = ["traces_silver", "logs_silver", "service_health_5min"]
    build(spark, SourceConfig(root=root), names, as_of())
    spans = read_table(spark, f"{root}/traces_silver")
    assert spans.count() == 10 and valid_rows(spans).count() == 9
    bad = quarantined(spans).collect()
    assert [(r["span_id"], r["_violations"]) for r in bad] == [("3", ["valid_timestamps", "valid_duration"])]
    assert quarantined(read_table(spark, f"{root}/logs_silver")).count() == 2
    assert read_table(spark, f"{root}/service_health_5min").agg(F.sum("total_requests")).first()[0] == 9

    raw("logs", [log(at=20, body="x", severity_number="0")]).coalesce(1).write.mode("append").parquet(f"{root}/otel_logs")
    build(spark, SourceConfig(root=root), ["logs_silver"], as_of())
    found = read_table(spark, f"{root}/expectation_results")
    by_run = {}
    for r in found.filter("dataset = 'logs_silver' AND expectation = 'valid_severity'").collect():
        by_run[r["run_id"]] = (r["rows"], r["failed"], r["action"])
    assert sorted(by_run.values()) == [(1, 1, "quarantine"), (6, 2, "quarantine")]
    assert {r["failed"] for r in found.filter("expectation = 'valid_timestamps'").collect()} == {1}
    assert found.filter("checked_at IS NULL").count() == 0
    # Nothing new: the run says so.
    build(spark, SourceConfig(root=root), ["logs_silver"], as_of())
    assert read_table(spark, f"{root}/expectation_results").filter("dataset = 'logs_silver' AND rows = 0").count() == 2


def test_actions_are_the_callers(spark, tmp_path, raw):
    logs = raw("logs", [log(at=i, body=str(i), severity_number="99" if i < 2 else "9") for i in range(6)]).coalesce(1)

    def kept(action):
        root = str(tmp_path / action)
        logs.write.parquet(f"{root}/otel_logs")
        build(spark, SourceConfig(root=root), ["logs_silver"], as_of(), actions={"logs_silver": action})
        return read_table(spark, f"{root}/logs_silver")

    assert kept("warn").count() == 6 and kept("drop").count() == 4 and "_ok" in kept("quarantine").columns
    with pytest.raises(Exception, match="expectation violated"):
        kept("fail")
    with pytest.raises(ValueError):
        Registry().register("x", lambda: None, (), action="ignore")


def test_parts_of_hot_traces_are_the_callers(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    raw("spans", [span(span_id=str(i), start=i / 10) for i in range(200)]).coalesce(1).write.parquet(f"{root}/otel_spans")
    build(spark, SourceConfig(root=root), ["traces_silver", "traces_assembled"], as_of(), parts=8)
    rows = read_table(spark, f"{root}/traces_assembled")
    assert rows.count() == 8 and {r["span_count"] for r in rows.collect()} == {200}
    assert rows.agg(F.sum(F.size("span_details"))).first()[0] == 200


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_in(spark, folder, ids):
    at = datetime(2024, 1, 1)
    rows = [(i, at + timedelta(seconds=i), i % 7, "view", float(i % 90), "{}") for i in ids]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_batches_of_a_stream_are_several_files_of_their_own_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    ids = [*range(60), 119]  # the last batch has fewer rows than files
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(3)
    folder, each = streams.in_files(spark, rows, "id", 3, str(tmp_path / "in"), lambda df: df.withColumn("twice", F.col("id") * 2))
    assert each == 2 and len(spark.read.parquet(folder).inputFiles()) == 6
    seen = []
    stream = streams.read_stream(spark, folder, "id bigint, twice bigint", max_files=each)
    streams.drain(spark, stream, "seen", lambda batch, _: seen.append(sorted((r["id"], r["twice"]) for r in batch.collect())))
    assert seen == [[(i, 2 * i) for i in part] for part in (range(40), range(40, 60), [119])]


def test_a_lake_of_large_batches_is_the_same_and_has_what_it_reads(spark, tmp_path, monkeypatch):
    d = events_in(spark, tmp_path, range(400))
    names = ["traces_silver", "service_dependencies"]
    edges = lambda root: {tuple(r) for r in read_table(spark, f"{root}/service_dependencies").select("source_service", "target_service", "call_count").collect()}
    wanted = edges(builds.lake(spark, d, names))
    monkeypatch.setattr(streams, "FILE_ROWS", 20)
    root = builds.lake(spark, d, names)
    assert wanted and edges(root) == wanted
    assert len(read_table(spark, f"{root}/otel_spans").inputFiles()) == 20
    assert not os.path.exists(f"{root}/otel_logs")
    assert not os.path.exists(f"{builds.lake(spark, d, ['logs_silver'])}/otel_spans")


def test_a_sampled_stream_of_large_batches_is_the_same(spark, tmp_path, monkeypatch):
    d = events_in(spark, tmp_path, range(600))
    run = lambda: sorted(QUERIES["stream_tail_sample"](spark, d).select("span_id", "reason", "weight").collect())
    wanted, dealt = run(), []
    monkeypatch.setattr(streams, "FILE_ROWS", 20)
    read = streams.read_stream
    monkeypatch.setattr(streams, "read_stream", lambda *a, **k: dealt.append(k["max_files"]) or read(*a, **k))
    assert run() == wanted and dealt == [5]


# --- refreshes

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def arrivals(spark, rows):
    """(day, key, arrival) as rows of a source."""
    full = [(None if d is None else DAY + timedelta(days=d, hours=k % 24), k, DAY + timedelta(days=40 + a)) for d, k, a in rows]
    return spark.createDataFrame(full, "ts timestamp, k bigint, arrived timestamp")


def make(rows):
    return rows.groupBy(F.to_date("ts").alias("day"), (F.col("k") % 2).alias("odd")).agg(F.count("*").alias("n"))


def files(path):
    return {os.path.join(a, f) for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_refresh_reads_and_writes_touched_days_only(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    arrivals(spark, [(d, k, 0) for d in range(6) for k in range(10)] + [(None, 1, 0)]).write.partitionBy("arrived").parquet(source)
    read = lambda: spark.read.schema("ts timestamp, k bigint, arrived timestamp").parquet(source)
    assert refresh_days(read(), target, make, "ts", "arrived") == [date(2024, 1, d) for d in range(1, 7)]
    before = files(target)
    assert refresh_days(read(), target, make, "ts", "arrived") == [] and files(target) == before
    arrivals(spark, [(1, 100, 1), (4, 101, 1), (5, 102, 1), (9, 103, 1)]).write.mode("append").partitionBy("arrived").parquet(source)
    made = []
    again = refresh_days(read(), target, lambda rows: made.append(rows) or make(rows), "ts", "arrived")
    assert again == [date(2024, 1, 2), date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 10)]
    changed = before ^ files(target)
    assert {f.split("day=")[1][:10] for f in changed} == {str(d) for d in again}
    got = spark.read.parquet(target).select("day", "odd", "n")
    want = make(read().filter("ts IS NOT NULL")).select("day", "odd", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert made[0].agg(F.countDistinct(F.to_date("ts"))).first()[0] == 4


def test_refresh_bounds_reach_the_scan(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    arrivals(spark, [(d, 1, d) for d in range(4)]).write.parquet(source)
    plans = []
    refresh_days(spark.read.parquet(source), target, lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or make(rows), "ts", "arrived")
    assert "PushedFilters: [" in plans[0] and "GreaterThanOrEqual(ts," in plans[0] and "LessThan(ts," in plans[0]


def test_a_purge_touches_old_days_only(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 8)], "day date, n int")
    rows.write.partitionBy("day").parquet(target)
    before = files(target)
    keep_from = F.lit("2024-01-04").cast("date")
    assert purge_days(spark, target, keep_from) == [date(2024, 1, d) for d in (1, 2, 3)]
    assert all(any(f"day=2024-01-0{d}" in f for d in (1, 2, 3)) for f in before ^ files(target))
    assert sorted(r["n"] for r in spark.read.parquet(target).collect()) == [4, 5, 6, 7]
    assert purge_days(spark, target, keep_from) == []


# --- further datasets, and the folding serving copy


def test_reports_and_wide_datasets_are_built(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    spans = [span(span_id=str(i), parent=None if i == 0 else "0", service="api" if i % 2 else "db", start=i * 30.0, code="ERROR" if i > 36 else "OK") for i in range(40)]
    raw("spans", spans).coalesce(1).write.parquet(f"{root}/otel_spans")
    raw("logs", [log(span_id=str(i), at=i) for i in range(3)]).coalesce(1).write.parquet(f"{root}/otel_logs")
    names = [
        "traces_silver", "logs_silver", "spans_wide_silver", "logs_enriched", "trace_totals", "trace_details", "traces_assembled_windowed",
        "service_health_silver", "service_health_5min", "service_health_hourly", "service_health_daily", "anomaly_baselines", "anomalies",
        "trace_completeness", "cross_signal_correlation", "service_health_quality",
    ]
    build(spark, SourceConfig(root=root), names, as_of(), parts=2)
    table = {n: read_table(spark, f"{root}/{n}") for n in names}
    assert {r["span_name"] for r in table["logs_enriched"].collect()} == {"op"} and table["logs_enriched"].count() == 3
    assert table["trace_details"].count() == 40 and valid_rows(table["spans_wide_silver"]).count() == 40
    assert table["traces_assembled_windowed"].agg(F.sum(F.size("span_details"))).first()[0] == 40
    day = table["service_health_daily"].collect()
    assert sorted((r["service_name"], r["total_requests"], r["hours"]) for r in day) == [("api", 20, 1), ("db", 20, 1)]
    assert table["trace_completeness"].first()["status"] == "PASS" and table["cross_signal_correlation"].first()["traces_with_logs"] == 1
    assert table["service_health_quality"].count() == 1 and "anomaly_type" in table["anomalies"].columns


def test_the_sink_folds_what_came_before(spark, tmp_path):
    from signalmill.sinks import read_latest, upsert_latest
    from signalmill.sinks.serving import _current, _last_fold, serve

    target, want = str(tmp_path / "t"), {}
    write = upsert_latest(target, ["k"], ["at"], fold_every=3)
    for b in range(8):
        rows = [(k, 10 * b + k % 2, f"{b}-{k}") for k in range(b % 3, 9)]
        if b == 5:
            rows.append((3, 0, "older"))
        for k, at, v in rows:
            if k not in want or at >= want[k][0]:
                want[k] = (at, v)
        batch = spark.createDataFrame(rows, "k bigint, at bigint, v string")
        write(batch, b)
        if b in (2, 4):  # a batch that is run again
            write(batch, b)
        assert {r["k"]: (r["at"], r["v"]) for r in read_latest(spark, target, ["k"], ["at"]).collect()} == want, b
    assert _last_fold(spark, target) == 5
    assert sorted(r[0] for r in _current(spark, target).select("_batch_id").distinct().collect()) == [-1, 6, 7]
    once = serve("service_dependencies", str(tmp_path / "d"), ["at"])
    once(spark.createDataFrame([("a", "b", 1), ("a", "b", 2)], "source_service string, target_service string, at int"), 0)
    assert read_latest(spark, str(tmp_path / "d"), ["source_service", "target_service"], ["at"]).first()["at"] == 2


def test_build_into_catalog_tables(spark, tmp_path, raw):
    for name in ("telemetry_raw_t", "telemetry_t"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/{name}'")
    try:
        spans = raw("spans", [span(span_id=str(i), start=i * 30.0) for i in range(12)])
        spans.coalesce(1).write.saveAsTable("spark_catalog.telemetry_raw_t.otel_spans")
        config = SourceConfig(schema="telemetry_t", raw_schema="telemetry_raw_t")
        names = ["traces_silver", "service_health_5min", "traces_assembled"]
        for expected in (12, 20):
            build(spark, config, names, as_of(), checkpoints=str(tmp_path / "checks"), parts=2)
            assert valid_rows(spark.table("telemetry_t.traces_silver")).count() == expected
            assert spark.table("telemetry_t.service_health_5min").agg(F.sum("total_requests")).first()[0] == expected
            assert spark.table("telemetry_t.traces_assembled").agg(F.sum(F.size("span_details"))).first()[0] == expected
            raw("spans", [span(span_id=f"n{i}", start=400 + i) for i in range(8)]).coalesce(1).write.mode("append").saveAsTable("spark_catalog.telemetry_raw_t.otel_spans")
        assert spark.table("telemetry_t.expectation_results").filter("failed = 0").count() == 8
    finally:
        for name in ("telemetry_raw_t", "telemetry_t"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
