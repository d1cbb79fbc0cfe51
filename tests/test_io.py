from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import gauge, histogram, log, span
from pyspark.sql import functions as F

from signalmill.catalog import sources
from signalmill.operators.dedup import dedup
from signalmill.operators.health import service_health, service_health_5min
from signalmill.operators.logs import enrich_logs_streaming, flatten_logs
from signalmill.operators.quality import HEALTH_EXPECTATIONS, expect
from signalmill.operators.spans import flatten_spans
from signalmill.plans import build, datasets
from signalmill.schemas import SERVING_KEYS, ddl, struct
from signalmill.sinks import (
    append_if_any, compact, purge_older_than, read_latest, register_rollup_views, rewrite_clustered, upsert_latest,
    write_table,
)
from signalmill.sources import SourceConfig, load_signal_csv, read_stream, read_table
from signalmill.streaming import late_rows, progress, run_stream


def run(df, target, **options):
    query = run_stream(df, target and str(target), f"{target}-checkpoint" if target else options.pop("checkpoint"), **options)
    query.awaitTermination()
    return query


def test_csv_exports_are_compressed_files_of_bounded_rows(spark, tmp_path, raw, monkeypatch):
    monkeypatch.setattr(sources, "CSV_ROWS", 50)
    rows = raw("metrics", [gauge(float(i), attributes={"a": f"x,\"{i}"}) for i in range(200)]).coalesce(1)
    sources._as_csv(rows, str(tmp_path / "csv"))
    files = [f for f in (tmp_path / "csv").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 200 * 40
    back = load_signal_csv(spark, str(tmp_path / "csv"), "metrics")
    assert sorted((r["gauge"]["value"], r["gauge"]["attributes"]["a"]) for r in back.collect()) == [(float(i), f'x,"{i}') for i in range(200)]


def test_csv_bad_json_and_narrow_structs(spark, tmp_path):
    rows = [
        ["trace_id", "span_id", "attributes", "resource", "start_time_unix_nano", "end_time_unix_nano", "status"],
        ["t", "a", json.dumps({"k": "v"}), json.dumps({"attributes": {"service.name": "api"}}), "1000000", "3000000", "{broken"],
        ["t", "b", "nonsense", json.dumps({"dropped_attributes_count": 3}), "x", "", json.dumps({"code": "ERROR"})],
    ]
    text = "\n".join(",".join('"' + c.replace('"', '""') + '"' for c in r) for r in rows)
    (tmp_path / "s.csv").write_text(text)
    df = load_signal_csv(spark, str(tmp_path / "s.csv"), "spans")
    assert df.schema.simpleString() == struct("spans").simpleString()
    got = {r.span_id: r for r in flatten_spans(df).collect()}
    assert got["a"].service_name == "api" and got["a"].duration_ms == 2.0 and got["a"].is_error is False
    assert got["b"].start_timestamp is None and got["b"].is_error is True and got["b"].service_name is None


def test_append_only_when_there_are_rows(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    assert append_if_any(df.filter("id > 9"), path) is False
    assert append_if_any(df, path) and append_if_any(df, path)
    assert read_table(spark, path).count() == 6


def test_clustered_layout_prunes_and_splits_a_hot_value(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("trace_id"), "id")
    path = str(tmp_path / "c")
    rewrite_clustered(df, path, ["trace_id"], partitions=8)
    out = read_table(spark, path)
    assert out.count() == 4000
    files = out.groupBy(F.input_file_name().alias("f")).agg(F.min("trace_id").alias("lo"), F.max("trace_id").alias("hi"), F.count("*").alias("n"), F.count_if(F.col("trace_id") == "hot").alias("hot")).collect()
    assert sum(1 for r in files if r.hot) >= 3 and max(r.n for r in files) < 1200
    assert sum(1 for r in files if r.lo <= "t1" <= r.hi) <= 2


def test_purge_keeps_rows_of_unknown_age(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 3, 1)), (3, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    kept = purge_older_than(df, "ts", "30 DAYS", F.lit("2024-03-10").cast("timestamp"))
    assert sorted(r.id for r in kept.collect()) == [2, 3]


def test_lookback_reaches_the_scan(spark, tmp_path, raw):
    path = str(tmp_path / "spans")
    write_table(flatten_spans(raw("spans", [span()])), path)
    h = service_health_5min(read_table(spark, path), "90 DAYS", F.lit("2024-01-02").cast("timestamp"))
    plan = h._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(start_timestamp" in plan and "attributes" not in scan


def test_rollup_views(spark, raw):
    from signalmill.operators.metrics import flatten_metrics
    from signalmill.operators.rollups import metrics_rollup

    r1 = metrics_rollup(flatten_metrics(raw("metrics", [gauge(1.0, 0), gauge(3.0, 120), gauge(5.0, 900)])))
    register_rollup_views(spark, r1)
    assert spark.table("metrics_5min_rollup_view").count() == 2
    assert spark.table("metrics_hourly_rollup_view").first().sum_value == 9.0


def test_upsert_replay_and_compaction(spark, tmp_path):
    path, keys, order = str(tmp_path / "u"), ["k"], ["v"]
    write = upsert_latest(path, keys, order)
    one = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, v int")
    two = spark.createDataFrame([("b", 5), ("c", 1)], "k string, v int")
    write(one, 0), write(two, 1), write(two, 1), write(one, 0)
    want = {"a": 3, "b": 5, "c": 1}
    assert {r.k: r.v for r in read_latest(spark, path, keys, order).collect()} == want
    compact(spark, path, str(tmp_path / "folded"), keys, order)
    assert {r.k: r.v for r in read_latest(spark, str(tmp_path / "folded"), keys, order).collect()} == want
    assert "metric_type" in SERVING_KEYS["metrics_1min_rollup"]


def test_config_names(spark):
    spark.conf.set("signalmill.schema", "gold")
    try:
        c = SourceConfig.from_session(spark)
    finally:
        spark.conf.unset("signalmill.schema")
    assert c.table("x") == "spark_catalog.gold.x" and c.raw("spans") == "spark_catalog.telemetry_raw.otel_spans"
    assert SourceConfig(root="/d").raw("logs") == "/d/otel_logs"


def test_registry_rejects_nonsense():
    r = datasets()
    with pytest.raises(ValueError):
        r.register("traces_silver", lambda s: s, ())
    with pytest.raises(ValueError):
        r.register("new", lambda s: s, (), "hourly")


def test_stream_equals_batch_on_closed_windows_and_restart_adds_nothing(spark, tmp_path, raw):
    source = str(tmp_path / "in")
    raw("spans", [span(span_id=str(i), start=i * 20.0) for i in range(60)]).write.parquet(source)
    stream = lambda: service_health(flatten_spans(read_stream(spark, source, ddl("spans"))), "1 minute", "2 minutes")
    run(stream(), tmp_path / "out")
    schema = stream().schema
    read = lambda: spark.read.schema(schema).parquet(str(tmp_path / "out"))
    last = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=59 * 20)
    batch = service_health(flatten_spans(spark.read.schema(ddl("spans")).parquet(source)))
    want = batch.filter(F.col("window_end") <= F.lit(last - dt.timedelta(minutes=2)))
    cols = ["timestamp", "service_name", "request_count", "latency_p95_ms"]
    assert read().select(*cols).exceptAll(want.select(*cols)).count() == 0
    n = read().count()
    assert n == want.count() and n < batch.count()
    run(stream(), tmp_path / "out")
    assert read().count() == n
    # New input continues where the last run stopped.
    raw("spans", [span(span_id="z", start=3600.0)]).write.mode("append").parquet(source)
    run(stream(), tmp_path / "out")
    assert read().count() == batch.count()


def test_late_rows_are_dropped_and_counted(spark, tmp_path, raw):
    source = str(tmp_path / "in")
    raw("spans", [span(span_id="a", start=7200.0)]).coalesce(1).write.parquet(source)
    stream = lambda: service_health(flatten_spans(read_stream(spark, source, ddl("spans"), max_files=1)), "1 minute", "1 minute")
    run(stream(), tmp_path / "out")
    raw("spans", [span(span_id="late", start=0.0)]).coalesce(1).write.mode("append").parquet(source)
    query = run(stream(), tmp_path / "out")
    assert late_rows(query) == 1
    assert any(p["input_rows"] == 1 for p in progress(query))


def test_stream_dedup_state_is_bounded(spark, tmp_path, raw):
    source = str(tmp_path / "in")
    for hour in range(4):
        rows = [span(span_id=f"{hour}-{i % 5}", start=hour * 3600.0 + i) for i in range(20)]
        raw("spans", rows).coalesce(1).write.mode("append").parquet(source)
    flat = flatten_spans(read_stream(spark, source, ddl("spans"), max_files=1)).select("trace_id", "span_id", "start_timestamp")
    query = run(dedup(flat, ["trace_id", "span_id"], ("start_timestamp", "1 minute"), within=True), tmp_path / "out")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    assert progress(query)[-1]["state_rows"] <= 5


def test_span_may_arrive_after_its_log(spark, tmp_path, raw):
    logs_in, spans_in = str(tmp_path / "logs"), str(tmp_path / "spans")
    raw("logs", [log(at=0.0), log(span_id="never", at=1.0), log(trace=None, span_id=None, at=2.0)]).write.parquet(logs_in)
    raw("spans", []).write.parquet(spans_in)

    def stream():
        logs = flatten_logs(read_stream(spark, logs_in, ddl("logs")))
        spans = flatten_spans(read_stream(spark, spans_in, ddl("spans")), wide=True)
        return enrich_logs_streaming(logs, spans, "1 minute", "5 minutes").select("log_key", "span_id", "span_name")

    run(stream(), tmp_path / "out")
    raw("spans", [span(start=0.0), span(trace="t9", span_id="q", start=7200.0)]).write.mode("append").parquet(spans_in)
    raw("logs", [log(trace="t9", span_id="q", at=7200.0)]).write.mode("append").parquet(logs_in)
    run(stream(), tmp_path / "out")
    got = sorted((str(r.span_id), str(r.span_name)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("None", "None"), ("a", "op"), ("never", "None"), ("q", "op")]


def test_fail_expectation_stops_a_stream(spark, tmp_path, raw):
    source = str(tmp_path / "in")
    raw("spans", [span(service=None)]).write.parquet(source)
    flat = flatten_spans(read_stream(spark, source, ddl("spans"))).select("service_name", F.lit(1).alias("request_count"))
    with pytest.raises(Exception, match="expectation violated"):
        run(expect(flat, HEALTH_EXPECTATIONS, "fail"), tmp_path / "out")


def test_build_runs_every_dataset_and_again(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    spans = [span(span_id=str(i), parent=None if i == 0 else "0", service="api" if i % 2 else "db", start=i * 30.0) for i in range(40)]
    raw("spans", spans + spans[:5]).write.parquet(f"{root}/otel_spans")
    raw("logs", [log(at=i) for i in range(3)]).write.parquet(f"{root}/otel_logs")
    raw("metrics", [gauge(float(i), i * 30.0) for i in range(20)] + [histogram([1, 2], [5.0], at=i * 30.0) for i in range(20)]).write.parquet(f"{root}/otel_metrics")
    as_of = F.lit("2024-01-02").cast("timestamp")
    config = SourceConfig(root=root)
    done = build(spark, config, as_of=as_of)
    counts = {n: read_table(spark, f"{root}/{n}").count() for n in done}
    assert counts["traces_silver"] == 40 and counts["logs_silver"] == 3 and counts["metrics_silver"] == 40
    assert counts["service_dependencies"] == 2 and counts["traces_assembled"] == 1 and counts["anomaly_baselines"] == 2
    assert counts["metrics_1min_rollup"] >= 8 and counts["histogram_metrics_1min_rollup"] >= 8 and counts["service_health_silver"] > 10
    build(spark, config, as_of=as_of)
    assert {n: read_table(spark, f"{root}/{n}").count() for n in done} == counts


def test_build_runs_on_and_restarts(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    raw("metrics", [gauge(float(i), i * 30.0) for i in range(20)]).write.parquet(f"{root}/otel_metrics")
    names = ["metrics_silver", "metrics_1min_rollup"]
    build(spark, SourceConfig(root=root), names, trigger="1 second")
    running = {q.name: q for q in spark.streams.active if q.name in names}
    assert set(running) == set(names)
    raw("metrics", [gauge(1.0, 1200.0)]).write.mode("append").parquet(f"{root}/otel_metrics")
    for name in names:
        running[name].processAllAvailable()
    for q in running.values():
        q.stop()
    assert read_table(spark, f"{root}/metrics_silver").count() == 21
    # A restart goes on from the checkpoint and repeats nothing.
    raw("metrics", [gauge(1.0, 2400.0), gauge(1.0, 2400.0)]).write.mode("append").parquet(f"{root}/otel_metrics")
    build(spark, SourceConfig(root=root), names)
    assert read_table(spark, f"{root}/metrics_silver").count() == 22
    windows = read_table(spark, f"{root}/metrics_1min_rollup")
    assert windows.count() == windows.select("window_start").distinct().count() >= 11


def test_delays_are_the_callers(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    raw("spans", [span(start=7200.0)]).coalesce(1).write.parquet(f"{root}/otel_spans")
    config = SourceConfig(root=root)
    build(spark, config, ["traces_silver"], delays={"traces_silver": None})
    raw("spans", [span(span_id="late", start=0.0)]).write.mode("append").parquet(f"{root}/otel_spans")
    build(spark, config, ["traces_silver"], delays={"traces_silver": None})
    assert {r.span_id for r in read_table(spark, f"{root}/traces_silver").collect()} == {"a", "late"}
    with pytest.raises(ValueError):
        build(spark, SourceConfig(), ["traces_silver"])
