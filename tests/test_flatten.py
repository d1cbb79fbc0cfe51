from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

from helpers import SEC, T0, exp_histogram, gauge, histogram, log, resource, span
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalmill.catalog import QUERIES
from signalmill.functions import columns as C
from signalmill.functions import predicates as P
from signalmill.operators import logs as L
from signalmill.operators import metrics as M
from signalmill.operators.dedup import attribute_text, dedup
from signalmill.operators.spans import FLAT, WIDE, flatten_spans


def test_span_columns_and_edge_cases(raw):
    rows = [
        span(code=None, parent=""),
        span(span_id="b", parent="a", code="ERROR", attributes={"http.status_code": "abc", "http.method": "GET"}),
        span(span_id="c", service=None, attributes={"http.status_code": "200"}),
        span(span_id="d", start_time_unix_nano=T0 + 57_999_999_999, end_time_unix_nano=T0 + 58 * SEC),
    ]
    wide = flatten_spans(raw("spans", rows), wide=True)
    assert wide.columns == WIDE
    assert flatten_spans(raw("spans", rows)).columns == FLAT
    got = {r.span_id: r for r in wide.collect()}
    assert got["a"].is_error is False and got["a"].parent_span_id is None
    assert got["b"].is_error is True and got["b"].http_status_code is None and got["b"].http_method == "GET"
    assert got["c"].service_name is None and got["c"].http_status_code == 200
    assert got["d"].start_timestamp.second == 57 and got["d"].start_timestamp.microsecond == 999_999
    assert abs(got["d"].duration_ms - 1e-6) < 1e-12


def test_whole_second_precision(raw):
    r = flatten_spans(raw("spans", [span(start=1.75)]), precision="second").first()
    assert r.start_timestamp.second == 1 and r.start_timestamp.microsecond == 0


def test_dedup_keeps_one_and_can_rank(raw):
    flat = flatten_spans(raw("spans", [span(ms=1), span(ms=3), span(ms=2), span(trace="t2")]))
    assert dedup(flat, ["trace_id", "span_id"]).count() == 2
    ranked = dedup(flat, ["trace_id", "span_id"], order_by=[F.desc("duration_ms")])
    assert {r.trace_id: r.duration_ms for r in ranked.collect()} == {"t1": 3.0, "t2": 10.0}


def test_log_key_is_stable_for_missing_parts(raw):
    rows = [log(body=None, trace=None), log(body=None, trace=None), log(body="x")]
    keys = [r.log_key for r in L.flatten_logs(raw("logs", rows)).collect()]
    assert keys[0] == keys[1] != keys[2] and None not in keys


def test_log_dedup_keys(raw):
    rows = [log(), log(), log(span_id="b")]
    flat = L.flatten_logs(raw("logs", rows))
    assert dedup(flat, L.DEDUP_KEYS).count() == 2
    assert dedup(flat, L.ENRICHED_DEDUP_KEYS).count() == 1


def test_enrich_keeps_every_log_once(raw):
    spans = flatten_spans(raw("spans", [span(), span(), span(span_id="b")]), wide=True)
    logs = L.flatten_logs(raw("logs", [log(), log(trace=None), log(span_id=None), log(span_id="zz")]))
    out = L.enrich_logs(logs, spans).collect()
    assert len(out) == 4
    assert sorted(str(r.span_name) for r in out) == ["None", "None", "None", "op"]
    assert not [c for c in L.enrich_logs(logs, spans).columns if c.startswith("_")]


def test_resolve_trace_id_order(raw):
    rows = [
        log(trace="own", attributes={"trace_id": "attr"}),
        log(trace="", attributes={"trace_id": "attr"}),
        log(trace=None, resource=({"trace_id": "res"}, 0)),
        log(trace=None),
    ]
    flat = L.flatten_logs(raw("logs", rows), resolve_trace=True)
    assert [r.trace_id for r in flat.collect()] == ["own", "attr", "res", None]


def test_all_metric_types_get_a_time(raw):
    rows = [
        gauge(1.0),
        {"name": "s", "metric_type": "sum", "resource": resource(), "sum": (None, T0, 2.0, None, {}, None, "D", True)},
        histogram([1, 2], [5.0]),
        exp_histogram(1, 0, [1]),
        {"name": "q", "metric_type": "summary", "resource": resource(), "summary": (None, T0, 3, 9.0, [(0.5, 1.0)], {}, None)},
        {"name": "u", "metric_type": "unknown", "resource": resource()},
    ]
    got = {r.metric_type: r for r in M.flatten_metrics(raw("metrics", rows)).collect()}
    assert len(got) == 6
    assert [k for k, r in got.items() if r.metric_timestamp is None] == ["unknown"]
    assert got["gauge"].value == 1.0 and got["sum"].value == 2.0 and got["histogram"].value is None
    assert got["summary"].summary_quantiles[0].quantile == 0.5


def test_flatten_by_type_mean_of_empty_histogram(raw):
    rows = [histogram([0, 0], [5.0], total=0.0), histogram([1, 1], [5.0], total=8.0, name="h2"), gauge(1.0)]
    got = {r.name: r for r in M.flatten_metrics_by_type(raw("metrics", rows)).collect()}
    assert got["h"].value is None and got["h2"].value == 4.0 and got["m"].is_monotonic is None


def test_metric_series_differ_by_attributes(raw):
    rows = [gauge(1.0, attributes={"a": "1", "b": "2"}), gauge(2.0, attributes={"b": "2", "a": "1"}), gauge(3.0, attributes={"a": "9"})]
    flat = M.flatten_metrics(raw("metrics", rows))
    assert M.dedup_metrics(flat).count() == 2
    assert M.dedup_metrics(flat, by_attributes=False).count() == 1


def test_different_attributes_are_different_texts(spark):
    maps = [None, {}, {"a": None}, {"a": ""}, {"a": "-"}, {"a": "1", "b": "2"}, {"a": "1:b1:2"}, {"a": "11:b", "2": None}, {"é": "1"}, {"a1:": "1"}]
    df = spark.createDataFrame([(m,) for m in [*maps, {"b": "2", "a": "1"}]], "m map<string,string>")
    texts = [r[0] for r in df.select(attribute_text(F.col("m"))).collect()]
    assert len(set(texts)) == len(maps) and texts[5] == texts[-1] and texts[0] is None and texts[1] == ""


def test_points_are_shuffled_without_their_maps(spark, tmp_path):
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    rows = [(1, i % 3, 1, 1, 4.0, 2.0, 0.1, 0.02, "A", "F") for i in range(6)]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = QUERIES["dedup_metrics"](spark, str(tmp_path))
    assert out.count() == 3
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        out.explain("formatted")
    shuffled = [p.splitlines()[1] for p in plan.getvalue().split("\n\n") if re.match(r"\(\d+\) Exchange", p.strip())]
    assert shuffled and not any(re.search(r"[\[ ]attributes#", p) for p in shuffled)


def test_sanitize_health(spark):
    rows = [
        (None, 0, 0, -1.0), ("a", None, None, 1.0), ("a", 2, 3, 1.0), ("a", 4, 1, None), ("a", -5, 0, 2.0),
    ]
    df = spark.createDataFrame(rows, "service_name string, request_count bigint, error_count bigint, latency_p95_ms double")
    got = C.sanitize_health(df).collect()
    assert [r.error_rate for r in got] == [0.0, 0.0, 1.0, 0.25, 0.0]
    assert [r.request_count for r in got] == [0, 0, 2, 4, 0]
    assert [r.latency_p95_ms for r in got][:3] == [0.0, 1.0, 1.0]
    assert got[0].service_name == "unknown"


def test_health_status(spark):
    df = spark.createDataFrame([(0.06, 1.0, False), (0.02, 1.0, False), (0.0, 600.0, False), (0.0, 1.0, True), (0.0, 1.0, False)], "e double, p double, a boolean")
    plain = [r[0] for r in df.select(C.health_status(F.col("e"))).collect()]
    full = [r[0] for r in df.select(C.health_status(F.col("e"), F.col("p"), F.col("a"))).collect()]
    assert plain == ["critical", "warning", "healthy", "healthy", "healthy"]
    assert full == ["critical", "warning", "warning", "critical", "healthy"]


def test_conform_reaches_into_structs(spark):
    df = spark.createDataFrame([((1, "x"), [(1,)], "7")], "s struct<a:int,b:string>, l array<struct<p:int>>, n string")
    want = StructType.fromDDL("n INT, s STRUCT<b:STRING,c:DOUBLE>, l ARRAY<STRUCT<p:INT,q:STRING>>, z DATE")
    out = C.conform(df, want)
    assert out.schema.simpleString() == want.simpleString()
    r = out.first()
    assert (r.n, r.s.b, r.s.c, r.l[0].p, r.l[0].q, r.z) == (7, "x", None, 1, None, None)


def test_gate_by_samples(spark):
    df = spark.createDataFrame([(3, 1.0, None), (12, 2.0, None)], "sample_count int, m double, sd double")
    got = C.gate_by_samples(df, 10, m="null", sd="zero").collect()
    assert [(r.m, r.sd) for r in got] == [(None, 0.0), (2.0, 0.0)]


def test_floor_to_equals_window_start(spark):
    times = [dt.datetime(2024, 1, 1, 0, 4, 59, 999_999), dt.datetime(2024, 1, 1, 0, 5), dt.datetime(1969, 12, 31, 23, 59)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    for size in ("5 minutes", "1 hour", "10 seconds"):
        assert df.filter(C.floor_to("ts", size) != C.tumble("ts", size)).count() == 0


def test_invalid_and_find_duplicates(spark):
    rows = [(-0.1, 1.0, 1), (0.5, -1.0, 1), (1.1, 1.0, 1), (None, 1.0, 1), (0.2, 1.0, 1)]
    df = spark.createDataFrame(rows, "error_rate double, latency_p95_ms double, request_count bigint")
    assert P.invalid_health(df).count() == 4
    assert df.filter(P.out_of_range()).count() == 3
    assert P.find_duplicates(df, ["latency_p95_ms"]).first().duplicate_count == 4


def test_last_active_ignores_null(spark):
    r = spark.range(1).select(C.last_active(F.lit(None).cast("timestamp"), F.lit("2024-01-01").cast("timestamp"))).first()
    assert r[0] == dt.datetime(2024, 1, 1)
