from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from helpers import exp_histogram, gauge, histogram
from pyspark.sql import functions as F

from signalmill.functions.histograms import histogram_quantile
from signalmill.operators import histograms as HG
from signalmill.operators import quality as Q
from signalmill.operators import rollups as R
from signalmill.operators.metrics import flatten_metrics


def flat(raw, rows):
    return flatten_metrics(raw("metrics", rows))


def test_rerollup_keeps_counts_and_weights(raw):
    rows = [gauge(1.0, 1), gauge(2.0, 2), gauge(9.0, 61)]
    r1 = R.metrics_rollup(flat(raw, rows))
    assert sorted(r.sample_count for r in r1.collect()) == [1, 2]
    r5 = R.rerollup(r1, "5 minutes").collect()
    assert len(r5) == 1
    assert (r5[0].sample_count, r5[0].avg_value, r5[0].weighted_avg_value, r5[0].sum_value) == (3, 5.25, 4.0, 12.0)
    assert (r5[0].window_end - r5[0].window_start) == dt.timedelta(minutes=5)


def test_rollup_gaps(raw):
    r1 = R.metrics_rollup(flat(raw, [gauge(1.0, 0), gauge(1.0, 180), gauge(1.0, 60, service=None)]))
    start, end = (F.lit(f"2024-01-01 00:0{m}:00").cast("timestamp") for m in (0, 3))
    got = sorted((str(r.service_name), r.expected_window_start.minute) for r in R.rollup_gaps(r1, start, end).collect())
    assert got == [("None", 0), ("None", 2), ("None", 3), ("api", 1), ("api", 2)]


def test_merge_histograms_by_bounds(raw):
    rows = [histogram([1, 2, 3], [5.0, 10.0], total=6.0, low=1.0), histogram([4, 5, 6], [5.0, 10.0], at=1, high=20.0), histogram([1, 1], [7.0], at=2), histogram(None, [5.0, 10.0], count=4, at=3)]
    got = {tuple(r.bounds): r for r in HG.merge_histograms(flat(raw, rows)).collect()}
    r = got[(5.0, 10.0)]
    assert r.buckets == [5, 7, 9] and (r.point_count, r.total_count, r.total_sum, r.min_value, r.max_value) == (3, 25, 6.0, 1.0, 20.0)
    assert got[(7.0,)].buckets == [1, 1]


def test_rollup_lists_and_bounds_flag(raw):
    rows = [histogram([1, 2], [5.0]), histogram([3, 4], [6.0], at=1), exp_histogram(2, 0, [1]), exp_histogram(1, 0, [1], at=2)]
    got = {r.metric_type: r for r in R.histogram_rollup(flat(raw, rows)).collect()}
    assert got["histogram"].bounds_mismatch is True and len(got["histogram"].histogram_buckets_list) == 2
    assert got["exponential_histogram"].exp_histogram_scale == 1 and len(got["exponential_histogram"].exp_histogram_positive_bucket_list) == 2


def test_hot_series_lists_are_bounded(raw):
    rows = [histogram([1, 1], [5.0], at=i / 100) for i in range(300)] + [histogram([1, 1], [5.0], name="cold")]
    out = R.histogram_rollup(flat(raw, rows), parts=6).collect()
    hot = [r for r in out if r.name == "h"]
    assert len(hot) == 6 and {r.total_count for r in hot} == {600}
    assert sum(len(r.histogram_buckets_list) for r in hot) == 300 and max(len(r.histogram_buckets_list) for r in hot) < 100


def expected_quantile(buckets, bounds, q, low, high):
    if len(buckets) != len(bounds) + 1 or sum(buckets) == 0:
        return None
    rank, below = q * sum(buckets), 0
    for i, n in enumerate(buckets):
        if n > 0 and below + n >= rank:
            a = low if i == 0 else bounds[i - 1]
            b = high if i == len(bounds) else bounds[i]
            return a + (b - a) * (rank - below) / n
        below += n
    return None


def test_histogram_quantile_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(200):
        size = rnd.randint(1, 6)
        bounds = sorted(rnd.uniform(-50, 50) for _ in range(size))
        buckets = [rnd.choice([0, 0, 1, 5, 9]) for _ in range(size + rnd.choice([0, 1, 1, 1]))]
        rows.append((buckets, bounds, min(bounds) - 1, max(bounds) + 3))
    df = spark.createDataFrame(rows, "buckets array<bigint>, bounds array<double>, lo double, hi double")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = [r[0] for r in df.select(histogram_quantile(F.col("buckets"), F.col("bounds"), q, F.col("lo"), F.col("hi"))).collect()]
        want = [expected_quantile(*r[:2], q, *r[2:]) for r in rows]
        for g, w in zip(got, want):
            assert (g is None) == (w is None) and (g is None or math.isclose(g, w, abs_tol=1e-9))


def test_quantile_without_extremes(spark):
    df = spark.createDataFrame([([4, 0, 4], [10.0, 20.0])], "b array<bigint>, e array<double>")
    one = lambda q: df.select(histogram_quantile(F.col("b"), F.col("e"), q)).first()[0]
    assert one(0.25) == 5.0 and one(0.9) == 20.0


def test_merge_exp_histograms_against_brute_force(raw):
    rnd = random.Random(7)
    rows, points = [], []
    for i in range(60):
        scale, offset = rnd.randint(-1, 4), rnd.randint(-9, 9)
        counts = [rnd.randint(0, 3) for _ in range(rnd.randint(0, 6))]
        negative = (rnd.randint(-4, 4), [1, 2]) if i % 3 else None
        rows.append(exp_histogram(scale, offset, counts, at=i, zero=i % 2, negative=negative))
        points.append((scale, offset, counts, negative))
    low = min(p[0] for p in points)
    want = {1: {}, -1: {}}
    for scale, offset, counts, negative in points:
        for sign, (off, cs) in ((1, (offset, counts)), (-1, negative or (0, []))):
            for j, n in enumerate(cs):
                key = (off + j) >> (scale - low)
                want[sign][key] = want[sign].get(key, 0) + n
    r = HG.merge_exp_histograms(flat(raw, rows)).first()
    assert r.scale == low and r.point_count == 60 and r.zero_count == 30
    assert {b.idx: b.n for b in r.positive} == {k: v for k, v in want[1].items() if v}
    assert {b.idx: b.n for b in r.negative} == {k: v for k, v in want[-1].items() if v}
    assert [b.idx for b in r.positive] == sorted(b.idx for b in r.positive)


def test_integrity_and_sanity(raw, spark):
    rows = [histogram([1, 2, 3], [5.0, 10.0]), histogram([1, 2], [5.0, 10.0], at=1)]
    assert sorted(r.integrity_status for r in Q.histogram_integrity(flat(raw, rows)).collect()) == ["INVALID", "VALID"]
    bad = spark.createDataFrame([("m", "s", "gauge", None, 1, 5.0, 2.0, 9.0, 2.0)], "name string, service_name string, metric_type string, window_start timestamp, sample_count bigint, min_value double, avg_value double, max_value double, sum_value double")
    assert Q.rollup_sanity(bad).first().validation_status == "INVALID"


def test_expectations(raw, spark):
    df = spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c")], "span_count bigint, k string")
    rules = {"valid_span_count": "span_count > 0"}
    assert Q.expect(df, rules).count() == 3
    assert [r.k for r in Q.expect(df, rules, "drop").collect()] == ["a"]
    assert Q.expect(df.filter("k = 'a'"), rules, "fail").count() == 1
    with pytest.raises(Exception, match="expectation violated"):
        Q.expect(df, rules, "fail").collect()
    r = Q.expectation_report(df, rules).first()
    assert (r.expectation, r.passed, r.failed) == ("valid_span_count", 1, 2)
    # Distributions have no single value, yet they are valid points.
    metrics = flat(raw, [gauge(None), gauge(1.0, 1), histogram([1, 1], [5.0])])
    assert Q.expect(metrics, Q.METRIC_EXPECTATIONS, "drop").count() == 2


def test_health_quality_counts(spark):
    rows = [("a", 0.5, 1.0, 1), (None, 2.0, 1.0, 1), ("a", None, None, None)]
    df = spark.createDataFrame(rows, "service_name string, error_rate double, latency_p95_ms double, request_count bigint")
    r = Q.validate_service_health(df).first()
    assert (r.total_records, r.null_service_names, r.null_error_rates, r.null_latencies, r.null_request_counts, r.invalid_ranges) == (3, 1, 1, 1, 1, 1)
    assert round(r.data_quality_score, 4) == 66.6667 and r.status == "FAIL"


def test_exact_lag_equals_percentile_of_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base, base + dt.timedelta(seconds=s), "k") for s in (0, 0, 0, 10, 500)]
    df = spark.createDataFrame(rows, "t timestamp, i timestamp, k string")
    r = Q.ingest_lag(df, "t", "i", ["k"]).first()
    want = df.selectExpr("percentile(unix_timestamp(i) - unix_timestamp(t), array(0.5, 0.95, 0.99)) q").first().q
    assert [r.p50_lag_seconds, r.p95_lag_seconds, r.p99_lag_seconds] == [round(x, 2) for x in want]
