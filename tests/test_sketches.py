"""Sketches against exact values: rank errors, distinct counts, merging."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from signalmill.operators import rollups
from signalmill.operators import sketches as K


@pytest.fixture(scope="module")
def spans(spark):
    """A service with two thirds of all spans, long tails, ties; 120 minutes."""
    n = 240_000
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), i % 7)).alias("service_name"),
        F.concat(F.lit("t"), F.floor(i / 8)).alias("trace_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.pmod(i * 7919, F.lit(n)) * 30_000).alias("start_timestamp"),
        F.when(i % 10 == 0, 5.0).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 1000)).alias("duration_ms"),
        (i % 50 == 0).alias("is_error"),
    ).cache()


def test_percentiles_of_every_resolution_are_within_the_stated_rank_error(spark, spans):
    finest = K.health_sketches(spans)
    asked = {f"q{q}": q for q in (0.01, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)}
    merged = K.with_answers(K.merge_sketches(finest, ["service_name"]), asked).cache()
    assert {r["resolution"]: r["n"] for r in merged.groupBy("resolution").agg(F.countDistinct("window_start").alias("n")).collect()} == {
        "1min": 120, "5min": 24, "1hour": 2, "1day": 1,
    }
    for label, size in (("1hour", "1 hour"), ("1day", "1 day")):
        values = spans.withColumn("window_start", F.window("start_timestamp", size)["start"])
        errors = K.rank_errors(values, ["service_name", "window_start"], "duration_ms", merged.filter(F.col("resolution") == label), asked)
        worst = errors.agg(F.max("rank_error"), F.count("*")).first()
        assert worst[0] <= K.RANK_ERROR and worst[1] == 8 * 8 * (2 if label == "1hour" else 1)
        assert worst[0] > 0  # it is a sketch, after all
    day = {r["service_name"]: r for r in merged.filter("resolution = '1day'").collect()}
    exact = spans.groupBy("service_name").agg(
        F.count("*").alias("n"), F.sum("duration_ms").alias("s"), F.countDistinct("trace_id").alias("t"), F.count_if("is_error").alias("e")
    )
    for r in exact.collect():
        got = day[r["service_name"]]
        assert (got["sample_count"], got["error_count"]) == (r["n"], r["e"]) and got["sum_value"] == pytest.approx(r["s"])
        assert got["distinct_count"] == pytest.approx(r["t"], rel=0.06)


def test_small_groups_are_exact_and_odd_values_are_left_out(spark):
    nan = float("nan")
    rows = [("m", "a", "gauge", s, v, {"k": str(k)}) for s, v, k in ((1, 1.0, 1), (2, 3.0, 1), (70, 2.0, 2), (80, None, 2), (90, nan, 3), (4000, None, 1))]
    rows += [(None, None, "sum", 1, 4.0, {"x": "1", "y": "2"}), (None, None, "sum", 2, 5.0, {"y": "2", "x": "1"}), ("h", "a", "histogram", 1, 1.0, {})]
    metrics = spark.createDataFrame(rows, "name string, service_name string, metric_type string, s bigint, value double, attributes map<string,string>")
    metrics = metrics.withColumn("metric_timestamp", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("s"))).drop("s")
    merged = K.with_answers(K.merge_sketches(K.metric_sketches(metrics), rollups.SERIES, {"1hour": "1 hour"}))
    got = {(r["name"], r["window_start"].minute + 60 * r["window_start"].hour): r for r in merged.collect()}
    a, later, none = got[("m", 0)], got[("m", 60)], got[(None, 0)]
    assert (a["sample_count"], a["value_count"], a["p50"], a["p99"], a["avg_value"], a["distinct_count"]) == (5, 3, 2.0, 3.0, 2.0, 3)
    assert (later["sample_count"], later["value_count"], later["p50"], later["max_value"]) == (1, 0, None, None)
    assert (none["distinct_count"], none["sum_value"]) == (1, 9.0) and len(got) == 3
    assert K.with_answers(K.merge_sketches(K.metric_sketches(metrics.limit(0)), rollups.SERIES)).count() == 0


def test_lookback_of_merged_windows(spark, spans):
    finest = K.health_sketches(spans)
    recent = K.merge_sketches(finest, ["service_name"], {"5min": "5 minutes"}, "30 MINUTES", F.lit("2024-01-01 02:00:00").cast("timestamp"))
    assert recent.agg(F.min("window_start").cast("string"), F.sum("sample_count")).first()[:] == ("2024-01-01 01:30:00", 60_000)


def test_resolutions_equal_rollups_of_the_rollup(spark):
    n = 3000
    i = F.col("id")
    r1 = spark.range(n).select(
        F.concat(F.lit("m"), i % 3).alias("name"), F.when(i % 5 > 0, "s").alias("service_name"), F.lit("gauge").alias("metric_type"),
        F.timestamp_seconds(F.lit(1_704_067_200) + 60 * F.floor(i / 15)).alias("window_start"), (i % 9 + 1).alias("sample_count"),
        (i % 11).cast("double").alias("avg_value"), (i % 4).cast("double").alias("min_value"), (i % 13).cast("double").alias("max_value"),
        (i * 0.5).alias("sum_value"),
    )
    got = rollups.resolutions(r1, {"5min": "5 minutes", "1hour": "1 hour"})
    for label, size in (("5min", "5 minutes"), ("1hour", "1 hour")):
        mine = got.filter(F.col("rollup_window") == label).drop("rollup_window")
        want = rollups.rerollup(r1, size).drop("window_end").select(*mine.columns)
        assert mine.count() == want.count() > 0 and mine.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
