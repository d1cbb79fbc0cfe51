"""Samples of traces with weights, and baselines by the hour of the week."""

from __future__ import annotations

import os
import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_trees import frame, row

from signalmill.operators import sampling as S
from signalmill.operators import seasonal as W
from signalmill.session import work_dir


def traces(seed: int, many: int):
    rng, rows = random.Random(seed), []
    for t in range(many):
        for i in range(rng.randrange(1, 9)):
            start = rng.randrange(0, 100_000)
            rows.append(row(f"t{t}", f"s{i}", None if i == 0 else "s0", start, start + rng.randrange(50_000), rng.choice("abc"), rng.random() < 0.03))
    return rows


def timed(df):
    return df.withColumn("duration_ms", (F.unix_micros("end_timestamp") - F.unix_micros("start_timestamp")) / 1000)


def test_lower_rates_keep_a_subset_of_whole_traces(spark):
    rows = traces(1, 600)
    df = frame(spark, rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[0]] += 1
    kept = {}
    for rate in (0.1, 0.3, 1.0):
        got = defaultdict(int)
        for r in S.sample_traces(df, rate).collect():
            got[r["trace_id"]] += 1
            assert r["weight"] == 1 / rate
        assert all(sizes[t] == n for t, n in got.items())
        kept[rate] = set(got)
    assert kept[0.1] < kept[0.3] < kept[1.0] == set(sizes) and 30 < len(kept[0.1]) < 90
    assert {r["trace_id"] for r in S.sample_traces(df, 0.3, "other").collect()} != kept[0.3]


def test_tail_rules_keep_errors_and_slow_traces(spark):
    rows = traces(2, 500)
    rules = S.KeepRules(rate=0.1, slow_ms=120.0, rates={"a": 0.5})
    kept = {r["trace_id"]: r for r in S.tail_sample(frame(spark, rows), rules).collect()}
    by_trace = defaultdict(list)
    for r in rows:
        by_trace[r[0]].append(r)
    for trace, mine in by_trace.items():
        length = (max(r[6] for r in mine) - min(r[5] for r in mine)) / timedelta(milliseconds=1)
        if any(r[7] for r in mine):
            assert kept[trace]["reason"] == "error" and kept[trace]["weight"] == 1.0
        elif length >= 120:
            assert kept[trace]["reason"] == "slow" and kept[trace]["weight"] == 1.0
        elif trace in kept:
            assert kept[trace]["weight"] == (2.0 if mine[0][3] == "a" else 10.0)
    assert {r["reason"] for r in kept.values()} == {"error", "slow", "chance"}


def test_weighted_totals_are_near_the_whole(spark):
    df = timed(frame(spark, traces(3, 3000))).cache()
    whole = {r["service_name"]: r for r in S.weighted_totals(df.withColumn("weight", F.lit(1.0)), ["service_name"]).collect()}
    assert all(r["span_count_error"] == 0.0 for r in whole.values())
    off = []
    for seed in "abcdefgh":
        sample = S.tail_sample(df, S.KeepRules(rate=0.2, slow_ms=140.0, seed=seed))
        assert sample.count() < 0.6 * df.count()
        for r in S.weighted_totals(sample, ["service_name"]).collect():
            for name in ("span_count", "error_count", "duration_ms"):
                true = whole[r["service_name"]][name]
                if r[f"{name}_error"] == 0:
                    assert r[name] == pytest.approx(true)
                else:
                    off.append((r[name] - true) / r[f"{name}_error"])
    assert max(abs(x) for x in off) < 4.5 and 0.5 < statistics.pstdev(off) < 1.6 and abs(statistics.mean(off)) < 0.7


def test_awkward_rows_of_samples(spark):
    rows = [row(None, "x", None, 0, 10, None, None), row(None, "y", None, 0, 10), row(None, None, None, None, None), row("t", "s", None, None, None, error=True)]
    decided = {r["key"]: r for r in S.trace_decisions(frame(spark, rows), S.KeepRules(rate=1.0, slow_ms=1.0)).collect()}
    assert set(decided) == {"span:x", "span:y", "", "t"} and all(r["kept"] for r in decided.values())
    assert decided["t"]["reason"] == "error" and decided["t"]["duration_ms"] is None and decided["span:x"]["has_error"] is False
    assert S.tail_sample(frame(spark, rows), S.KeepRules(rate=1.0)).count() == 4
    assert S.tail_sample(frame(spark, []), S.KeepRules()).count() == 0
    for rate in (0, 1.5):
        with pytest.raises(ValueError):
            S.KeepRules(rate=rate)


def test_giant_trace_is_split_among_tasks(spark):
    n = 60_000
    spans = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "giant").otherwise(F.concat(F.lit("t"), F.col("id") % 9000)).alias("trace_id"),
        F.col("id").cast("string").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"), F.lit("a").alias("service_name"),
        F.timestamp_micros(F.col("id")).alias("start_timestamp"), F.timestamp_micros(F.col("id") + 5).alias("end_timestamp"),
        F.lit(0.005).alias("duration_ms"), (F.col("id") == 0).alias("is_error"), F.repeat(F.lit("x"), 50).alias("name"),
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sample = S.tail_sample(spans, S.KeepRules(rate=0.01))
        assert sample.filter("trace_id = 'giant'").count() == n // 3
        sample.collect()
        assert "skew=true" in sample._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- hours of the week

MONDAY = datetime(2024, 1, 1, tzinfo=timezone.utc)
DIGITS = {"error_rate": 4, "latency": 1}


def health(spark, rows):
    return spark.createDataFrame(rows, "service_name string, timestamp timestamp, error_rate double, latency double")


def health_rows(seed: int, days: int):
    rng = random.Random(seed)
    return [
        (s, MONDAY + timedelta(days=d, hours=rng.choice([3, 3, 15]), minutes=rng.randrange(60)), rng.random(), rng.choice([None, 10.0, rng.random() * 100, float("nan")]))
        for d in range(days) for s in ("a", "b", None) for _ in range(6)
    ]


def by_hand(rows):
    values = defaultdict(list)
    for s, at, rate, latency in rows:
        hour = at.weekday() * 24 + at.hour
        values[(s, hour, "error_rate")].append(round(rate + 1e-12, 4))
        if latency is not None and latency == latency:
            values[(s, hour, "latency")].append(round(latency + 1e-12, 1))
    out = {}
    for key, v in values.items():
        m = statistics.median(v)
        out[key] = (round(m, 6), round(statistics.median(abs(x - m) for x in v), 6), len(v))
    return out


def baselines(counts, *bounds):
    return {tuple(r[:3]): (round(r["median"], 6), round(r["mad"], 6), r["samples"]) for r in W.seasonal_baselines(counts, *bounds).collect()}


def test_updates_by_day_equal_the_whole(spark):
    rows = health_rows(5, 16)
    df, path = health(spark, rows), work_dir(spark, "season")
    day = lambda n: F.lit((MONDAY + timedelta(days=n)).date())
    for since, until in ((0, 9), (9, 15), (15, 16), (15, 16)):
        W.update_counts(df, path, day(since), day(until), DIGITS)
    assert baselines(W.read_counts(spark, path)) == by_hand(rows) == baselines(W.seasonal_counts(df, DIGITS))
    recent = [r for r in rows if r[1] >= MONDAY + timedelta(days=7)]
    assert baselines(W.read_counts(spark, path), day(7)) == by_hand(recent)


def test_an_update_touches_its_days_only(spark):
    rows = health_rows(6, 5)
    df, path = health(spark, rows), work_dir(spark, "season")
    day = lambda n: F.lit((MONDAY + timedelta(days=n)).date())
    W.update_counts(df, path, day(0), day(5), DIGITS)
    files = lambda: {os.path.join(a, f) for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    late = health(spark, [*rows, ("a", MONDAY + timedelta(days=4, hours=3), 0.5, 1.0)])
    W.update_counts(late, path, day(4), day(5), DIGITS)
    changed = before ^ files()
    assert changed and all("day=2024-01-05" in f for f in changed)
    assert W.read_counts(spark, path).filter("metric = 'error_rate'").agg(F.sum("n")).first()[0] == len(rows) + 1


def test_seasonal_anomalies_know_the_hour(spark):
    quiet = [("a", MONDAY + timedelta(days=7 * w, hours=3), 0.01 * (w % 3), 10.0 + w) for w in range(6)]
    busy = [("a", MONDAY + timedelta(days=7 * w, hours=15), 0.5 + 0.01 * (w % 3), 90.0 + w) for w in range(6)]
    known = W.seasonal_baselines(W.seasonal_counts(health(spark, quiet + busy), DIGITS))
    now = [("a", MONDAY + timedelta(days=42, hours=3), 0.5, 12.0), ("a", MONDAY + timedelta(days=42, hours=15), 0.5, 92.0), ("new", MONDAY, 9.0, 9.0)]
    found = W.seasonal_anomalies(health(spark, now), known, digits=DIGITS).collect()
    assert [(r["service_name"], r["metric"], r["timestamp"].hour) for r in found] == [("a", "error_rate", 3)]
    assert W.seasonal_anomalies(health(spark, now), known, least_samples=7, digits=DIGITS).count() == 0
    assert W.seasonal_baselines(W.seasonal_counts(health(spark, []), DIGITS)).count() == 0
