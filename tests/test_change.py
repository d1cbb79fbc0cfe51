"""Recursive scores against a plain loop; batches that go on from a state."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from signalmill.operators import change as N
from signalmill.session import work_dir

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "host string, service string, timestamp timestamp, value double, target double, scale double"
RULES = N.ChangeRules(alpha=0.3, slack=0.4, alarm=3.0, chunk="1 hour")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def scores(df, rules=RULES, state=None):
    return N.score_changes(df, ["host", "service"], "value", F.col("target"), F.col("scale"), rules, state=state)


def by_hand(rows, rules=RULES):
    out, series = {}, {}
    for r in rows:
        series.setdefault(r[:2], []).append(r)
    for key, mine in series.items():
        e, up, down = None, 0.0, 0.0
        for r in sorted((r for r in mine if None not in r[2:] and r[5] != 0), key=lambda r: (r[2], r[3])):
            x, z = r[3], (r[3] - r[4]) / r[5]
            e = x if e is None else rules.alpha * x + (1 - rules.alpha) * e
            was = up, down
            up, down = max(0.0, up + z - rules.slack), max(0.0, down - z - rules.slack)
            change = "up" if up > rules.alarm >= was[0] else "down" if down > rules.alarm >= was[1] else None
            out[(*key, r[2], x)] = (e, up, down, change)
    return out


def check(got, want):
    scored = {(r["host"], r["service"], r["timestamp"].replace(tzinfo=timezone.utc), r["value"]): r for r in got if r["ewma"] is not None}
    assert set(scored) == set(want)
    for key, (e, up, down, change) in want.items():
        r = scored[key]
        assert (r["ewma"], r["cusum_up"], r["cusum_down"]) == pytest.approx((e, up, down), abs=1e-9), key
        assert r["change"] == change, key


def random_rows(seed: int, many: int = 700):
    rng, rows = random.Random(seed), []
    for host, service, step in (("h1", "a", 3), ("h1", None, 400), ("h2", "a", 60), (None, None, 4000)):
        at, level = 0, 0.0
        for _ in range(many):
            at += rng.randrange(1, 2 * step)
            level = rng.uniform(-2, 2) if rng.random() < 0.02 else level
            rows.append((host, service, ZERO + timedelta(seconds=at), rng.gauss(level, 1), 0.1, 1.3))
    return rows


@pytest.mark.parametrize("rules", [RULES, N.ChangeRules(0.05, 0.0, 2.0, "1 day"), N.ChangeRules(0.9, 1.0, 1.0, "5 minutes")])
def test_scores_match_a_loop(spark, rules):
    rows = random_rows(1)
    want = by_hand(rows, rules)
    check(scores(frame(spark, rows), rules)[0].collect(), want)
    assert {w[3] for w in want.values()} == {"up", "down", None}


def test_rows_without_scores_stay(spark):
    good = [("h", "s", ZERO + timedelta(seconds=i), float(i), 0.0, 1.0) for i in range(5)]
    odd = [("h", "s", None, 1.0, 0.0, 1.0), ("h", "s", ZERO, None, 0.0, 1.0), ("h", "s", ZERO, 9.0, None, 1.0), ("h", "s", ZERO, 9.0, 0.0, 0.0), ("x", None, ZERO, 1.0, 0.0, None)]
    got, state = scores(frame(spark, good + odd))
    rows = got.collect()
    assert len(rows) == 10 and sum(r["ewma"] is None for r in rows) == 5 and state.count() == 1
    check(rows, by_hand(good))
    nothing, none = scores(frame(spark, []))
    assert nothing.count() == none.count() == 0
    with pytest.raises(ValueError):
        N.ChangeRules(alpha=0.95)


def test_ties_and_one_long_hour(spark):
    rng = random.Random(2)
    rows = [("h", "s", ZERO + timedelta(milliseconds=i // 2), rng.gauss(0, 1), 0.0, 1.0) for i in range(1500)]
    check(scores(frame(spark, rows))[0].collect(), by_hand(rows))


def test_batches_go_on_from_the_state(spark):
    rows = random_rows(3, 300)
    cuts = [ZERO + timedelta(seconds=s) for s in (0, 400, 9000, 30_000, 10**9)]
    state, got = None, []
    for low, high in zip(cuts, cuts[1:]):
        part, state = scores(frame(spark, [r for r in rows if low <= r[2] < high]), state=state)
        got += part.collect()
        state = spark.createDataFrame(state.collect(), state.schema)
    check(got, by_hand(rows))
    late, after = scores(frame(spark, [rows[0], ("new", "s", ZERO, 1.0, 0.0, 1.0)]), state=state)
    assert sorted(r["ewma"] is None for r in late.collect()) == [False, True]
    assert after.count() == 5


def test_a_repeated_batch_replaces_itself(spark):
    rows = random_rows(4, 120)
    target, states = work_dir(spark, "scores"), work_dir(spark, "states")
    each = N.score_batches(target, states, ["host", "service"], "value", F.col("target"), F.col("scale"), RULES)
    cut = ZERO + timedelta(hours=2)
    first, second = ([r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut])
    each(frame(spark, first), 0)
    each(frame(spark, second), 1)
    each(frame(spark, second), 1)
    check(spark.read.parquet(target).collect(), by_hand(rows))


def test_one_series_is_many_tasks_work(spark):
    rows = [("h", "s", ZERO + timedelta(minutes=i), 1.0, 0.0, 1.0) for i in range(5000)]
    got = scores(frame(spark, rows))[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and all("chunk" in line for line in windows)
