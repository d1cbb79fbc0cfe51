"""Traces as trees against brute force: depth, paths, self time, critical path, error chains."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from signalmill.operators import forest, root_cause as R, waterfall as W

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "trace_id string, span_id string, parent_span_id string, service_name string, name string, "
    "start_timestamp timestamp, end_timestamp timestamp, is_error boolean"
)


def row(trace, span, parent, start, end, service="api", error=False):
    at = [None if x is None else ZERO + timedelta(microseconds=x) for x in (start, end)]
    return (trace, span, parent, service, "op", *at, error)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed: int, traces: int = 60):
    """Trees with lost parents, cycles, ties, spans without length and spans outside their parents."""
    rng, rows = random.Random(seed), []
    for t in range(traces):
        n = rng.randrange(1, 14)
        for i in range(n):
            start = rng.randrange(0, 12)
            end = start + rng.choice([0, 0, 1, 2, 3, 8, 15])
            up = rng.choice([None if i == 0 else f"s{rng.randrange(i)}"] * 9 + ["gone", f"s{rng.randrange(n)}", ""])
            rows.append(row(f"t{t}", f"s{i}", up, start, end, rng.choice(["a", "b", "c", None]), rng.random() < 0.5))
    return rows


def trees_by_hand(rows):
    """(trace, span) -> (root, depth, path, lost, cycle)."""
    parent = {(r[0], r[1]): r[2] or None for r in rows}
    out = {}
    for trace, span in parent:
        path, at = [span], span
        while True:
            up = parent[(trace, at)]
            if up is None or (trace, up) not in parent:
                out[(trace, span)] = (at, len(path) - 1, path[::-1])
                break
            if up in path:
                out[(trace, span)] = (None, None, None)
                break
            path.append(up)
            at = up
    return out


def micros(r):
    return tuple(round((x - ZERO).total_seconds() * 1e6) for x in (r[5], r[6]))


def kids_by_hand(rows):
    times = {(r[0], r[1]): micros(r) for r in rows}
    kids = defaultdict(list)
    for r in rows:
        key = (r[0], r[2])
        if r[2] and r[2] != r[1] and key in times:
            (s, e), (ps, pe) = times[(r[0], r[1])], times[key]
            if s <= pe and e >= ps:
                kids[key].append((min(e, pe), max(s, ps), r[1]))
    return times, kids


def critical_by_hand(rows):
    """From each root backwards through the children that were waited for."""
    _, kids = kids_by_hand(rows)
    trees = trees_by_hand(rows)
    todo = [k for k, v in trees.items() if v[0] == k[1]]
    on = set(todo)
    while todo:
        key = todo.pop()
        mine = sorted(kids[key], reverse=True)
        until, last = None, None
        for kid in mine:
            if last is None or (kid[0] <= until and kid < last):
                last, until = kid, kid[1]
                if (key[0], kid[2]) not in on:
                    on.add((key[0], kid[2]))
                    todo.append((key[0], kid[2]))
    return on


@pytest.mark.parametrize("seed", [1, 2])
def test_waterfall_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    trees, on = trees_by_hand(rows), critical_by_hand(rows)
    times, kids = kids_by_hand(rows)
    got = {(r["trace_id"], r["span_id"]): r for r in W.trace_waterfall(frame(spark, rows)).collect()}
    assert set(got) == set(trees) and any(v[0] is None for v in trees.values())
    for key, (root, depth, path) in trees.items():
        r = got[key]
        assert (r["root_span_id"], r["depth"], r["path"], r["in_cycle"]) == (root, depth, path, root is None), key
        s, e = times[key]
        covered = len({x for end, begin, _ in kids[key] for x in range(begin, end)})
        assert round(r["self_ms"] * 1000) == e - s - covered, key
        assert r["on_critical_path"] == (key in on), key
        assert round(r["offset_ms"] * 1000) == s - min(v[0] for k, v in times.items() if k[0] == key[0])
    plain = {(r["trace_id"], r["span_id"]): (r["root_span_id"], r["depth"]) for r in W.span_tree(frame(spark, rows), False).collect()}
    assert plain == {k: v[:2] for k, v in trees.items()}


def test_awkward_spans(spark):
    rows = [
        row("t", "a", None, 0, 10), row("t", "a", None, 0, 10), row("t", "b", "a", 2, 6), row("t", "b", "a", 4, 9), row(None, "x", "a", 0, 1),
        row("t", None, "a", 0, 1), row("t", "late", "a", 12, 11), row("t", "timeless", "a", None, None), row("t", "own", "own", 1, 2),
    ]
    got = {r["span_id"]: r for r in W.trace_waterfall(frame(spark, rows)).collect()}
    assert set(got) == {"a", "b", "late", "timeless", "own"}
    assert got["a"]["self_ms"] == 0.006 and got["b"]["self_ms"] == 0.004  # the earlier of the two rows of b
    assert got["late"]["self_ms"] is None and got["timeless"]["self_ms"] is None and got["own"]["in_cycle"]
    assert [got[s]["on_critical_path"] for s in ("a", "b", "late", "timeless", "own")] == [True, True, False, False, False]
    empty = frame(spark, [])
    assert W.trace_waterfall(empty).count() == W.span_tree(empty).count() == W.self_times(empty).count() == R.error_origins(empty).count() == 0


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    kept = forest.written
    monkeypatch.setattr(forest, "written", lambda df, name: rounds.append(name) or kept(df, name))
    rows = [row("t", f"s{i}", f"s{i - 1}" if i else None, i, 1000 - i) for i in range(400)]
    got = W.span_tree(frame(spark, rows), with_path=False).agg(F.max("depth"), F.countDistinct("root_span_id")).first()
    assert tuple(got) == (399, 1) and len(rounds) <= 10


def test_many_calls_one_after_another(spark, monkeypatch):
    rounds = []
    kept = forest.written
    monkeypatch.setattr(forest, "written", lambda df, name: rounds.append(name) or kept(df, name))
    rows = [row("t", "root", None, 0, 30_000)] + [row("t", f"c{i:04}", "root", 10 * i, 10 * i + (12 if i % 3 == 0 else 9)) for i in range(1500)]
    rows += [row("t", "beside", "root", 5, 800)]
    found = W.trace_waterfall(frame(spark, rows), with_path=False).cache()
    on = {r["span_id"] for r in found.filter("on_critical_path").collect()}
    assert on == {s for _, s in critical_by_hand(rows)} and 1000 > len(on) > 900
    assert len(rounds) <= 20
    _, kids = kids_by_hand(rows)
    covered = len({x for end, begin, _ in kids[("t", "root")] for x in range(begin, end)})
    assert round(found.filter("span_id = 'root'").first()["self_ms"] * 1000) == 30_000 - covered


def test_one_trace_is_dealt_to_many_tasks(spark):
    """Every shuffle of the joins is keyed by span, not by trace alone; pieces split the calls of one span."""
    rows = [row("t", "root", None, 0, 100_000)] + [row("t", f"c{i}", "root", 50 * i, 50 * i + 30) for i in range(2000)]
    seen = forest.earlier_max(
        frame(spark, rows[1:]).select("trace_id", F.unix_micros("start_timestamp").alias("at"), F.unix_micros("end_timestamp").alias("v")),
        ["trace_id"], ["at"], F.col("at"), F.unix_micros(F.lit(ZERO)), F.unix_micros(F.lit(ZERO)) + 100_000, "v", "before",
    )
    by_start = sorted((r["at"], r["v"], r["before"]) for r in seen.collect())
    most = None
    for at, v, before in by_start:
        assert before == most
        most = v if most is None else max(most, v)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [max(v" in line]
    assert windows and all("_piece" in line for line in windows)


# --- errors


def origins_by_hand(rows):
    service = {(r[0], r[1]): r[3] for r in rows if r[7]}
    up = {(r[0], r[1]): (r[0], r[2]) for r in rows if r[7] and (r[0], r[2]) in service}
    out = []
    for key in service:
        if key in up.values():
            continue
        way, at = [service[key]], key
        while at in up and len(way) < 100:
            at = up[at]
            way.append(service[at])
        out.append((*key, at[1], len(way) - 1, way[::-1]) if len(way) < 100 else (*key, None, None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_error_origins_match_brute_force(spark, seed):
    rows = random_rows(seed, 120)
    want = origins_by_hand(rows)
    origins = R.error_origins(frame(spark, rows)).cache()
    got = sorted((tuple(r) for r in origins.select("trace_id", "span_id", "entry_span_id", "hops", "services").collect()), key=str)
    assert got == want and max(w[3] or 0 for w in want) >= 3
    causes = {(r["trace_id"], r["entry_span_id"]): r for r in R.root_causes(origins).collect()}
    start = {(r[0], r[1]): micros(r)[0] for r in rows}
    by_entry = defaultdict(list)
    for trace, span, entry, hops, way in want:
        if entry is not None:
            by_entry[(trace, entry)].append((-hops, start[(trace, span)], span, way))
    assert set(causes) == set(by_entry)
    for key, found in by_entry.items():
        hops, _, span, way = min(found, key=lambda f: f[:3])
        r = causes[key]
        assert (r["origin_span_id"], r["hops"], r["origins"], r["origin_service"], r["entry_service"]) == (span, -hops, len(found), way[-1], way[0])
    chains = R.error_chains(origins)
    assert chains.agg(F.sum("error_count")).first()[0] == sum(len(v) for v in by_entry.values())
    reach = R.error_reach(R.root_causes(origins))
    assert reach.agg(F.sum("entry_count")).first()[0] == len(by_entry)
