"""Lookups by several keys read few row groups; templates equal one pass over a tree; searches read postings."""

from __future__ import annotations

import glob
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from helpers import span
from pyspark.sql import functions as F

from signalmill.operators import templates as T
from signalmill.sinks import layout as L
from signalmill.sinks import rewrite_clustered
from signalmill.sources import read_table

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)


# --- layout


def test_bits_are_interleaved_and_ranges_counted(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(100), rng.choice([None, "a", "b", "cc", "d"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "n int, s string")
    bounds = {"n": [10, 20, 50, 90], "s": ["b", "c"]}
    numbers = [L.range_number(F.col(c), b) for c, b in bounds.items()]
    got = df.select("n", "s", L.z_order(numbers, 3).alias("z"), *(x.alias(f"r{i}") for i, x in enumerate(numbers))).collect()
    for r in got:
        a, b = sum(x <= r["n"] for x in bounds["n"]), 0 if r["s"] is None else sum(x <= r["s"] for x in bounds["s"])
        assert (r["r0"], r["r1"]) == (a, b)
        assert r["z"] == int("".join(f"{a >> i & 1}{b >> i & 1}" for i in (2, 1, 0)), 2)


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """40,000 spans of 64 services, 40 operations and a month, half of them of one service."""
    i, h = F.col("id"), lambda k: F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1 << 30))
    df = spark.range(40_000).select(
        F.when(h(1) % 2 == 0, "hot").otherwise(F.format_string("svc-%02d", h(2) % 63)).alias("service"),
        F.format_string("op-%02d", h(3) % 40).alias("operation"),
        F.timestamp_seconds(F.lit(1_704_067_200) + h(4) % (30 * 86_400)).alias("at"),
        F.md5(i.cast("string").cast("binary")).alias("trace_id"), i.alias("id"),
    )
    path = str(tmp_path_factory.mktemp("z") / "t")
    options = {"parquet.block.size": "8192", "parquet.page.size": "2048", "parquet.block.size.row.check.min": "50"}
    L.rewrite_z_ordered(df, path, ["service", "operation", "at"], {"trace_id": 400}, partitions=128, options=options)
    return df, path


def groups_read(path, column, low, high):
    """Row groups whose statistics allow a value from low to high, and all."""
    hit = whole = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            whole += 1
            hit += s.min <= high and s.max >= low
    return hit, whole


def test_every_key_reads_a_small_share(spark, laid_out):
    df, path = laid_out
    assert read_table(spark, path).exceptAll(df).count() == 0 and read_table(spark, path).count() == 40_000
    shares = {}
    day = ZERO + timedelta(days=11)
    for name, low, high in (("service", "svc-07", "svc-07"), ("operation", "op-23", "op-23"), ("at", day, day + timedelta(hours=12))):
        hit, whole = groups_read(path, name, low, high)
        assert whole >= 100
        shares[name] = hit / whole
    # In random order nearly all groups would be read, sorted by one key all for the others.
    assert all(s < 0.35 for s in shares.values()), shares


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PushedFilters: [IsNotNull(trace_id), EqualTo(trace_id" in text or "EqualTo(trace_id" in text
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_bloom_filters_pass_over_row_groups(spark, laid_out):
    df, path = laid_out
    one = df.filter("id = 777").first()["trace_id"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = read_table(spark, path).filter(F.col("trace_id") == one)
        assert scanned_rows(found) < 4000 and found.count() == 1
        assert scanned_rows(read_table(spark, path).filter(F.col("trace_id") == "8" * 32)) < 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_layout_of_awkward_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None), ("a", 1)], "s string, n int")
    L.rewrite_z_ordered(df, str(tmp_path / "a"), ["s", "n"], partitions=2)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "a")).collect())) == sorted(map(str, df.collect()))
    L.rewrite_z_ordered(df.limit(0), str(tmp_path / "b"), ["s", "n"])
    assert spark.read.parquet(str(tmp_path / "b")).count() == 0
    with pytest.raises(ValueError):
        L.rewrite_z_ordered(df, str(tmp_path / "c"), ["s", "n"], bits=40)


def test_raw_lookback_reaches_the_scan(spark, tmp_path, raw):
    path = str(tmp_path / "raw")
    raw("spans", [span(span_id=str(i), start=i * 3600.0) for i in range(48)]).write.parquet(path)
    recent = L.raw_lookback(spark.read.parquet(path), "start_time_unix_nano", "6 HOURS", F.lit("2024-01-02 12:00:00").cast("timestamp"))
    assert recent.count() == 18
    assert "GreaterThanOrEqual(start_time_unix_nano," in recent._jdf.queryExecution().executedPlan().toString()


# --- templates


def tree_by_hand(bodies, depth, branches):
    """One pass puts every body into a tree; a second reads the templates off it."""
    words = [["<*>" if re.search("[0-9]", w) else w for w in b.split()] for b in bodies]
    way = {tuple(w): list(w) for w in words}
    for place in range(depth):
        nodes = defaultdict(set)
        for w in way.values():
            if len(w) > place:
                nodes[(len(w), tuple(w[:place]))].add(w[place])
        for w in way.values():
            if len(w) > place and len(nodes[(len(w), tuple(w[:place]))]) > branches:
                w[place] = "<*>"
                # the node's words are those of the level as it was
        way = {k: w for k, w in way.items()}
    leaves = defaultdict(set)
    for w in way.values():
        for place in range(depth, len(w)):
            leaves[(len(w), tuple(w[:depth]), place)].add(w[place])
    out = Counter()
    for w in words:
        t = way[tuple(w)]
        out[" ".join("<*>" if i >= depth and len(leaves[(len(t), tuple(t[:depth]), i)]) > 1 else x for i, x in enumerate(t))] += 1
    return out


@pytest.mark.parametrize("depth, branches", [(3, 4), (1, 2), (0, 1), (2, 100)])
def test_templates_equal_one_pass_over_a_tree(spark, depth, branches):
    rng = random.Random(depth)
    kinds = ["user {n} logged in from {w}", "cannot open {w} of {w} now", "{w} failed after {n} ms", "{w}", "done", "GET /a{n} {n} ok", "{w} {w} {w} {w} {w}"]
    fill = lambda t: re.sub(r"\{(.)\}", lambda m: str(rng.randrange(99)) if m[1] == "n" else rng.choice("alpha beta gamma delta eps zeta eta".split()), t)
    bodies = [fill(rng.choice(kinds)) for _ in range(900)] + ["", "  ", "a\tb \n c"]
    df = spark.createDataFrame([(b,) for b in bodies] + [(None,)], "body string").repartition(5)
    got = {r["template"]: r["log_count"] for r in T.log_templates(df, depth=depth, branches=branches).collect()}
    assert got == dict(tree_by_hand(bodies, depth, branches))
    tagged = T.with_template(df, T.template_map(df, depth=depth, branches=branches))
    assert tagged.count() == len(bodies) + 1 and tagged.filter("template IS NULL").count() == 1
    assert T.log_templates(df.limit(0)).count() == 0


def test_search_reads_postings_only(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = [f"w{i:03}" for i in range(300)]
    logs = [(i, " ".join([*rng.choices(vocabulary, k=8), "the"]) + ("!" if i % 2 else " É-x")) for i in range(4000)] + [(4000, None), (4001, "")]
    df = spark.createDataFrame(logs, "id bigint, body string")
    path = str(tmp_path / "postings")
    rewrite_clustered(T.postings(df, ["id"]), path, ["term"], partitions=24)
    posted = read_table(spark, path)
    for terms in (["w007"], ["W007", "the"], ["w001", "w002", "é"], ["missing"]):
        want = sorted(i for i, b in logs if b and all(t.lower() in re.findall(r"[^\W_]+", b.lower()) for t in terms))
        assert sorted(r["id"] for r in T.search(posted, terms, ["id"]).collect()) == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = T.search(posted, ["w007"], ["id"])
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        assert "EqualTo(term,w007)" in plan.toString() or "In(term" in plan.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hit, whole = groups_read(path, "term", "w007", "w007")
    assert hit <= 3 < 20 <= whole
    with pytest.raises(ValueError):
        T.search(posted, [], ["id"])
