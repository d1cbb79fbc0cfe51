"""Vector search against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from signalmill.llm.vector_search import lengthened, probes_for, k_means, rotation, search

SCHEMA = "vec_id bigint, embedding array<float>, v string, id string, norm2 string, list string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def by_hand(rows, asks, k):
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows]
    out = {}
    for q, x in good:
        if asks(q):
            scored = sorted((-float((x * y).sum()), i) for i, y in good if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(spark, rows, asks, k):
    out = {}
    for r in search(table(spark, rows), asks, k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((12, 24))
    x = (centers[rng.integers(0, 12, 2500)] + rng.standard_normal((2500, 24))) * rng.uniform(0.3, 2, (2500, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got, want = found(spark, rows, F.col("vec_id") % 20 == 0, 20), by_hand(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    score = {(q, i): s for q, v in by_hand(rows, lambda q: q % 20 == 0, 2500).items() for i, s in v}
    assert all(abs(score[q, i] - s) < 1e-9 for q, v in got.items() for i, s in v)


def test_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(6)
    same = rng.standard_normal(8).tolist()
    rows = [(i, same) for i in range(200)] + [(1000 + i, rng.standard_normal(8).tolist()) for i in range(20)]
    got = found(spark, rows, F.col("vec_id").isin(0, 150, 1001), 5)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[150]] == [0, 1, 2, 3, 4]
    assert got[1001] == by_hand(rows, lambda q: q == 1001, 5)[1001] or len(got[1001]) == 5


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(50, None), (51, [0.0, 0.0]), (52, [1.0, None]), (53, [nan, 1.0]), (54, [inf, 1.0]), (55, []), (56, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 1.0])]
    got = found(spark, rows + odd, F.lit(True), 20)
    assert {q for q in got} == {1, 2, 3} and {i for v in got.values() for i, _ in v} == {1, 2, 3}
    repeated = found(spark, [*rows, (1, [2.0, 0.5])], F.col("vec_id") == 3, 20)
    assert repeated == {3: [(1, 0.5), (2, 0.5), (1, 0.0)]}
    assert search(table(spark, []), F.lit(True)).count() == 0
    assert search(table(spark, odd[:6]), F.lit(True)).count() == 0
    assert found(spark, [(7, [1.0, 2.0])], F.lit(True), 3) == {}


def test_the_turned_space_keeps_the_order():
    rng = np.random.default_rng(7)
    x, q = rng.standard_normal((50, 9)), rng.standard_normal((1, 9))
    turn, longest = rotation(10), float(np.linalg.norm(x, axis=1).max())
    far = ((lengthened(x, longest, turn) - lengthened(q, longest, turn, query=True)) ** 2).sum(axis=1)
    assert (np.argsort(far) == np.argsort(-(x @ q[0]))).all()
    centers = k_means(x, 5)
    assert 1 <= probes_for(x, centers, 5, 0.9) <= 5 and probes_for(x, centers, 5, 1.0) <= 5


def test_vectors_of_any_finite_size(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(40)]
    schema = SCHEMA.replace("array<float>", "array<double>")
    for huge in (1e200, 1e-200, 1e307):
        some = [*rows, (40, [huge, huge, -huge, huge])]
        df = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in some], schema)
        got = {}
        for r in search(df, F.col("vec_id") % 10 == 0, 20).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        for q in (0, 10, 20, 30):
            scored = sorted((-float(np.dot(some[q][1], v)), i) for i, v in some if i != q)
            assert got[q] == [i for _, i in scored[:20]], (huge, q)
        assert len(got[40]) == 20
