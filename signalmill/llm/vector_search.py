"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, so that all are of equal length and the largest inner product is the
least distance, and a random rotation, so that any leading components are a sample of all. Lists
around centroids (fitted on at most SAMPLE vectors) hold every vector. As many lists are probed as give
RECALL of the true neighbours within that sample. Within each probed list the
columns are read in blocks: distances grow block by block, and after each block a hypothesis test
abandons the candidates whose distance so far, scaled up, lies above the k-th best one by more than
chance allows (EPSILON). What remains is measured exactly, in double precision on the original
vectors.

At scale: of equal vectors only the k + 1 with the least ids can be among anyone's k nearest, so the
others are left out before lists are built, and equal queries are searched once; neither loses a
neighbour. A list is cut into chunks of about CHUNK rows, each searched by its own task, so a full
list spreads. Only centroids go to all tasks, at most MOST_LISTS.

Defined cases: vectors that are null or zero, hold null, NaN or infinite components, or are of
another length than most (of equally many: the longer) take no part, as queries neither; vectors of any finite
size take part: distances are measured in a unit near the largest component; null ids take no part; fewer candidates than k are all returned; repeated ids are candidates each, ties go
to the smaller id; an empty table gives no rows; extra columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .packed import ready, stored

SAMPLE = 20_000
MOST_LISTS = 16_384
CHUNK = 8_192
BLOCK = 16
EPSILON = 2.5
RECALL = 0.94  # of the nearest among the sample, that its lists must give
SEED = 7


def taking_part(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def k_means(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(SEED))
    centers = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centers, 1)[:, 0]
        count = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        some = count > 0
        centers[some] = sums[some] / count[some, None]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centers of each row, nearest first."""
    out = np.empty((len(x), k), np.int64)
    half = (centers**2).sum(axis=1) / 2
    for a in range(0, len(x), 4096):
        far = half - x[a : a + 4096] @ centers.T
        best = np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(centers) else np.tile(np.arange(len(centers)), (len(far), 1))
        order = np.argsort(np.take_along_axis(far, best, 1), axis=1, kind="stable")
        out[a : a + 4096] = np.take_along_axis(best, order, 1)
    return out


def probes_for(x: np.ndarray, centers: np.ndarray, k: int, recall: float) -> int:
    """How many lists a query must probe for this recall, measured among the fitted vectors themselves."""
    asked = x[:: max(1, len(x) // 300)]
    true = nearest(asked, x, min(k + 1, len(x)))
    ranks = np.argsort(nearest(asked, centers, len(centers)), axis=1)
    at = np.take_along_axis(ranks, nearest(x, centers, 1)[:, 0][true], 1)
    if true.shape[1] > 1:
        at = at[:, 1:]  # the nearest is the asking vector
    found = np.cumsum(np.bincount(at.ravel(), minlength=len(centers))) / at.size
    return int(np.searchsorted(found, recall) + 1)


def lengthened(v: np.ndarray, longest: float, turn: np.ndarray, query: bool = False, unit: float = 1.0) -> np.ndarray:
    """Rows in units, with the component that makes them equally long (queries: 0), rotated."""
    v = v * unit
    extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(longest**2 - (v**2).sum(axis=1), 0))
    return np.column_stack([v, extra]) @ turn


def scan(q: np.ndarray, original_q: np.ndarray, x: np.ndarray, original: np.ndarray, ids: np.ndarray, k: int, so_far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and inner products of about the k best rows for one query. ``x`` is held by column blocks; ``so_far``: distances in the first."""
    size = sum(b.shape[1] for b in x)
    alive = np.arange(len(ids))
    seen = x[0].shape[1]
    if len(ids) > k:
        first = np.argpartition(so_far, k - 1)[:k]
        whole = so_far[first].copy()
        at = seen
        for b in x[1:]:
            whole += ((b[first] - q[at : at + b.shape[1]]) ** 2).sum(axis=1)
            at += b.shape[1]
        limit = whole.max()
        for b in x[1:]:
            # The test: a distance is within (1 + EPSILON / sqrt(d)) of its estimate from d components but for rare chance.
            keep = so_far * (size / seen) <= limit * (1 + EPSILON / np.sqrt(seen)) ** 2
            alive, so_far = alive[keep], so_far[keep]
            so_far = so_far + ((b[alive] - q[seen : seen + b.shape[1]]) ** 2).sum(axis=1)
            seen += b.shape[1]
        alive = alive[so_far <= limit * (1 + 1e-9) + 1e-9]
    products = (original[alive] * original_q).sum(axis=1)
    order = np.lexsort((ids[alive], -products))[:k]
    return ids[alive][order], products[order]


def _vectors(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.zeros((0, 0))


def search(vectors: DataFrame, queries: Column, k: int = 20, vector: str = "embedding", id_column: str = "vec_id", recall: float = RECALL) -> DataFrame:
    """The k nearest of every row for which ``queries`` holds: query_id, rank, vec_id, score."""
    spark = ready(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & taking_part(F.col("v")))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = usual["n"] if usual else 1
    rows = rows.filter(F.size("v") == size)

    same = W.partitionBy("v").orderBy("id")
    candidates = rows.select("id", "v").withColumn("i", F.row_number().over(same)).filter(F.col("i") <= k + 1).drop("i")
    # A vector's length is its largest component times sqrt(squares): no square overflows.
    largest = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    candidates = stored(candidates.withColumn("largest", largest).withColumn("squares", squares), "search-vectors")
    count, most = candidates.agg(F.count("*"), F.max("largest")).first()
    # The unit is a power of two, so that it changes no digit of a component.
    unit = float(2.0 ** -np.clip(np.frexp(most)[1], -1000, 1000)) if most else 1.0
    longest = candidates.agg(F.max(F.col("largest") * F.lit(unit) * F.sqrt("squares"))).first()[0] or 0.0
    share = min(1.0, SAMPLE / max(count, 1))
    chosen = candidates.filter(F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    turn = rotation(size + 1)
    sample = _vectors(chosen.select("v").limit(2 * SAMPLE).toPandas()["v"])
    if not len(sample):
        sample = _vectors(candidates.select("v").limit(1).toPandas()["v"])
    sample = lengthened(sample, longest, turn, unit=unit) if len(sample) else np.zeros((1, size + 1))
    sample = sample[np.lexsort(sample.T[:3])]  # whatever order the rows came in
    lists = int(min(MOST_LISTS, max(1, np.sqrt(count) / 4), len(sample)))
    fitted = k_means(sample, lists)
    probes = min(lists, probes_for(sample, fitted, k, recall))
    centers = spark.sparkContext.broadcast(fitted)

    def place(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            v = lengthened(_vectors(batch["v"]), longest, turn, unit=unit) if len(batch) else np.zeros((0, size + 1))
            batch["list"] = nearest(v, centers.value, 1)[:, 0]
            yield batch[["list", "id", "v"]]

    placed = stored(candidates.select("id", "v").mapInPandas(place, "list bigint, id bigint, v array<double>"), "search-lists")
    filled = {r[0]: -(-r[1] // CHUNK) for r in placed.groupBy("list").count().collect()}
    chunks_of = np.array([filled.get(i, 0) for i in range(lists)], np.int64)

    def deal(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            spread = (batch["id"].to_numpy(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            at = batch["list"].to_numpy()
            batch["chunk"] = (spread % chunks_of[at].astype(np.uint64)).astype(np.int64)
            yield batch[["list", "chunk", "id", "v"]]

    def probe(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            near = nearest(lengthened(_vectors(batch["v"]), longest, turn, query=True, unit=unit), centers.value, probes)
            times = chunks_of[near].sum(axis=1)
            row = np.repeat(np.arange(len(batch)), times)
            flat = near.ravel()
            yield pd.DataFrame(
                {
                    "list": np.repeat(flat, chunks_of[flat]),
                    "chunk": np.concatenate([np.arange(c) for c in chunks_of[flat]]) if len(flat) else flat,
                    "q": batch["q"].to_numpy()[row],
                    "v": batch["v"].to_numpy()[row],
                }
            )

    def look(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names, hits, products = [], [], []
        if len(part) and len(asked):
            original, ids = _vectors(part["v"]), part["id"].to_numpy(np.int64)
            turned = lengthened(original, longest, turn, unit=unit)
            edges = [0, *range(2 * BLOCK, size + 1, BLOCK), size + 1]
            blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(edges, edges[1:])]
            qs = _vectors(asked["v"])
            ts = lengthened(qs, longest, turn, query=True, unit=unit)
            for a in range(0, len(qs), 64):
                # The first block's distances, for many queries at once.
                lead = ts[a : a + 64, : blocks[0].shape[1]]
                begun = (lead**2).sum(axis=1)[:, None] - 2 * (lead @ blocks[0].T) + (blocks[0] ** 2).sum(axis=1)[None]
                for name, q, t, d in zip(asked["q"].to_numpy()[a : a + 64], qs[a : a + 64], ts[a : a + 64], begun):
                    found, score = scan(t, q, blocks, original, ids, k + 1, d)
                    names.append(np.full(len(found), name))
                    hits.append(found)
                    products.append(score)
        if not names:
            return pd.DataFrame({"q": [], "vec_id": [], "score": []})
        return pd.DataFrame({"q": np.concatenate(names), "vec_id": np.concatenate(hits), "score": np.concatenate(products)})

    asking = rows.filter("asks").select("id", "v")
    # Equal queries are searched once, under the least id among them.
    asked = asking.groupBy("v").agg(F.min("id").alias("q"))
    cells = placed.mapInPandas(deal, "list bigint, chunk bigint, id bigint, v array<double>").groupBy("list", "chunk")
    probing = asked.mapInPandas(probe, "list bigint, chunk bigint, q bigint, v array<double>").groupBy("list", "chunk")
    found = cells.cogroup(probing).applyInPandas(look, "q bigint, vec_id bigint, score double")
    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("i", F.row_number().over(best)).filter(F.col("i") <= k + 1).drop("i")
    listed = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("near"))
    named = asking.join(asked, "v").select(F.col("id").alias("query_id"), "q").join(listed, "q")
    others = named.select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score")
    )
