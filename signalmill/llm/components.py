"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .packed import stored


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id and component (the least id that it reaches) of every id in ``links`` (columns a, b).

    Each round hangs every id's larger neighbours, then its smaller ones, on its least neighbour,
    and ends when nothing moves. Neighbours are only summed up to their least one, never gathered;
    each round's links are written to the shared folder, so plans stay short and survive lost
    executors.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = stored(edges, "links")
    mark = None
    for _ in range(most_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = _star(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, least)
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stored(edges.filter("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
