"""Forests of any depth: ancestors by pointer doubling, and what comes earlier among siblings.

Nodes are rows of (group, id) with the id of the one above, in the same group. Every join is keyed by group
and id, so one giant group spreads over all partitions, and a node with very many below it is a skewed probe
side, which adaptive execution splits. Nothing is gathered but paths, where they are asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

PIECES = 256


def _known(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def climb(nodes: DataFrame, with_path: bool = True) -> DataFrame:
    """The root of every node, the steps to it, and whether all on the way pass.

    ``nodes``: group, id (distinct in its group), up (null, or an id of the group), ``item`` (what a path lists)
    and ``passes`` (boolean). The result: group, id, root, depth, ``path`` (items from the root to the node),
    ``all_pass`` and ``in_cycle``. A node that leads into a cycle has no root, depth and path, and passes nowhere.

    Each round joins the open nodes with the node they have climbed to and takes over how far that one has
    come, so a node of depth d is settled after log2(d) rounds. Open after k rounds are those 2^k deep and
    deeper; if a round settles none, there is none left of a depth, and the rest lead into cycles.
    """
    path = {"path": F.array("item")} if with_path else {}
    state = nodes.select(
        "group", "id", F.col("up").alias("jump"), F.when(F.col("up").isNull(), F.col("id")).alias("root"),
        F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"), F.col("passes").alias("all_pass"),
        *(c.alias(n) for n, c in path.items()),
    )
    state = written(state, "climb")
    is_open = F.col("jump").isNotNull()
    settled, rest = [state.filter(~is_open)], state.filter(is_open)
    left = rest.count()
    while left:
        above = _known([*settled, rest]).select(
            "group", F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("root").alias("_root"),
            F.col("depth").alias("_depth"), F.col("all_pass").alias("_pass"), *(F.col(n).alias(f"_{n}") for n in path),
        )
        moved = rest.join(above, ["group", "jump"]).select(
            "group", "id", F.col("_jump").alias("jump"), F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("all_pass") & F.col("_pass")).alias("all_pass"), *(F.concat(f"_{n}", n).alias(n) for n in path),
        )
        moved = written(moved, "climb")
        still = moved.filter(is_open)
        now = still.count()
        if now == left:
            break
        settled.append(moved.filter(~is_open))
        rest, left = still, now
    done = _known(settled).drop("jump").withColumn("in_cycle", F.lit(False))
    lost = rest.select(
        "group", "id", F.lit(None).cast("string").alias("root"), F.lit(None).cast("bigint").alias("depth"), F.lit(False).alias("all_pass"),
        *(F.lit(None).cast("array<string>").alias(n) for n in path), F.lit(True).alias("in_cycle"),
    )
    return done.unionByName(lost.select(*done.columns)) if left else done


def mark_ancestors(nodes: DataFrame) -> DataFrame:
    """group and id of the nodes that are marked or above a marked one; ``nodes``: group, id, up, marked; without cycles.

    In round k each marked node marks the one 2^k above it, so the marks below it reach everything in
    between: log2 of the longest way up rounds. Nodes leave the joins once they point nowhere.
    """
    state = written(nodes.select("group", "id", F.col("up").alias("jump"), "marked"), "marks")
    while not state.filter(F.col("jump").isNotNull() & F.col("marked")).isEmpty():
        hit = state.filter("marked AND jump IS NOT NULL").select("group", F.col("jump").alias("id"), F.lit(True).alias("_hit")).distinct()
        above = state.select("group", F.col("id").alias("jump"), F.col("jump").alias("_jump"))
        going = state.filter("jump IS NOT NULL").join(above, ["group", "jump"]).select("group", "id", F.col("_jump").alias("jump"), "marked")
        state = going.unionByName(state.filter("jump IS NULL")).join(hit, ["group", "id"], "left").select(
            "group", "id", "jump", (F.col("marked") | F.coalesce("_hit", F.lit(False))).alias("marked")
        )
        state = written(state, "marks")
    return state.filter("marked").select("group", "id")


def earlier_max(df: DataFrame, keys: list[str], order: list[str], place: Column, low: Column, high: Column, value: str, name: str) -> DataFrame:
    """Adds the greatest ``value`` among rows of the same keys that come earlier in ``order``.

    The rows of a key are dealt to PIECES by ``place``, a number that never falls along the order and lies
    between ``low`` and ``high``. Rows are ordered within a piece; from earlier pieces only the greatest
    value of each is passed on. So the rows of one key are no single task's work.
    """
    share = F.try_divide((place - low) * F.lit(float(PIECES)), high - low)
    piece = F.greatest(F.lit(0), F.least(F.lit(PIECES - 1), F.floor(F.coalesce(share, F.lit(0.0))).cast("int")))
    dealt = df.withColumn("_piece", piece)
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pieces = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    most = dealt.groupBy(*keys, "_piece").agg(F.max(value).alias("_most"))
    carried = most.select(*keys, "_piece", F.max("_most").over(pieces).alias("_carried"))
    within = dealt.withColumn("_within", F.max(value).over(inside))
    return within.join(carried, [*keys, "_piece"]).withColumn(name, F.greatest("_within", "_carried")).drop("_piece", "_within", "_carried")
