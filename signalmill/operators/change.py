"""Change points and trends of series: recursive scores, split over time by composing them.

Two scores follow a series, each row's from the row before it:

    ewma         e' = alpha * x + (1 - alpha) * e, from the first value on
    cusum        up' = max(0, up + z - slack), down' = max(0, down - z - slack), both from 0

with z the value's distance from its target in units of its scale. A sum that passes ``alarm`` is a change.

A block of rows takes any state before it to the state after it by few numbers, and blocks compose: for e by
what is added and the factor of what was, for a sum by its total and its least running total. So blocks of up
to BLOCK rows of a series and time chunk are summed up apart, each series' blocks (a row for every BLOCK of
its rows) are put together in order, and every block's rows then take their scores from its start. A series
of any length is many tasks' work. What is left at the end is the state that the next rows go on from: the
same composition carries a stream from batch to batch.

Rows of a series are ordered by time, ties by value. Rows without time, value, target or scale, or that are
not later than the state of their series, are kept and have no scores.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as C
from ..sources.tables import is_path

BLOCK = 256
SCORES = ["ewma", "cusum_up", "cusum_down", "change"]


@dataclass(frozen=True)
class ChangeRules:
    """How fast the mean follows, how far values may stray (in scales), and what a sum must pass."""

    alpha: float = 0.3
    slack: float = 0.5
    alarm: float = 5.0
    chunk: str = "1 day"

    def __post_init__(self):
        # (1 - alpha) ** -BLOCK must be a number.
        if not 0 < self.alpha <= 0.9:
            raise ValueError("alpha lies above 0 and is 0.9 at most")


def _power(q: float, n: Column) -> Column:
    return F.pow(F.lit(q), n)


def _blocks(rows: DataFrame, rules: ChangeRules) -> DataFrame:
    """Rows with chunk, block and place, and their scores as if each block were the series' first."""
    q = 1 - rules.alpha
    in_chunk = Window.partitionBy("key", "chunk").orderBy("at", "x")
    in_block = Window.partitionBy("key", "chunk", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    number = F.row_number().over(in_chunk) - 1
    placed = rows.withColumn("chunk", C.floor_to("at", rules.chunk)).withColumn("number", number).select(
        "*", F.floor(F.col("number") / BLOCK).cast("bigint").alias("block"), (F.col("number") % BLOCK).alias("place")
    )
    weighed = F.sum(rules.alpha * F.col("x") * _power(q, -F.col("place"))).over(in_block)
    sums = placed.select(
        "*", (weighed * _power(q, F.col("place"))).alias("e"),
        F.sum(F.col("z") - rules.slack).over(in_block).alias("up"), F.sum(-F.col("z") - rules.slack).over(in_block).alias("down"),
    )
    return sums.select("*", F.min("up").over(in_block).alias("up_least"), F.min("down").over(in_block).alias("down_least")).drop("number")


def _after(state: Column, block: Column, q: float) -> Column:
    """The state after a block."""
    return F.struct(
        (block["e"] + _power(q, block["n"]) * state["e"]).alias("e"),
        (block["up"] - F.least(-state["up"], block["up_least"])).alias("up"),
        (block["down"] - F.least(-state["down"], block["down_least"])).alias("down"),
    )


def score_changes(
    rows: DataFrame, keys: list[str], value: str, target: Column, scale: Column, rules: ChangeRules = ChangeRules(),
    ts: str = "timestamp", state: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All rows with ewma, cusum_up, cusum_down and change ('up' or 'down' where a sum passes the alarm), and the state after them.

    The state has a row per series: key (a struct of the keys), at (its last time), e, up and down. Given
    one, scores go on from it.
    """
    q = 1 - rules.alpha
    x = F.col(value).cast("double")
    key = F.struct(*(F.col(k) for k in keys)).alias("key")
    whole = rows.select(F.struct(*rows.columns).alias("row"), key, F.col(ts).alias("at"), x.alias("x"), F.try_divide(x - target, scale).alias("z"))
    known = F.col("at").isNotNull() & F.col("x").isNotNull() & F.col("z").isNotNull() & ~F.isnan("z")
    if state is None:
        whole = whole.withColumn("last", F.lit(None).cast("timestamp"))
    else:
        whole = whole.join(state.select("key", F.col("at").alias("last")), "key", "left")
    counts = F.coalesce(known & (F.col("last").isNull() | (F.col("at") > F.col("last"))), F.lit(False))
    local = _blocks(whole.filter(counts).drop("last"), rules)

    last = lambda name: F.max_by(name, "place").alias(name)
    blocks = local.groupBy("key", "chunk", "block").agg(
        F.count("*").alias("n"), F.min_by("x", "place").alias("first"), last("e"), last("up"), last("down"),
        F.min("up").alias("up_least"), F.min("down").alias("down_least"), F.max("at").alias("until"),
    )
    fields = ["chunk", "block", "n", "first", "e", "up", "down", "up_least", "down_least", "until"]
    series = blocks.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("blocks"))
    fresh = F.struct(F.col("blocks")[0]["first"].alias("e"), F.lit(0.0).alias("up"), F.lit(0.0).alias("down"))
    if state is None:
        series = series.withColumn("begin", fresh)
    else:
        kept = state.select("key", F.struct("e", "up", "down").alias("kept"))
        series = series.join(kept, "key", "left").withColumn("begin", F.coalesce("kept", fresh)).drop("kept")
    begun = F.struct(F.col("begin").alias("now"), F.array().cast("array<struct<chunk:timestamp,block:bigint,e:double,up:double,down:double>>").alias("starts"))
    start = lambda s, b: F.struct(b["chunk"].alias("chunk"), b["block"].alias("block"), s["e"].alias("e"), s["up"].alias("up"), s["down"].alias("down"))
    walked = F.aggregate(
        "blocks", begun,
        lambda s, b: F.struct(_after(s["now"], b, q).alias("now"), F.concat(s["starts"], F.array(start(s["now"], b))).alias("starts")),
    )
    walked = series.select("key", F.element_at("blocks", -1)["until"].alias("at"), walked.alias("walked"))

    starts = walked.select("key", F.inline("walked.starts")).withColumnsRenamed({"e": "e0", "up": "up0", "down": "down0"})
    scored = local.join(starts, ["key", "chunk", "block"]).select(
        "row", "key", "chunk", "block", "place", "up0", "down0",
        (F.col("e") + _power(q, F.col("place") + 1) * F.col("e0")).alias("ewma"),
        (F.col("up") - F.least(-F.col("up0"), F.col("up_least"))).alias("cusum_up"),
        (F.col("down") - F.least(-F.col("down0"), F.col("down_least"))).alias("cusum_down"),
    )
    by_place = Window.partitionBy("key", "chunk", "block").orderBy("place")

    def passes(name: str, begin: str) -> Column:
        return (F.col(name) > rules.alarm) & (F.coalesce(F.lag(name).over(by_place), F.col(begin)) <= rules.alarm)

    change = F.when(passes("cusum_up", "up0"), "up").when(passes("cusum_down", "down0"), "down")
    scored = scored.select("row.*", "ewma", "cusum_up", "cusum_down", change.alias("change"))
    others = whole.filter(~counts).select("row.*", *(F.lit(None).cast("double").alias(s) for s in SCORES[:3]), F.lit(None).cast("string").alias("change"))
    reached = walked.select("key", "at", "walked.now.*")
    if state is not None:
        reached = reached.unionByName(state.join(reached.select("key"), "key", "left_anti").select("key", "at", "e", "up", "down"))
    return scored.unionByName(others), reached


def score_batches(
    target: str, states: str, keys: list[str], value: str, at: Column, scale: Column, rules: ChangeRules = ChangeRules(), ts: str = "timestamp"
) -> Callable[[DataFrame, int], None]:
    """For ``run_stream``: scores each micro-batch into the folder ``target`` and carries the state in ``states``.

    States lie in two folders that batches use in turn, so a batch that is run again finds the state it began
    with, and replaces what it wrote. Rows come in the order of time, batch by batch; later ones have no scores.
    """
    if not (is_path(target) and is_path(states)):
        raise ValueError("scores and states are kept in folders")

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = spark.read.parquet(f"{states}/{(number - 1) % 2}") if number else None
        scored, reached = score_changes(batch, keys, value, at, scale, rules, ts, state)
        scored.write.mode("overwrite").parquet(f"{target}/batch={number}")
        reached.write.mode("overwrite").parquet(f"{states}/{number % 2}")

    return one
