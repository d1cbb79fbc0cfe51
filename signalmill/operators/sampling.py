"""Sampling of whole traces, by chance and by what they hold, with the weights that make totals right again.

A trace's number in [0, 1) comes from a digest of its id alone, so every run, batch and stream decides alike,
services that sample apart keep the same traces, and a lower rate keeps a subset of what a higher one keeps.
A row that stands for 1 / p others carries that as ``weight``. Spans without a trace id are told apart by
their span id.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C


@dataclass(frozen=True)
class KeepRules:
    """What a tail sampler keeps: failing and slow traces whole, others with the rate of the service that they entered by."""

    rate: float = 0.1
    errors: bool = True
    slow_ms: float | None = None
    rates: Mapping[str, float] = field(default_factory=dict)
    seed: str = "sample"

    def __post_init__(self):
        for rate in (self.rate, *self.rates.values()):
            if not 0 < rate <= 1:
                raise ValueError("a rate lies above 0 and is 1 at most: nothing else can be weighted")


def trace_key() -> Column:
    return F.coalesce(F.col("trace_id"), F.concat(F.lit("span:"), F.col("span_id")), F.lit(""))


def chance(key: Column, seed: str) -> Column:
    """A number in [0, 1) for each key: 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def sample_traces(spans: DataFrame, rate: float, seed: str = "sample") -> DataFrame:
    """The spans of a share of all traces, with weight; a filter, batch or stream."""
    rules = KeepRules(rate=rate, seed=seed)
    return spans.filter(chance(trace_key(), rules.seed) < rate).withColumn("weight", F.lit(1.0 / rate))


def trace_decisions(spans: DataFrame, rules: KeepRules, by: tuple[Column, ...] = ()) -> DataFrame:
    """What is decided for every trace: key, entry_service, span_count, duration_ms, has_error, reason, weight and kept.

    One map-side combined aggregate. ``by`` tells parts of a trace apart. The entry service is that of the
    root that starts first, or of the span that starts first; ties: the least span id.
    """
    is_child = C.blank_to_null(F.col("parent_span_id")).isNotNull()
    first = F.min_by("service_name", F.struct(is_child, F.col("start_timestamp").isNull(), "start_timestamp", "span_id"))
    found = spans.groupBy(trace_key().alias("key"), *by).agg(
        first.alias("entry_service"), F.count("*").alias("span_count"),
        C.ts_diff_ms(F.min("start_timestamp"), F.max("end_timestamp")).alias("duration_ms"),
        F.coalesce(F.bool_or("is_error"), F.lit(False)).alias("has_error"),
    )
    slow = F.lit(False) if rules.slow_ms is None else F.coalesce(F.col("duration_ms") >= rules.slow_ms, F.lit(False))
    fails = F.col("has_error") if rules.errors else F.lit(False)
    rate = F.lit(rules.rate)
    for service, its in rules.rates.items():
        rate = F.when(F.col("entry_service") == service, its).otherwise(rate)
    share = F.when(fails | slow, 1.0).otherwise(rate)
    return found.select(
        *found.columns, F.when(fails, "error").when(slow, "slow").otherwise("chance").alias("reason"),
        (F.lit(1.0) / share).alias("weight"), (chance(F.col("key"), rules.seed) < share).alias("kept"),
    )


def tail_sample(spans: DataFrame, rules: KeepRules) -> DataFrame:
    """The spans of kept traces, whole, with reason and weight.

    Traces are decided by one aggregate; spans then meet the kept ones, keyed so that both sides are dealt
    anew and a giant trace is split among tasks.
    """
    kept = trace_decisions(spans, rules).filter("kept").select(F.struct("key").alias("_key"), "reason", "weight")
    return spans.withColumn("_key", F.struct(trace_key().alias("key"))).join(kept, "_key").drop("_key")


def tail_sample_stream(spans: DataFrame, rules: KeepRules, gap: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """``tail_sample`` on a stream: spans wait in state until their trace is decided, and leave with its decision.

    A trace is a session: spans of one id, each no more than ``gap`` after the one before. It is decided when
    the watermark passes its end by the gap; its spans, joined by id and time, then come out whole or not at
    all. The join can't tell from a session's end how early it began, so its state keeps every span: it grows
    with the stream. Spans of an id that come back after the gap are decided
    anew, as ``tail_sample_sessions`` does for a batch.
    """
    timed = spans.withWatermark("start_timestamp", delay)
    return _with_sessions(timed, timed, rules, gap)


def tail_sample_sessions(spans: DataFrame, rules: KeepRules, gap: str = "1 minute") -> DataFrame:
    """What ``tail_sample_stream`` gives, of a batch."""
    return _with_sessions(spans, spans, rules, gap)


def _with_sessions(spans: DataFrame, timed: DataFrame, rules: KeepRules, gap: str) -> DataFrame:
    decided = trace_decisions(timed, rules, (F.session_window("start_timestamp", gap).alias("session"),)).filter("kept")
    kept = decided.select("key", F.col("session.start").alias("_from"), F.col("session.end").alias("_to"), "session", "reason", "weight")
    mine = spans.withColumn("_key", trace_key())
    joined = mine.join(kept, (F.col("_key") == F.col("key")) & (F.col("start_timestamp") >= F.col("_from")) & (F.col("start_timestamp") < F.col("_to")))
    return joined.drop("_key", "key", "_from", "_to", "session")


def weighted_totals(sample: DataFrame, by: list[str]) -> DataFrame:
    """Estimates of what all spans would give: span_count, error_count, duration_ms, each with its standard error.

    Traces are kept or not independently, so a total's variance is the sum over traces of w (w - 1) y^2,
    with a trace's weight w and its share y of the total.
    """
    values = {"span_count": F.count("*"), "error_count": F.count_if(F.col("is_error")), "duration_ms": F.coalesce(F.sum("duration_ms"), F.lit(0.0))}
    per_trace = sample.groupBy(*by, trace_key().alias("key"), "weight").agg(*(v.cast("double").alias(n) for n, v in values.items()))
    w = F.col("weight")
    return per_trace.groupBy(*by).agg(
        F.count("*").alias("sampled_traces"), F.sum(w).alias("traces"),
        *(F.sum(w * F.col(n)).alias(n) for n in values),
        *(F.sqrt(F.sum(w * (w - 1) * F.col(n) * F.col(n))).alias(f"{n}_error") for n in values),
    )
