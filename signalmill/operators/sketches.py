"""Percentiles and distinct counts that merge: KLL and HLL sketches as columns of the finest rollup.

The 1-minute table carries, beside its sums, a sketch of its values and one of its distinct ids. Coarser windows
merge sketches, as they add up sums, so any resolution comes from the 1-minute table without the raw rows, and
its percentiles are those of all values, not a percentile of percentiles.

Error: a KLL sketch of size k answers for any quantile with one whose rank is off by RANK_ERROR of the values at
most (99 % confidence, k = 800), however often it was merged; up to about k values it is exact. An HLL sketch
of 2^12 registers counts distinct ids with a relative error of 1.6 % (one standard deviation), hardly any below
a few hundred. Both are of bounded size, so a hot group is combined on the map side like any sum.

Null and NaN values are counted as samples but in no sketch; a group without values has null percentiles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.predicates import lookback, of_type
from ..schemas import NUMBER_TYPES
from .rollups import SERIES

K = 800
RANK_ERROR = 0.0045
LG_REGISTERS = 12
RESOLUTIONS: dict[str, str] = {"1min": "1 minute", "5min": "5 minutes", "1hour": "1 hour", "1day": "1 day"}
QUANTILES: dict[str, float] = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _summed(value: str) -> list[Column]:
    x = F.when(~F.isnan(value), F.col(value))
    return [
        F.count("*").alias("sample_count"), F.count(x).alias("value_count"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
        F.sum(x).alias("sum_value"), F.kll_sketch_agg_double(value, K).alias("value_sketch"),
    ]


def _distinct(who: Column) -> Column:
    return F.hll_sketch_agg(who, LG_REGISTERS).alias("distinct_sketch")


def _windows(df: DataFrame, keys: list[str], ts: str, size: str, delay: str | None, aggregates: list[Column]) -> DataFrame:
    timed = df.withWatermark(ts, delay) if delay else df
    grouped = timed.groupBy(*keys, F.window(ts, size).alias("window")).agg(*aggregates)
    return C.unnest_window(grouped)


def metric_sketches(metrics: DataFrame, size: str = "1 minute", delay: str | None = None, types: tuple[str, ...] | None = NUMBER_TYPES) -> DataFrame:
    """Sums, the sketch of values, and that of distinct attribute sets per series and window, batch or stream."""
    metrics = metrics if types is None else of_type(metrics, *types)
    entries = F.array_sort(F.map_entries("attributes"))
    return _windows(metrics, SERIES, "metric_timestamp", size, delay, [*_summed("value"), _distinct(F.to_json(entries))])


def health_sketches(spans: DataFrame, size: str = "1 minute", delay: str | None = None) -> DataFrame:
    """Sums and errors, the sketch of durations, and that of distinct traces per service and window, batch or stream."""
    errors = F.count_if(F.col("is_error")).alias("error_count")
    return _windows(spans, ["service_name"], "start_timestamp", size, delay, [errors, *_summed("duration_ms"), _distinct(F.col("trace_id"))])


def merge_sketches(
    rollup: DataFrame, keys: list[str], resolutions: Mapping[str, str] = RESOLUTIONS,
    interval: str | None = None, as_of: Column | None = None,
) -> DataFrame:
    """Rows of every resolution (``resolution``, keys, window_start, window_end) from one scan of a finer rollup.

    Each row of the rollup goes to one window of each resolution; rows of a window are combined in each task
    before they are shuffled.
    """
    recent = lookback(rollup, "window_start", interval, as_of)
    labels = [F.struct(F.lit(label).alias("resolution"), C.floor_to("window_start", size).alias("at")) for label, size in resolutions.items()]
    sums = {"sample_count": F.sum, "value_count": F.sum, "min_value": F.min, "max_value": F.max, "sum_value": F.sum}
    sums |= {"error_count": F.sum} if "error_count" in rollup.columns else {}
    dealt = recent.select(F.explode(F.array(*labels)).alias("to"), *keys, *sums, "value_sketch", "distinct_sketch")
    merged = dealt.groupBy(F.col("to.resolution").alias("resolution"), *keys, F.col("to.at").alias("window_start")).agg(
        *(merge(name).alias(name) for name, merge in sums.items()),
        F.kll_merge_agg_double("value_sketch", K).alias("value_sketch"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
    )
    end = F.lit(None).cast("timestamp")
    for label, size in resolutions.items():
        end = F.when(F.col("resolution") == label, F.col("window_start") + F.expr(f"INTERVAL {size}")).otherwise(end)
    return merged.withColumn("window_end", end)


def with_answers(sketched: DataFrame, quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """The rollup with avg_value, the quantiles and distinct_count in place of its sketches."""
    held = F.kll_sketch_get_n_double("value_sketch") > 0
    asked = F.when(held, F.kll_sketch_get_quantile_double("value_sketch", F.array(*(F.lit(q) for q in quantiles.values()))))
    return sketched.withColumns(
        {
            "avg_value": F.try_divide("sum_value", "value_count"), "_q": asked,
            "distinct_count": F.hll_sketch_estimate("distinct_sketch"),
        }
    ).withColumns({name: F.get("_q", F.lit(i)) for i, name in enumerate(quantiles)}).drop("_q", "value_sketch", "distinct_sketch")


def rank_errors(values: DataFrame, keys: list[str], value: str, sketched: DataFrame, quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """How far each answered quantile's rank among the values is from what was asked: keys, quantile, asked, rank_error.

    ``sketched`` has the keys and a column for each quantile. The rank of an answer is any share between that of the
    smaller values and that of those up to it; the error is the distance to the nearest.
    """
    named = F.explode(F.array(*(F.struct(F.lit(n).alias("quantile"), F.lit(q).alias("asked"), F.col(f"`{n}`").alias("answer")) for n, q in quantiles.items())))
    answers = sketched.select(F.struct(*keys).alias("_key"), named.alias("a")).select("_key", "a.*")
    mine = values.select(F.struct(*keys).alias("_key"), F.col(value).alias("_v"))
    ranks = mine.join(answers, "_key").groupBy("_key", "quantile", "asked").agg(
        (F.count_if(F.col("_v") < F.col("answer")) / F.count("_v")).alias("low"), (F.count_if(F.col("_v") <= F.col("answer")) / F.count("_v")).alias("high")
    )
    off = F.greatest(F.col("low") - F.col("asked"), F.col("asked") - F.col("high"), F.lit(0.0))
    return ranks.select("_key.*", "quantile", "asked", off.alias("rank_error"))
