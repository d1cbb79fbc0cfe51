"""Baselines by the hour of the week: median and median absolute deviation, from counts that add up.

The state is a table of how often each value occurred per service, metric, day and hour of the week. Counts of
different days are different rows, so a new day is added (or an old one replaced) without reading the others, and
the lookback drops whole days. Values are rounded to ``digits``, which bounds the rows of a day whatever the
traffic; over the rounded values median and deviation are exact.

Hours of the week count from Monday 0:00 UTC (0) to Sunday 23:00 (167).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Decimal places that values are counted with.
DIGITS: dict[str, int] = {"error_rate": 4, "p95_latency_ms": 2, "total_requests": 0}
KEYS = ["service_name", "hour_of_week", "metric"]
STATE = "service_name string, hour_of_week int, metric string, value double, n bigint, day date"
NORMAL = 1.4826  # the standard deviation of normal values, in median absolute deviations


def hour_of_week(ts: Column) -> Column:
    return F.weekday(ts) * 24 + F.hour(ts)


def seasonal_counts(health: DataFrame, digits: Mapping[str, int] = DIGITS, ts: str = "timestamp") -> DataFrame:
    """The state of these rows: one map-side combined count. Null and non-finite values are not counted."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.round(F.col(m).cast("double"), d).alias("value")) for m, d in digits.items())))
    at = F.col(ts)
    rows = health.filter(at.isNotNull()).select("service_name", hour_of_week(at).alias("hour_of_week"), F.to_date(at).alias("day"), each.alias("each"))
    value = F.col("each.value")
    counted = rows.select(*KEYS[:2], "each.metric", (value + 0.0).alias("value"), "day").filter(F.abs(value) < float("inf"))
    return counted.groupBy(*KEYS, "value", "day").agg(F.count("*").alias("n")).select(*KEYS, "value", "n", "day")


def update_counts(health: DataFrame, path: str, since: Column, until: Column, digits: Mapping[str, int] = DIGITS, ts: str = "timestamp") -> None:
    """Puts the days from ``since`` up to ``until`` (without it) into the state at ``path``; other days stay as they are.

    Only these days' rows are read, and a repeated run replaces what it wrote: no row counts twice. Both
    bounds are dates.
    """
    recent = health.filter((F.col(ts) >= since) & (F.col(ts) < until))
    write = seasonal_counts(recent, digits, ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy("day").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def seasonal_baselines(counts: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """service_name, hour_of_week, metric, median, mad and samples, over the days from ``since`` up to ``until``.

    Days are summed first, so that later steps read one row per value.
    """
    days = counts if since is None else counts.filter(F.col("day") >= since)
    days = days if until is None else days.filter(F.col("day") < until)
    values = days.groupBy(*KEYS, "value").agg(F.sum("n").alias("n"))
    hour = Window.partitionBy(*KEYS)  # a row per value: as many as digits allow, not as there are samples
    middle = values.withColumn("median", F.percentile("value", 0.5, F.col("n")).over(hour))
    off = F.abs(F.col("value") - F.col("median"))
    return middle.groupBy(*KEYS).agg(
        F.first("median").alias("median"), F.percentile(off, 0.5, F.col("n")).alias("mad"), F.sum("n").alias("samples")
    )


def seasonal_anomalies(
    health: DataFrame, baselines: DataFrame, most: float = 5.0, least_samples: int = 4, digits: Mapping[str, int] = DIGITS, ts: str = "timestamp"
) -> DataFrame:
    """Values more than ``most`` robust deviations from their hour's median.

    service_name, timestamp, metric, value, median, mad, robust_z. Hours with fewer than ``least_samples``
    or without any spread tell nothing.
    """
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in digits)))
    rows = health.select("service_name", F.col(ts).alias("timestamp"), hour_of_week(F.col(ts)).alias("hour_of_week"), each.alias("each"))
    rows = rows.select(*KEYS[:2], "timestamp", "each.*")
    known = baselines.filter((F.col("samples") >= least_samples) & (F.col("mad") > 0))
    off = (F.col("value") - F.col("median")) / (F.col("mad") * NORMAL)
    return rows.join(known.drop("samples"), KEYS).select(
        "service_name", "timestamp", "metric", "value", "median", "mad", off.alias("robust_z")
    ).filter(F.abs("robust_z") > most)
