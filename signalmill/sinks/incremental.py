"""Datasets in partitions by day, of which a refresh reads and writes only those that new rows touch.

The source tells when a row came in; a small table beside the target keeps up to when its rows were taken. A
refresh finds the days of the rows that came in since, makes these days again from all their rows, and replaces
their partitions. A repeated or restarted refresh replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MARKS = "until timestamp, days bigint"


def _mark(spark: SparkSession, marks: str) -> datetime | None:
    try:
        return spark.read.schema(MARKS).parquet(marks).agg(F.max("until")).first()[0]
    except AnalysisException:  # the first refresh
        return None


def touched_days(source: DataFrame, ts: str, arrival: str, since: datetime | None) -> tuple[list[date], datetime | None]:
    """Days of the rows that came in after ``since``, and the last arrival. One row a day reaches the driver.

    The bare arrival column is compared, so files that came in before are passed over by their statistics.
    """
    new = source if since is None else source.filter(F.col(arrival) > F.lit(since))
    days = new.groupBy(F.to_date(ts).alias("day")).agg(F.max(arrival).alias("until")).collect()
    return sorted(r["day"] for r in days if r["day"] is not None), max((r["until"] for r in days if r["until"] is not None), default=since)


def refresh_days(
    source: DataFrame, target: str, make: Callable[[DataFrame], DataFrame], ts: str, arrival: str, day: str = "day"
) -> list[date]:
    """Brings ``target`` up to date; returns the days that were made again.

    ``make`` turns rows of whole days of ``ts`` into rows of the target with a date column ``day``, each from
    rows of that day alone. Rows without ``ts`` belong to no day. The mark is written last: a refresh that
    stops before takes the same days again.
    """
    spark = source.sparkSession
    marks = f"{target}_marks"
    days, until = touched_days(source, ts, arrival, _mark(spark, marks))
    if days:
        out = make(source.filter(_on_days(ts, days)))
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day)
        writer.parquet(target)
        spark.createDataFrame([(until, len(days))], MARKS).coalesce(1).write.mode("append").parquet(marks)
    return days


def _on_days(ts: str, days: list[date]) -> Column:
    """Rows of these days, as ranges of the bare column, which reach the file scan; neighbouring days are one range."""
    ranges: list[list[date]] = []
    for d in days:
        if ranges and (d - ranges[-1][1]).days == 1:
            ranges[-1][1] = d
        else:
            ranges.append([d, d])
    found = F.lit(False)
    for first, last in ranges:
        found = found | ((F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < F.date_add(F.lit(last), 1).cast("timestamp")))
    return found


def purge_days(spark: SparkSession, target: str, keep_from: Column, day: str = "day") -> list[date]:
    """Empties the partitions of days before ``keep_from``; the files of all other days stay untouched."""
    table = spark.read.parquet(target)
    held = [r[0] for r in table.filter(F.col(day) < keep_from).select(day).distinct().collect()]
    nothing = table.drop(day).limit(0)
    for d in held:
        nothing.write.mode("overwrite").parquet(f"{target}/{day}={d.isoformat()}")
    return sorted(held)
