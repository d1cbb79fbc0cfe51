"""Late rows kept: they go to a table of their own, and what was closed without them is made again.

``split_late`` stands before stateful streams. It holds the watermark that they would have (the greatest event
time of earlier batches, less the delay) and sends rows behind it to a side table. The streams read the other
table: its files come in the order of the batches, so their own watermark is never ahead of the one that the
rows passed, and they drop nothing. Closed windows are then amended from the rows themselves, for the keys that
late rows touch only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _there(spark: SparkSession, folder: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException:  # no such folder
        return None


def _folder(number: int) -> str:
    return f"{number:012d}"


def split_late(on_time: str, late: str, marks: str, ts: str, delay: str) -> Callable[[DataFrame, int], None]:
    """For ``run_stream``: each micro-batch's rows into a folder of ``on_time`` or ``late``; ``marks`` keeps the watermark.

    Rows without an event time are on time. A batch that is run again leaves what it finished as it is and
    writes the rest; the on-time folder comes last, so that readers see each batch once. Marks lie in two
    folders that batches use in turn.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if _there(spark, f"{on_time}/{_folder(number)}", batch.schema) is not None:
            return
        mark = spark.read.schema("latest timestamp").parquet(f"{marks}/{(number - 1) % 2}").first()["latest"] if number else None
        behind = F.lit(False) if mark is None else F.coalesce(F.col(ts) < F.lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        batch = batch.persist()
        try:
            latest = batch.agg(F.greatest(F.max(ts), F.lit(mark).cast("timestamp")).alias("latest"))
            batch.filter(behind).write.mode("overwrite").parquet(f"{late}/{_folder(number)}")
            latest.write.mode("overwrite").parquet(f"{marks}/{number % 2}")
            batch.filter(~behind).write.mode("overwrite").parquet(f"{on_time}/{_folder(number)}")
        finally:
            batch.unpersist()

    return one


def batches(folder: str) -> str:
    """What to read, in a batch or a stream, of a folder that ``split_late`` writes."""
    return f"{folder}/*"


def watermark(spark: SparkSession, marks: str, delay: str) -> Column:
    """The watermark after the last batch, for a later query."""
    latest = spark.read.schema("latest timestamp").parquet(f"{marks}/*").agg(F.max("latest")).first()[0]
    return F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}")


def amended(
    totals: DataFrame, rows: DataFrame, late: DataFrame, keys: list[str], make: Callable[[DataFrame], DataFrame], closed: Column | None = None
) -> DataFrame:
    """``totals`` of a stream, with every group that late rows touch made again from all its rows.

    ``rows`` are all rows, late ones included, and ``late`` those alone; both have the keys, and ``make`` gives
    totals of rows. ``closed`` (on the keys) leaves out groups that the stream has not closed yet: it will
    close them without their late rows, so call again then. Only touched groups are read.
    """
    touched = late.select(F.struct(*keys).alias("_key")).distinct()
    if closed is not None:
        touched = late.filter(closed).select(F.struct(*keys).alias("_key")).distinct()
    key = F.struct(*keys)
    again = make(rows.withColumn("_key", key).join(touched, "_key", "left_semi").drop("_key"))
    kept = totals.withColumn("_key", key).join(touched, "_key", "left_anti").drop("_key")
    return kept.unionByName(again.select(*totals.columns))


def with_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Rows with the window that streams group them by."""
    return df.withColumn("window", F.window(ts, size))
