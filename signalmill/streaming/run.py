"""Event time, stream runs and their progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import is_path


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; zone-less times are read in the session zone, as watermarks need."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def run_stream(
    df: DataFrame,
    target: str | None,
    checkpoint: str,
    trigger: str = "availableNow",
    each_batch: Callable[[DataFrame, int], None] | None = None,
    name: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start an append stream into a table, a parquet folder or a batch function.

    ``availableNow`` takes what is there, in as many micro-batches as the
    source allows, and stops; any other trigger is a processing-time interval
    and runs on. The checkpoint makes a restart continue where the last run
    ended, without repeating output.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(processingTime=trigger)
    if name:
        writer = writer.queryName(name)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    if target is None:
        raise ValueError("a stream needs a target or a batch function")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        return writer.format("parquet").option("path", target).start()
    return writer.option("mergeSchema", "true").toTable(target)


def progress(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: rows in, watermark, state rows and rows dropped as late."""
    out = []
    for p in query.recentProgress:
        state = p["stateOperators"]
        out.append(
            {
                "batch_id": p["batchId"],
                "input_rows": p["numInputRows"],
                "watermark": dict(p["eventTime"] or {}).get("watermark"),
                "state_rows": sum(s["numRowsTotal"] for s in state),
                "late_rows": sum(s["numRowsDroppedByWatermark"] for s in state),
            }
        )
    return out


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped by stateful operators."""
    return sum(p["late_rows"] for p in progress(query))
