"""Table and folder writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.columns import now
from ..operators.rollups import rerollup
from ..session import written
from ..sources.tables import is_path


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write a catalog table, or a parquet folder when ``name`` is a path."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(name):
        writer.parquet(name)
    else:
        writer.saveAsTable(name)


def append_if_any(df: DataFrame, name: str) -> bool:
    """Append the rows unless there are none; tells whether anything was written.

    The plan runs once: its rows are counted on their way to the shared folder, and taken from there.
    """
    seen = Observation()
    rows = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), "append")
    if not seen.get["rows"]:
        return False
    write_table(rows, name, "append")
    return True


def register_rollup_views(spark: SparkSession, rollup: DataFrame | None = None) -> None:
    """Five-minute and hourly rollups as views on the one-minute rollup."""
    base = spark.table("metrics_1min_rollup") if rollup is None else rollup
    rerollup(base, "5 minutes").createOrReplaceTempView("metrics_5min_rollup_view")
    rerollup(base, "1 hour").createOrReplaceTempView("metrics_hourly_rollup_view")


def rewrite_clustered(
    df: DataFrame, path: str, columns: list[str], partitions: int | None = None, target_rows: int = 5_000_000
) -> None:
    """Rewrite a table laid out by ``columns``, so that file and row-group statistics prune lookups.

    A hash of the row is the last range key: it lets a value that fills many
    files be cut into several ranges instead of landing in one task.
    """
    keys = [F.col(c) for c in columns]
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    spread = F.xxhash64(*plain)
    ranged = (
        df.repartitionByRange(*keys, spread) if partitions is None
        else df.repartitionByRange(partitions, *keys, spread)
    )
    (
        ranged.sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", target_rows)
        .parquet(path)
    )


def purge_older_than(df: DataFrame, ts: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """What a retention run keeps. A row without a time is kept: its age is unknown."""
    return df.filter((F.col(ts) >= now(as_of) - F.expr(f"INTERVAL {interval}")) | F.col(ts).isNull())
