"""Table and file scans, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name: str, schema: StructType | str | None = None) -> DataFrame:
    """Batch scan of a catalog table or a parquet folder."""
    if not is_path(name):
        return spark.read.table(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(name)


def read_stream(
    spark: SparkSession,
    name: str,
    schema: StructType | str | None = None,
    max_files: int | None = None,
    files: str | None = None,
) -> DataFrame:
    """Streaming scan. ``max_files`` bounds the files taken into one micro-batch.

    A folder needs its schema up front; nothing is inferred from data files.
    ``files`` is a glob on file names, for folders that hold more than one table.
    """
    reader = spark.readStream
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not is_path(name):
        return reader.table(name)
    if schema is None:
        raise ValueError("a streamed folder needs an explicit schema")
    return reader.schema(schema).parquet(name)
