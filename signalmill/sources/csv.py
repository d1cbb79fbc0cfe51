"""CSV exports of the raw signals: every cell is text, nested columns are JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..schemas import struct


def parse_signal(df: DataFrame, signal: str) -> DataFrame:
    """Type the text columns of a signal; bad JSON or numbers become NULL, absent columns too."""
    have = set(df.columns)
    columns = []
    for f in struct(signal).fields:
        if f.name not in have:
            parsed = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            parsed = F.from_json(F.col(f"`{f.name}`"), f.dataType)
        else:
            parsed = F.col(f"`{f.name}`").try_cast(f.dataType)
        columns.append(parsed.alias(f.name))
    return df.select(*columns)


def load_signal_csv(spark: SparkSession, path: str, signal: str, header: list[str] | None = None) -> DataFrame:
    """Read one signal. ``header`` gives the column order and saves the pass over the file head."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", False)
    if header is not None:
        reader = reader.schema(StructType([StructField(n, StringType()) for n in header]))
    return parse_signal(reader.csv(path), signal)
