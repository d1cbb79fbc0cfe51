"""Duplicate removal, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType


def attribute_key(attributes: Column) -> Column:
    """Map as a comparable value, its entries in key order."""
    return F.sort_array(F.map_entries(attributes))


def attribute_text(attributes: Column) -> Column:
    """Map of texts as one text, its entries in key order: a third of the key's size. Lengths keep different maps apart."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.array_join(F.transform(attribute_key(attributes), lambda e: F.concat(part(e["key"]), part(e["value"]))), "")


def row_order(df: DataFrame, newest: str = "ingestion_timestamp", more: tuple[Column, ...] = ()) -> list[Column]:
    """An order of copies that depends on their content alone: the newest first, then by a hash of the row and ``more``."""
    parts = []
    for f in df.schema.fields:
        kind, column = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if isinstance(f.dataType, MapType) and kind.count("map<") == 1:
            parts.append(attribute_key(column))
        elif "map<" in kind:
            parts.append(F.to_json(column))
        elif f.name != newest:
            parts.append(column)
    first = [F.desc(newest)] if newest in df.columns else []
    return [*first, F.xxhash64(*parts, *more)]


def dedup(
    df: DataFrame,
    keys: list[str],
    watermark: tuple[str, str] | None = None,
    within: bool = False,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """One row per key.

    Batch: the first copy by ``order_by`` survives, by default that of
    ``row_order``, so a retry or a rerun keeps the same one. Each task first
    reduces its own copies to one row, so a key repeated in a third of the
    table sends one row per task through the shuffle.

    Stream: ``watermark`` is (event-time column, delay). With the event time
    among the keys, state is dropped behind the watermark; otherwise pass
    ``within=True`` to bound the state by the delay.
    """
    if watermark is not None:
        df = df.withWatermark(*watermark)
        return df.dropDuplicatesWithinWatermark(keys) if within else df.dropDuplicates(keys)
    if set(keys) == set(df.columns):
        return df.dropDuplicates(keys)
    return latest_per_key(df, keys, row_order(df) if order_by is None else order_by)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    The rank filter is pushed below the shuffle as a per-task limit of one row
    per key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank <= 1").drop("_rank")
