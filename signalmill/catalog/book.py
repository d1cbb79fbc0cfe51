"""Registration of queries with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, ShortType, TimestampType

from . import adapters as A
from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Columns that hold the time of the run.
VOLATILE = {
    "ingestion_timestamp", "validation_timestamp", "baseline_computed_at", "detected_at",
}


def comparable(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Types both engines share: bigint, rounded double, zone-less time, no run times."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in VOLATILE:
            continue
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), digits.get(f.name, 6))
        columns.append(c.alias(f.name))
    return df.select(*columns)


def joined(column: str, sep: str = ",") -> F.Column:
    """An array as text, for comparison."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), sep)


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = (), digits: dict[str, int] | None = None):
    """Register a query.

    ``uses`` names the CTEs its SQL builds on. Doubles are rounded to 6
    digits; ``digits`` names columns in which exact halves occur there, which
    engines round apart, and a digit at which they do not.
    """

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, d: comparable(fn(tune(spark), d), digits or {})
        if sql is not None:
            ORACLES[name] = with_ctes(sql, uses)
        return fn

    return add


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "spans": ((), A.SPANS_SQL),
    "logs": ((), A.LOGS_SQL),
    "metrics": ((), A.METRICS_SQL),
    "nested": ((), A.NESTED_SQL),
}


def cte(name: str, sql: str, uses: tuple[str, ...] = ()) -> None:
    CTES[name] = (uses, f"\n{name} AS ({sql})")


def with_ctes(sql: str, uses: tuple[str, ...]) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in uses:
        visit(name)
    if not order:
        return sql
    texts = [CTES[n][1] for n in order]
    return "WITH " + reduce(lambda a, b: f"{a},{b}", texts) + "\n" + sql.strip()
