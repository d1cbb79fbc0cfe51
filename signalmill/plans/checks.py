"""Expectations of datasets: counted as rows are written, rows that break them apart from the others.

A quarantined dataset is one table in two partitions, ``_ok`` 1 and 0, written by one plan or one stream;
rows that break an expectation carry the names in ``_violations``. ``valid_rows`` and ``quarantined`` read one of
the two; the other's files are never opened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..operators.quality import expect
from .registry import Dataset

RESULTS = "dataset string, run_id string, expectation string, action string, rows bigint, failed bigint"


def _broken(predicates: dict[str, str]) -> Column:
    """Names of the predicates that a row breaks; a null outcome breaks."""
    names = [F.when(~F.coalesce(F.expr(p), F.lit(False)), F.lit(n)) for n, p in predicates.items()]
    return F.array_compact(F.array(*names))


class Checked:
    """A dataset's rows under its expectations."""

    def __init__(self, entry: Dataset):
        self.entry = entry
        self.partition_by = ["_ok"] if entry.action == "quarantine" and entry.expectations else None

    def _counts(self) -> list[Column]:
        return [F.count("*").alias("rows")] + [
            F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(n) for n, p in self.entry.expectations.items()
        ]

    def _acted(self, df: DataFrame) -> DataFrame:
        if not self.entry.expectations:
            return df
        if self.partition_by:
            broken = df.withColumn("_violations", _broken(self.entry.expectations))
            return broken.withColumn("_ok", (F.size("_violations") == 0).cast("int"))
        return expect(df, self.entry.expectations, self.entry.action)

    def watched(self, df: DataFrame) -> DataFrame:
        """Of a stream: counts reach its listeners under the dataset's name."""
        return self._acted(df.observe(self.entry.name, *self._counts()) if self.entry.expectations else df)

    def observed(self, df: DataFrame) -> tuple[DataFrame, Callable[[], dict | None]]:
        """Of a batch: the rows, and the counts once they were written."""
        if not self.entry.expectations:
            return df, lambda: None
        seen = Observation(self.entry.name)
        return self._acted(df.observe(seen, *self._counts())), lambda: seen.get


def results_of(entry: Dataset, counts: dict | None, run_id: str) -> list[tuple]:
    """One row for each expectation; a run without batches saw no rows."""
    found = counts or {}
    return [(entry.name, run_id, n, entry.action, found.get("rows", 0), found.get(n, 0)) for n in entry.expectations]


def valid_rows(df: DataFrame) -> DataFrame:
    """The rows of a dataset that keep its expectations; all, where nothing is quarantined."""
    return df.filter("_ok = 1").drop("_ok", "_violations") if "_ok" in df.columns else df


def quarantined(df: DataFrame) -> DataFrame:
    """The rows that break an expectation, with ``_violations``."""
    return df.filter("_ok = 0").drop("_ok")
