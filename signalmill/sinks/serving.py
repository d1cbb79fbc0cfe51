"""Keyed serving copy: the latest row per primary key of an append-only table.

Every micro-batch writes one folder holding its own latest rows. Replaying a
batch overwrites its folder, so a restart changes nothing. Readers resolve the
latest row per key; ``compact`` folds the folders into one. The cost of a batch
follows the size of the batch, never that of the table.

With ``fold_every``, the sink itself folds all that came before into one row a key, in a folder of its own, with
every so many batches. A fold counts once it is listed, after it was written, so a run that stops in between
folds again. A read then takes the last fold and the batches since: never more than ``fold_every`` batches
beyond one row a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedup import latest_per_key
from ..schemas import SERVING_KEYS

BATCH = "_batch_id"


def _newest_first(order_by: list[str]) -> list:
    return [F.desc(c) for c in order_by]


def _folds(target: str) -> str:
    return f"{target}_folds"


def _last_fold(spark: SparkSession, target: str) -> int | None:
    """The batch up to which rows are folded."""
    try:
        return spark.read.schema("until bigint").parquet(_folds(target) + "/listed").agg(F.max("until")).first()[0]
    except AnalysisException:  # none yet
        return None


def _current(spark: SparkSession, target: str, until: int | None = None) -> DataFrame:
    """The last fold and the batches since."""
    folded = _last_fold(spark, target)
    rows = spark.read.parquet(target)
    since = rows if folded is None else rows.filter(F.col(BATCH) > folded)
    if until is not None:
        since = since.filter(F.col(BATCH) <= until)
    if folded is None:
        return since
    return since.unionByName(spark.read.parquet(f"{_folds(target)}/{folded}").withColumn(BATCH, F.lit(-1).cast(since.schema[BATCH].dataType)))


def upsert_latest(target: str, keys: list[str], order_by: list[str], fold_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds the latest rows of a micro-batch to ``target``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, keys, _newest_first(order_by))
        latest.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")
        spark = batch.sparkSession
        if fold_every and (batch_id + 1) % fold_every == 0 and (_last_fold(spark, target) or -1) < batch_id:
            rows = _current(spark, target, batch_id)
            whole = latest_per_key(rows, keys, [*_newest_first(order_by), F.desc(BATCH)]).drop(BATCH)
            whole.write.mode("overwrite").parquet(f"{_folds(target)}/{batch_id}")
            spark.createDataFrame([(batch_id,)], "until bigint").coalesce(1).write.mode("append").parquet(_folds(target) + "/listed")

    return write


def serve(name: str, target: str, order_by: list[str], fold_every: int | None = 100) -> Callable[[DataFrame, int], None]:
    """``upsert_latest`` of a dataset by its own key (``SERVING_KEYS``)."""
    return upsert_latest(target, SERVING_KEYS[name], order_by, fold_every)


def read_latest(spark: SparkSession, target: str, keys: list[str], order_by: list[str]) -> DataFrame:
    """Current row per key; of equal order values the later batch wins, and a batch before a fold."""
    return latest_per_key(_current(spark, target), keys, [*_newest_first(order_by), F.desc(BATCH)]).drop(BATCH)


def compact(spark: SparkSession, target: str, into: str, keys: list[str], order_by: list[str]) -> None:
    """Write the current rows as the first batch of a new folder."""
    read_latest(spark, target, keys, order_by).write.mode("overwrite").parquet(f"{into}/{BATCH}=-1")
