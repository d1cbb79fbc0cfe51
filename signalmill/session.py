"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for.
RUNTIME_SETTINGS = {
    # Event times are epoch based; windows and truncation must not depend on the host zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join be split even where an aggregate above it re-uses the
    # join's partitioning: the extra shuffle is only added when skew is found.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of code. Wide projections
    # (metric flattening) reach that when fused into one method; let Spark run
    # such stages as several compiled steps instead: 2 to 4 times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Percentiles and lists of up to this many groups a task are hashed; the default of
    # 128 sorts almost every rollup.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # The default form of timestamps in files has no statistics: lookbacks would read every row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The keys of a day of spans don't fit a heap: stream state lies in RocksDB, and checkpoints hold its changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(name: str = "signalmill", cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="signalmill-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for stream checkpoints and written tables.

    On a cluster this is below ``spark.checkpoint.dir``, which every executor
    can reach. Only a local master may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: later plans start there and survive lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
