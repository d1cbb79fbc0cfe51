"""Late rows: kept aside, counted over all batches, and put back into closed windows."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from signalmill.sources import read_stream
from signalmill.streaming import StreamWatch, amended, batches, run_stream, split_late, watermark, with_window

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "id bigint, ts timestamp, v double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if at is None else ZERO + timedelta(minutes=at), 1.0) for i, at in rows], SCHEMA)


def deliver(spark, folder, files):
    for rows in files:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def split(spark, root, files):
    deliver(spark, f"{root}/in", files)
    stream = read_stream(spark, f"{root}/in", SCHEMA, max_files=1)
    run = run_stream(stream, None, f"{root}/check", each_batch=split_late(f"{root}/on", f"{root}/late", f"{root}/marks", "ts", "10 minutes"))
    run.awaitTermination()


def ids(spark, folder):
    return sorted(r["id"] for r in spark.read.schema(SCHEMA).parquet(batches(folder)).collect())


def test_rows_are_split_by_the_watermark_of_earlier_batches(spark, tmp_path):
    files = [[(1, 0), (2, 60), (3, 0)], [(4, 49), (5, 51), (6, None)], [(7, 90), (8, 49)], [(9, 79), (10, 80), (11, 51)]]
    split(spark, tmp_path, files)
    assert ids(spark, f"{tmp_path}/late") == [4, 8, 9, 11]
    assert ids(spark, f"{tmp_path}/on") == [1, 2, 3, 5, 6, 7, 10]
    at = spark.range(1).select(watermark(spark, f"{tmp_path}/marks", "10 minutes").cast("string")).first()[0]
    assert at == "2024-01-01 01:20:00"


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    each = split_late(f"{tmp_path}/on", f"{tmp_path}/late", f"{tmp_path}/marks", "ts", "10 minutes")
    each(frame(spark, [(1, 60)]), 0)
    second = frame(spark, [(2, 0), (3, 200)])
    each(second, 1)
    each(second, 1)
    each(frame(spark, [(4, 100), (5, 195)]), 2)
    assert ids(spark, f"{tmp_path}/late") == [2, 4] and ids(spark, f"{tmp_path}/on") == [1, 3, 5]
    each(frame(spark, []), 3)
    assert ids(spark, f"{tmp_path}/on") == [1, 3, 5]


def test_windows_made_again_hold_their_late_rows(spark, tmp_path):
    files = [[(1, 1), (2, 2), (3, 60)], [(4, 3), (5, 61), (6, 12)], [(7, 120), (8, 62)], [(9, 63), (10, 121)]]
    split(spark, tmp_path, files)

    def make(rows):
        return rows.groupBy("window").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("id")).alias("ids"))

    on = with_window(read_stream(spark, batches(f"{tmp_path}/on"), SCHEMA).withWatermark("ts", "10 minutes"), "ts", "10 minutes")
    run_stream(make(on), f"{tmp_path}/totals", f"{tmp_path}/check2").awaitTermination()
    totals = spark.read.parquet(f"{tmp_path}/totals")
    late = with_window(spark.read.parquet(batches(f"{tmp_path}/late")), "ts", "10 minutes")
    rows = with_window(spark.read.parquet(batches(f"{tmp_path}/on")), "ts", "10 minutes").unionByName(late)
    closed = F.col("window.end") <= watermark(spark, f"{tmp_path}/marks", "10 minutes")
    got = amended(totals, rows, late, ["window"], make, closed)
    want = make(rows).filter(closed)
    assert late.count() == 3 and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 3
    assert sorted(map(str, totals.collect())) != sorted(map(str, want.collect()))


def test_counts_are_of_all_batches(spark, tmp_path):
    """150 batches: a query's own progress keeps the last hundred."""
    deliver(spark, f"{tmp_path}/in", [[(i, 10 * i), (1000 + i, 10 * i - 60 if i >= 10 else 10 * i)] for i in range(150)])
    watch = StreamWatch().watch(spark)
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        once = read_stream(spark, f"{tmp_path}/in", SCHEMA, max_files=1).withWatermark("ts", "10 minutes").dropDuplicates(["id", "ts"])
        once = once.observe("checks", F.count("*").alias("rows"))
        run = run_stream(once, f"{tmp_path}/out", f"{tmp_path}/check", name="counted")
        run.awaitTermination()
        counts = watch.counts(run)
        rows = watch.take(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        watch.stop(spark)
    assert counts.name == "counted" and counts.ended and counts.batches >= 150 > len(run.recentProgress)
    assert counts.input_rows == 300 and counts.late_rows == 140
    assert counts.observed["checks"]["rows"] == 160 == spark.read.parquet(f"{tmp_path}/out").count()
    assert rows.agg(F.sum("input_rows"), F.sum("late_rows")).first()[:] == (300, 140) and watch.take(spark).count() == 0


def test_a_run_that_is_not_known_times_out(spark, tmp_path):
    deliver(spark, f"{tmp_path}/in", [[(1, 1)]])
    run = run_stream(read_stream(spark, f"{tmp_path}/in", SCHEMA), f"{tmp_path}/out", f"{tmp_path}/check")
    run.awaitTermination()
    with pytest.raises(TimeoutError):
        StreamWatch().counts(run, wait=0.1)
