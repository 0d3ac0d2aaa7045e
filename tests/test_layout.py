"""Skew-split window writes: bounded tasks and files, whatever the windows hold."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.sinks import layout
from tidewater.streaming import windows as ingest

START = datetime(2024, 1, 1)


def _rows(spark, n, seconds, tasks=8):
    ts = F.timestamp_add("SECOND", F.expr(seconds).cast("int"), F.lit(START).cast("timestamp_ntz"))
    return spark.range(0, n, 1, tasks).select("id", ts.alias("ts"), F.lit(0).cast("long").alias("window_id"))


def _files(spark, path, window):
    folder = f"{path}/window_id={window}"
    return [f"{folder}/{n}" for n in paths.list_names(spark, folder) if n.endswith(".parquet")]


def _counts(spark, files):
    return [spark.read.parquet(f).count() for f in files]


def test_one_window_gives_several_bounded_files_by_time(spark, scratch):
    path = scratch("one")
    ingest.write_windows(_rows(spark, 8000, "id"), path, time_col="ts", target_bytes=16 * 1000)   # ts, id: 16 of 24
    files = _files(spark, path, 0)
    counts = _counts(spark, files)
    assert sum(counts) == 8000 and max(counts) <= 8000 // 12 + 1 and 12 <= len(files) <= 20
    spans = sorted(spark.read.parquet(f).agg(F.min("ts"), F.max("ts")).first()[:] for f in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))       # files cover ranges of time


def test_files_do_not_grow_with_tasks(spark, scratch):
    n = []
    for tasks in (2, 32):
        path = scratch("tasks")
        ingest.write_windows(_rows(spark, 4000, "id", tasks), path, time_col="ts", target_bytes=24 * 1000)
        n.append(len(_files(spark, path, 0)))
    assert n[0] == n[1] and 4 <= n[0] <= 6


def test_hot_instant_is_split(spark, scratch):
    path = scratch("hot")
    ingest.write_windows(_rows(spark, 9000, "if(id % 3 = 0, 5, id)"), path, time_col="ts", target_bytes=24 * 500)
    counts = _counts(spark, _files(spark, path, 0))
    assert sum(counts) == 9000 and max(counts) <= 500


def test_many_small_windows_share_tasks(spark, scratch):
    path = scratch("small")
    df = _rows(spark, 1000, "id").withColumn("window_id", F.col("id") % 100)
    ingest.write_windows(df, path, time_col="ts", drop_time=True, target_bytes=1 << 20)
    got = spark.read.parquet(path)
    assert got.columns == ["id", "window_id"] and got.count() == 1000
    assert all(len(_files(spark, path, w)) == 1 for w in range(100))


def test_without_time_column_and_with_unhashable_columns(spark, scratch):
    path = scratch("hash")
    df = _rows(spark, 2000, "id").drop("ts").withColumn("m", F.create_map(F.lit("a"), "id"))
    ingest.write_windows(df, path, target_bytes=8000)
    counts = _counts(spark, _files(spark, path, 0))
    assert sum(counts) == 2000 and len(counts) > 2


def test_equal_times_null_times_and_empty_windows(spark, scratch):
    path = scratch("edge")
    wins = [ingest.Window(i, START, START) for i in range(3)]
    df = _rows(spark, 100, "0").withColumn("ts", F.when(F.col("id") % 2 == 0, F.col("ts")))
    ingest.write_windows(df, path, windows=wins, time_col="ts", target_bytes=100)
    ingest.write_windows(df.withColumn("window_id", F.lit(2).cast("long")), path, windows=wins, time_col="ts")
    got = spark.read.parquet(path)
    assert got.count() == 100 and {r.window_id for r in got.select("window_id").distinct().collect()} == {2}
    ingest.write_windows(df.limit(0), path, windows=wins, time_col="ts")
    assert paths.list_names(spark, f"{path}/window_id=2") == []


def test_null_or_too_many_groups_are_refused(spark, scratch, monkeypatch):
    with pytest.raises(ValueError):
        ingest.write_windows(_rows(spark, 5, "id").withColumn("window_id", F.lit(None).cast("long")), scratch("x"))
    monkeypatch.setattr(layout, "MAX_GROUPS", 3)
    with pytest.raises(ValueError):
        ingest.write_windows(_rows(spark, 5, "id").withColumn("window_id", F.col("id")), scratch("y"))


def test_small_window_over_a_long_time(spark, scratch):
    path = scratch("long")
    ingest.write_windows(_rows(spark, 10, "id * 1000000"), path, time_col="ts")
    assert spark.read.parquet(path).count() == 10


def test_plan_parts():
    got, n = layout.plan_parts({1: [10], 2: [10, 95, 250, 10], 3: [0]}, 100)
    assert got == {1: ([0], [1]), 2: ([0, 1, 2, 5], [1, 1, 3, 1]), 3: ([5], [1])} and n == 6
    assert layout.plan_parts({1: [300]}, 100) == ({1: ([0], [3])}, 3)


def test_catch_up_goes_in_bounded_chunks(spark, scratch, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_PENDING", 4)
    seen = []
    control = ingest.ControlTable(spark, f"{scratch('chunks')}/control")
    df = spark.createDataFrame([(1, START)], "id long, ts timestamp_ntz")
    done = ingest.run_windows(spark, "s", df, "ts", control, lambda d, p: seen.append(len(p)), START,
                              START + timedelta(hours=10), timedelta(hours=1))
    assert seen == [4, 4, 2] and [w.window_id for w in done] == [6, 7, 8, 9]
    assert control.last("s").window_id == 9
