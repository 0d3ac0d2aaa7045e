"""Faults that lost or doubled rows: fractional windows, narrow batches, key types,
crashed swaps, empty replays, capped window batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.operators.cells import column_cells
from tidewater.operators.upsert import upsert_table
from tidewater.sinks import files
from tidewater.sinks.jdbc import merge_statement
from tidewater.sources.text import parse_lines
from tidewater.sources.windows import read_window
from tidewater.operators.groups import complete_groups
from tidewater.streaming.completeness import completeness_batch
from tidewater.streaming.delivery import decode_bodies, drain, start_delivery, write_batch
from tidewater.streaming.window_source import window_stream
from tidewater.streaming.windows import ControlTable, poll_windows, write_window


def test_fractional_bounds(spark):
    t0 = datetime(2024, 1, 1)
    df = spark.range(120).select(F.timestamp_add("MICROSECOND", F.col("id") * 250000, F.lit(t0).cast("timestamp_ntz")).alias("t"))
    step = timedelta(seconds=1.5)
    assert sum(read_window(df, "t", t0 + i * step, t0 + (i + 1) * step).count() for i in range(20)) == 120


@pytest.mark.parametrize("buckets", [1, 3])
def test_keyed_table_refuses_what_would_lose_rows(spark, scratch, buckets):
    path = scratch("keyed")
    full = spark.createDataFrame([(i, 1, "v", "w") for i in range(10)], "k int, o int, v string, w string")
    upsert_table(spark, path, full, ["k"], ["o"], buckets)
    with pytest.raises(ValueError):
        upsert_table(spark, path, full.drop("w"), ["k"], ["o"], buckets)
    with pytest.raises(TypeError):
        upsert_table(spark, path, full.withColumn("k", F.col("k").cast("long")), ["k"], ["o"], buckets)
    upsert_table(spark, path, full.withColumn("o", F.lit(2)), ["k"], ["o"], buckets)
    got = spark.read.parquet(path)
    assert got.count() == 10 and got.where("w = 'w' AND o = 2").count() == 10


def test_frame_without_statistics_gets_few_buckets(spark, scratch):
    path = scratch("sized")
    assert files.table_buckets(spark, path, spark.createDataFrame([(1,), (2,)], "k int")) == 1


def test_upsert_after_crashed_rebucket_keeps_rows(spark, scratch, monkeypatch):
    path = scratch("crash")
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("o"))
    upsert_table(spark, path, df, ["k"], ["o"], 2)
    calls, real = [0], paths.rename

    def failing(s, a, b):
        if b == path or a == path:
            calls[0] += 1
            if calls[0] == 2:
                raise OSError("crash")
        return real(s, a, b)
    monkeypatch.setattr(paths, "rename", failing)
    with pytest.raises(OSError):
        files.rebucket(spark, path, ["k"], 4)
    monkeypatch.setattr(paths, "rename", real)
    upsert_table(spark, path, df.limit(2).withColumn("o", F.lit(2)), ["k"], ["o"])
    got = spark.read.parquet(path)
    assert got.count() == 100 and got.where("o = 2").count() == 2


def test_empty_replay_clears(spark, scratch):
    df = spark.range(5)
    a, b = scratch("batch"), scratch("window")
    for path, write in ((a, write_batch), (b, write_window)):
        write(df, path, 0)
        write(df, path, 1)
        write(df.limit(0), path, 1)
        assert spark.read.parquet(path).count() == 5


def test_capped_windows_are_drained(spark, scratch):
    start, seen, mark = datetime(2024, 1, 1), [], scratch("mark")

    def run():
        s = window_stream(spark, start, timedelta(seconds=1), end=start + timedelta(seconds=10), max_windows=3)
        return start_delivery(s, mark, lambda df, i: seen.extend(r.window_id for r in df.collect()))
    drain(run)
    assert sorted(seen) == list(range(10))


def test_small_operator_faults(spark):
    assert parse_lines(spark.createDataFrame([("6  17",)], "value string"), sep=" ").good.count() == 1
    cells = column_cells(spark.createDataFrame([("a", 1)], "k string, ts int"), "k", ["ts"], "f", ["ts"]).collect()
    assert cells[0].qualifier == "ts" and cells[0].value == "1" and cells[0].ts == 1
    assert "UPDATE" not in merge_statement("t", "s", ["k"], ["k"], [])


def test_strict_decode_keeps_wrong_types_and_null_keys_apart(spark):
    bodies = ['{"k":1,"v":1.5}', '{"k":"abc","v":1.5}', '{"v":2.0}', '{"k":null}', "[1]", '[{"k":1}]', "x", "", None, "{}",
              ' {"k":2,"v":null}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    dec = decode_bodies(df, "body", "k bigint, v double", "quarantine", required=["k"])
    assert [tuple(r) for r in dec.good.select("event.*").orderBy("k").collect()] == [(1, 1.5), (2, None)]
    assert {r.body for r in dec.bad.collect()} == {b for b in bodies[1:8] if b} | {"{}"}
    with pytest.raises(Exception, match="undecodable"):
        decode_bodies(df, "body", "k bigint, v double").good.collect()


def test_update_keeps_columns_it_does_not_name(spark, scratch):
    path = scratch("partial")
    full = spark.createDataFrame([(i, 1, "v", "w") for i in range(10)], "k int, o int, v string, w string")
    upsert_table(spark, path, full, ["k"], ["o"], 3)
    some = spark.createDataFrame([(1, 2, "new"), (1, 3, "newer"), (2, 0, "old"), (99, 2, "none")], "k int, o int, v string")
    upsert_table(spark, path, some, ["k"], ["o"], mode="update")
    got = {r.k: (r.o, r.v, r.w) for r in spark.read.parquet(path).collect()}
    assert len(got) == 10 and got[1] == (3, "newer", "w") and got[2] == (1, "v", "w")


def test_poll_backs_off_logs_and_gives_up(spark, scratch, caplog):
    slept = []

    def broken(rows, pending):
        raise OSError("sink is down")
    t0 = datetime(2024, 1, 1)
    df = spark.range(1).select(F.lit(t0).cast("timestamp_ntz").alias("t"))
    with pytest.raises(OSError):
        poll_windows(spark, "s", df, "t", ControlTable(spark, scratch("mark")), broken, t0, timedelta(hours=1), 1000,
                     now=lambda: t0 + timedelta(hours=1), sleep=slept.append, max_failures=4)
    assert slept == [1.0, 2.0] and "sink is down" in caplog.text


def test_completeness_takes_any_number_of_names(spark, scratch):
    names = [f"n{i}" for i in range(130)]
    df = spark.createDataFrame([("a", n) for n in names] + [("b", n) for n in names[:-1]], "g string, m string")
    assert [r.g for r in complete_groups(df, "g", "m", names).collect()] == ["a"]
    fn = completeness_batch(scratch("state"), out := scratch("out"), "g", "m", names, buckets=2)
    fn(df.where("m <> 'n7'"), 0)
    fn(df.where("m = 'n7'"), 1)
    assert [r.g for r in spark.read.parquet(out).collect()] == ["a"]


def test_columns_with_the_names_of_partitions_are_refused(spark, scratch):
    with pytest.raises(ValueError):
        write_batch(spark.range(1).withColumn("batch_id", F.lit(7)), scratch("taken"), 0)
    with pytest.raises(ValueError):
        upsert_table(spark, scratch("taken"), spark.range(1).selectExpr("id", "1 AS o", "7 AS bucket"), ["id"], ["o"])
