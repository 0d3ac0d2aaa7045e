"""Completeness on the state store, byte admission, and draining by default."""

from datetime import datetime, timedelta

import pytest

from tidewater import paths
from tidewater.streaming import completeness, delivery
from tidewater.streaming.window_source import window_stream

SCHEMA = "id long, g string, m string"


def _drop_last_commit(spark, ckpt):
    last = max((n for n in paths.list_names(spark, f"{ckpt}/commits") if n.isdigit()), key=int)
    paths.delete(spark, f"{ckpt}/commits/{last}")


def _run(spark, rows, scratch, required, files=3):
    root = scratch("state")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartitionByRange(files, "id").write.parquet(src)
    for i in range(3):
        stream = delivery.read_file_stream(spark, src, df.schema)
        completeness.start_complete(stream, ckpt, out, "g", "m", required).awaitTermination()
        if i == 0:
            _drop_last_commit(spark, ckpt)
    got = spark.read.schema("g string, batch_id long").parquet(out).collect()
    return sorted(((r.g, r.batch_id) for r in got), key=str), ckpt


def test_each_group_once_in_its_batch_also_after_a_replay(spark, scratch):
    rows = [(0, "g1", "A"), (1, "g2", "A"), (2, "g2", "B"), (3, "g1", "B"), (4, "g1", "A"), (5, "g3", "C")]
    got, _ = _run(spark, rows, scratch, ["A", "B"])
    assert [g for g, _ in got] == ["g1", "g2"]


@pytest.mark.parametrize("required, want", [([], ["a", "b", None]), (["x"], ["a"]), (["x", "x"], ["a"])])
def test_empty_single_and_repeated_names(spark, scratch, required, want):
    rows = [(0, "a", "x"), (1, "b", "y"), (2, "a", "y"), (3, None, None), (4, "a", "x")]
    got, _ = _run(spark, rows, scratch, required, 2)
    assert sorted((g for g, _ in got), key=str) == sorted(want, key=str)


def test_a_batch_writes_the_state_it_changes(spark, scratch):
    root = scratch("small")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    sizes = []
    for rows in ([(i, f"g{i}", "A") for i in range(20_000)], [(0, "g7", "B")]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        before = paths.size(spark, f"{ckpt}/state")
        completeness.start_complete(delivery.read_file_stream(spark, src, SCHEMA), ckpt, out, "g", "m",
                                    ["A", "B"]).awaitTermination()
        sizes.append(paths.size(spark, f"{ckpt}/state") - before)
    assert sizes[1] < sizes[0] / 20
    assert [r.g for r in spark.read.schema("g string, batch_id long").parquet(out).collect()] == ["g7"]


def test_file_batches_by_bytes(spark, scratch):
    root = scratch("bytes")
    src = f"{root}/in"
    spark.range(1000).repartition(8).write.parquet(src)
    one = paths.size(spark, src) // 8
    seen = []
    for limit in (3 * one, 100 * one):
        batches = []
        stream = delivery.read_file_stream(spark, src, "id long", max_bytes_per_trigger=limit)
        delivery.start_delivery(stream, f"{root}/ckpt{limit}", lambda df, i: batches.append(df.count())) \
            .awaitTermination()
        assert sum(batches) == 1000
        seen.append(len(batches))
    assert 2 <= seen[0] <= 5 and seen[1] == 1


def test_a_cap_leaves_nothing_pending_by_default(spark, scratch):
    start, seen = datetime(2024, 1, 1), []
    stream = window_stream(spark, start, timedelta(seconds=1), end=start + timedelta(seconds=10), max_windows=3)
    query = delivery.start_delivery(stream, scratch("mark"),
                                    lambda df, i: seen.append(sorted(r.window_id for r in df.collect())))
    query.awaitTermination()
    assert [x for x in seen if x] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]] and query.runs >= 4


def test_a_failing_batch_ends_the_draining(spark, scratch):
    def fail(df, i):
        raise OSError("sink is down")
    stream = window_stream(spark, datetime(2024, 1, 1), timedelta(days=1), end=datetime(2024, 1, 9), max_windows=2)
    query = delivery.start_delivery(stream, scratch("fails"), fail)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination(60)
    assert query.runs == 1
