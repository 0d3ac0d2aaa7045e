"""Driver loss in the middle of a swap: the next write (or ``recover``)
finishes it from the manifest, and no stored row is lost."""

import pytest

from tidewater import paths
from tidewater.operators import upsert
from tidewater.sinks import files


class Crash(RuntimeError):
    pass


def crash_after(monkeypatch, n_ok):
    real = paths.rename
    state = {"left": n_ok}

    def flaky(spark, src, dst):
        if state["left"] == 0:
            raise Crash("driver lost")
        state["left"] -= 1
        real(spark, src, dst)

    monkeypatch.setattr(paths, "rename", flaky)
    return lambda: monkeypatch.setattr(paths, "rename", real)


def _table(spark, rows):
    return spark.createDataFrame(rows, "k long, o long, v string")


@pytest.mark.parametrize("n_ok", [1, 2, 3, 5])
def test_bucket_swap_interrupted_then_recovered(spark, scratch, monkeypatch, n_ok):
    path = scratch("swap")
    upsert.upsert_table(spark, path, _table(spark, [(k, 1, f"v{k}") for k in range(40)]), ["k"], ["o"], buckets=4)
    restore = crash_after(monkeypatch, n_ok)       # manifest rename is the first rename
    with pytest.raises(Crash):
        upsert.upsert_table(spark, path, _table(spark, [(k, 2, f"w{k}") for k in range(20)]), ["k"], ["o"])
    restore()
    files.recover(spark, path)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {k: (f"w{k}" if k < 20 else f"v{k}") for k in range(40)}
    assert not paths.exists(spark, f"{path}/{files.SWAP_FILE}")


def test_bucket_swap_recovered_by_next_write(spark, scratch, monkeypatch):
    path = scratch("swap2")
    upsert.upsert_table(spark, path, _table(spark, [(k, 1, "a") for k in range(10)]), ["k"], ["o"], buckets=2)
    restore = crash_after(monkeypatch, 2)
    with pytest.raises(Crash):
        upsert.upsert_table(spark, path, _table(spark, [(k, 2, "b") for k in range(10)]), ["k"], ["o"])
    restore()
    upsert.upsert_table(spark, path, _table(spark, [(99, 1, "c")]), ["k"], ["o"])    # next write
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {**{k: "b" for k in range(10)}, 99: "c"}


@pytest.mark.parametrize("n_ok", [1, 2])
def test_staged_overwrite_interrupted_then_recovered(spark, scratch, monkeypatch, n_ok):
    path = scratch("own")
    spark.range(5).write.parquet(path)
    current = spark.read.parquet(path)
    grown = current.unionByName(spark.createDataFrame([(-1,)], current.schema))
    restore = crash_after(monkeypatch, n_ok)
    with pytest.raises(Crash):
        files.staged_overwrite(grown, path)
    restore()
    files.recover_overwrite(spark, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [-1, 0, 1, 2, 3, 4]
