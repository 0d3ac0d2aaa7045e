"""Keyed tables with deltas, versions and splitting buckets."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.operators.upsert import latest_per_key
from tidewater.sinks import keyed, versions
from tidewater.sinks.keyed import KeyedTable


def _df(spark, rows, schema="k long, o long, v string"):
    return spark.createDataFrame(rows, schema)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _latest(rows):
    best = {}
    for k, o, v in rows:
        best[k] = max(best.get(k, (o, v)), (o, v))
    return sorted((k, *x) for k, x in best.items())


def _manifest(t):
    return versions.manifest(t.spark, t.path)


def test_batches_replays_and_late_rows(spark, scratch):
    t = KeyedTable(spark, scratch("keyed"), ["k"], ["o"], bucket_bytes=4000)
    rnd, sent = random.Random(1), []
    for i in range(6):
        batch = [(rnd.randrange(400), rnd.randrange(50), f"v{i}-{j}") for j in range(150)]
        sent.append(batch)
        t.apply(_df(spark, batch))
        if i % 2:
            t.apply(_df(spark, sent[i // 2]))         # an old batch again
        assert _rows(t.read()) == _latest(x for b in sent for x in b)
    assert _rows(t.read(0)) == _latest(sent[0])       # a version stays what it was


def test_bytes_written_follow_the_batch_not_the_table(spark, scratch):
    size = 20_000
    t = KeyedTable(spark, scratch("bytes"), ["k"], ["o"], bucket_bytes=size)
    t.apply(spark.range(20_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("o"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("v")))
    table = sum(b["bytes"] for b in _manifest(t)["buckets"])
    assert table > 1_000_000 and max(b["bytes"] for b in _manifest(t)["buckets"]) < 1.5 * size
    folders, spent, given = set(paths.list_names(spark, f"{t.path}/data")), 0, 0
    for i in range(3):
        t.apply(spark.range(100).select((F.col("id") * 7 + i).alias("k"), F.lit(i + 1).cast("long").alias("o"),
                                        F.sha2(F.lit(f"{i}"), 256).alias("v")))
        new = set(paths.list_names(spark, f"{t.path}/data")) - folders
        folders |= new
        given += _manifest(t)["deltas"][-1]["bytes"]
        spent += sum(paths.size(spark, f"{t.path}/data/{n}") for n in new)
        assert spent <= given * (2 + 1 / t.share) + 3 * size < table / 5
    assert t.read().count() == 20_000 and t.read().where("o > 0").count() == 300


def test_a_grown_table_keeps_its_bucket_size(spark, scratch):
    t = KeyedTable(spark, scratch("grow"), ["k"], ["o"], bucket_bytes=16_000)
    make = lambda lo, hi: spark.range(lo, hi).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    t.apply(make(0, 100))
    assert [b["bits"] for b in _manifest(t)["buckets"]] == [""]
    for lo in range(100, 10_000, 3300):
        t.apply(make(lo, min(lo + 3300, 10_000)))
    t.apply(make(0, 100))                              # the oldest batch again, after the splits
    m = _manifest(t)
    folded = [b["bytes"] for b in m["buckets"] if b["folder"]]
    assert len(m["buckets"]) > 8 and max(folded) < 2 * 16_000
    lows = [keyed._low(b["bits"]) for b in m["buckets"]]
    assert lows == sorted(lows) and sum(keyed._width(b["bits"]) for b in m["buckets"]) == 1.0
    assert t.read().exceptAll(make(0, 10_000)).isEmpty() and t.read().count() == 10_000


def test_many_small_deltas_are_merged(spark, scratch, monkeypatch):
    monkeypatch.setattr(keyed, "RUN", 3)
    t = KeyedTable(spark, scratch("runs"), ["k"], ["o"], share=1e9)      # folds as good as nothing
    t.apply(_df(spark, [(i, 0, "base") for i in range(50)]))
    for i in range(1, 10):
        t.apply(_df(spark, [(i, i, f"v{i}")]))
    assert len(_manifest(t)["deltas"]) <= 4
    assert _rows(t.read()) == sorted([(i, i, f"v{i}") if 1 <= i < 10 else (i, 0, "base") for i in range(50)])


@pytest.mark.parametrize("step", ["write_text", "rename"])
def test_crash_before_the_switch_changes_nothing(spark, scratch, monkeypatch, step):
    t = KeyedTable(spark, scratch("crash"), ["k"], ["o"])
    t.apply(_df(spark, [(1, 1, "a"), (2, 1, "b")]))
    before, real = t.read(), getattr(paths, step)

    def fail(*a):
        raise OSError("driver lost")
    monkeypatch.setattr(paths, step, fail)
    with pytest.raises(OSError):
        t.apply(_df(spark, [(1, 2, "c")]))
    monkeypatch.setattr(paths, step, real)
    assert _rows(t.read()) == [(1, 1, "a"), (2, 1, "b")]
    t.apply(_df(spark, [(1, 2, "c")]))
    assert _rows(t.read()) == [(1, 2, "c"), (2, 1, "b")] and _rows(before) == [(1, 1, "a"), (2, 1, "b")]
    kept = versions.vacuum(spark, t.path)              # the lost write's folder goes too
    assert kept >= 1 and _rows(t.read()) == [(1, 2, "c"), (2, 1, "b")]


def test_map_payload(spark, scratch):
    t = KeyedTable(spark, scratch("map"), ["k"], ["o"])
    schema = "k long, o long, m map<string,string>"
    t.apply(_df(spark, [(1, 1, {"a": "x"}), (1, 2, {"a": "y"}), (2, 1, None)], schema))
    t.apply(_df(spark, [(1, 1, {"a": "z"}), (2, 0, {"b": "w"})], schema))
    assert sorted((r.k, r.m) for r in t.read().collect()) == [(1, {"a": "y"}), (2, None)]
    tie = _df(spark, [(1, 1, {"a": "x"}), (1, 1, {"a": "y"})], schema)
    assert latest_per_key(tie, ["k"], ["o"]).first().m == {"a": "y"}


def test_update_changes_stored_keys_only(spark, scratch):
    t = KeyedTable(spark, scratch("update"), ["k"], ["o"], bucket_bytes=1000)
    assert t.update(_df(spark, [(1, 1, "a")])) is None
    t.apply(_df(spark, [(i, 1, f"v{i}") for i in range(300)] + [(None, 1, "null key")]))
    t.update(_df(spark, [(5, 2), (999, 2), (None, 2)], "k long, o long"))
    got = {r.k: (r.o, r.v) for r in t.read().collect()}
    assert got[5] == (2, "v5") and got[None] == (2, "null key") and got[6] == (1, "v6") and len(got) == 301


def test_refused_batches(spark, scratch):
    t = KeyedTable(spark, scratch("refuse"), ["k"], ["o"])
    t.apply(_df(spark, [(1, 1, "a")]))
    with pytest.raises(ValueError):
        t.apply(_df(spark, [(1, 1)], "k long, o long"))
    with pytest.raises(TypeError):
        t.apply(_df(spark, [(1, 1, "a")], "k int, o long, v string"))
    with pytest.raises(ValueError):
        t.apply(_df(spark, [(1, 1, "a", 3)], "k long, o long, v string, _h long"))
    with pytest.raises(ValueError):
        KeyedTable(spark, t.path, ["v"], ["o"]).apply(_df(spark, [(1, 1, "a")]))
    version = _manifest(t)["version"]
    t.apply(_df(spark, []))                            # nothing to add
    assert _manifest(t)["deltas"] == [] or _rows(t.read()) == [(1, 1, "a")]
    assert _manifest(t)["version"] == version + 1


def test_columns_called_like_old_reserved_names(spark, scratch):
    t = KeyedTable(spark, scratch("names"), ["k"], ["o"])
    t.apply(_df(spark, [(1, 1, 7)], "k long, o long, bucket int"))
    assert t.read().first().bucket == 7


def test_overwrite_keeps_open_readers(spark, scratch):
    path = scratch("versions")
    first = spark.range(10).withColumn("v", F.lit("old"))
    assert versions.overwrite(first, path) == 0
    reader = versions.read(spark, path)
    assert versions.overwrite(reader.where("id < 3").withColumn("v", F.lit("new")), path) == 1   # its own input
    assert reader.count() == 10 and versions.read(spark, path).count() == 3
    assert versions.read(spark, path, 0).where("v = 'old'").count() == 10
    versions.overwrite(versions.read(spark, path).limit(0), path)
    assert versions.read(spark, path).count() == 0 and versions.read(spark, path).columns == ["id", "v"]
    assert versions.vacuum(spark, path, keep=2) == 1 and versions.versions(spark, path) == [1, 2]
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 0)


def test_second_writer_is_refused(spark, scratch):
    path = scratch("two")
    versions.overwrite(spark.range(1), path)
    with pytest.raises(RuntimeError):
        versions.publish(spark, path, {"folders": []}, -1)


def test_scan_without_deltas_shuffles_nothing(spark, scratch):
    t = KeyedTable(spark, scratch("scan"), ["k"], ["o"])
    t.apply(_df(spark, [(i, 1, "a") for i in range(100)]))
    assert _manifest(t)["deltas"] == []
    plan = spark._jvm.PythonSQLUtils.explainString(t.read()._jdf.queryExecution(), "formatted")
    assert "Exchange" not in plan


def test_fold_reads_its_hash_range_and_exchanges_once(spark, scratch):
    t = KeyedTable(spark, scratch("plan"), ["k"], ["o"])
    t.apply(_df(spark, [(i, 1, "a") for i in range(100)]))
    prefixes = ["0", "10", "11"]
    rows = t._load(_manifest(t), [b["folder"] for b in _manifest(t)["buckets"]])
    rows = rows.where(F.col(keyed.HASH).between(0, 5)).withColumn(keyed.BUCKET, keyed.bucket_index(prefixes))
    out = latest_per_key(rows.repartitionById(3, F.col(keyed.BUCKET)), [keyed.BUCKET, "k", keyed.HASH], ["o"])
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert plan.count("Exchange") == 1 and "GreaterThanOrEqual(_h,0)" in plan


def test_bucket_index(spark):
    prefixes = ["0", "100", "101", "11"]
    lows = [keyed._low(p) for p in prefixes]
    hs = [-2 ** 63, -1, 0, 2 ** 61 - 1, 2 ** 61, 2 ** 62 - 1, 2 ** 62, 2 ** 63 - 1]
    got = [r.i for r in spark.createDataFrame([(h,) for h in hs], "_h long").select(
        keyed.bucket_index(prefixes).alias("i")).collect()]
    assert got == [max(i for i, low in enumerate(lows) if h >= low) for h in hs]
    assert keyed.split("1", 100, 100) == ["1"] and keyed.split("1", 301, 100) == ["100", "101", "110", "111"]
