from datetime import datetime


from tidewater.functions.rows import parse_event
from tidewater.operators import cells, upsert

ORDER = ["ts", "seq"]


def _events(spark, rows):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, seq long, body string")
    return df.select("ts", "seq", parse_event("body").alias("m"))


def _read(spark, path):
    return {(r.rowkey, r.qualifier): r.value for r in spark.read.parquet(path).collect()}


def test_sparse_cells_keep_absent_fields(spark, scratch):
    path = scratch("cells")
    t = datetime(2024, 1, 1)
    first = _events(spark, [(t, 1, '{"k":1,"x":"a"}')])
    second = _events(spark, [(t, 2, '{"k":1,"y":"b"}')])
    for batch in (first, second):
        cells.put_cells(spark, path, cells.event_cells(batch, "m", "k", "cf", ORDER), ORDER, buckets=4)
    assert _read(spark, path) == {("1", "k"): "1", ("1", "x"): "a", ("1", "y"): "b"}


def test_overlapping_writes_order_wins_any_arrival(spark, scratch):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    old = _events(spark, [(t1, 1, '{"k":12,"v":"old"}')])
    new = _events(spark, [(t2, 2, '{"k":12,"v":"new"}')])
    for arrival in ((old, new), (new, old)):
        path = scratch("cells")
        for batch in arrival:
            cells.put_cells(spark, path, cells.event_cells(batch, "m", "k", "cf", ORDER), ORDER, buckets=4)
        assert _read(spark, path)[("21", "v")] == "new"


def test_null_value_is_text_null(spark):
    ev = _events(spark, [(datetime(2024, 1, 1), 1, '{"k":1,"z":null}')])
    got = {r.qualifier: r.value for r in cells.event_cells(ev, "m", "k", "cf", ORDER).collect()}
    assert got == {"k": "1", "z": "null"}
    skip = cells.event_cells(ev, "m", "k", "cf", ORDER, null_values="skip").collect()
    assert {r.qualifier for r in skip} == {"k"}


def test_dense_column_cells(spark):
    df = spark.createDataFrame([(5, "a", None)], "k long, x string, y string")
    got = {(r.rowkey, r.qualifier, r.value) for r in cells.column_cells(df, "k", ["k", "x", "y"], "cf").collect()}
    assert got == {("5", "k", "5"), ("5", "x", "a"), ("5", "y", "null")}


def test_upsert_table_many_buckets_and_replay(spark, scratch):
    path = scratch("upsert")
    base = spark.createDataFrame([(k, 1, f"v{k}") for k in range(50)], "k long, o long, v string")
    upd = spark.createDataFrame([(k, 2, f"w{k}") for k in range(40, 60)], "k long, o long, v string")
    stale = spark.createDataFrame([(k, 0, "stale") for k in range(60)], "k long, o long, v string")
    for batch in (base, upd, upd, stale):       # replayed and older batches change nothing
        upsert.upsert_table(spark, path, batch, ["k"], ["o"], buckets=8)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {k: (f"w{k}" if k >= 40 else f"v{k}") for k in range(60)}
    assert spark.read.parquet(path).select("bucket").distinct().count() == 8


def test_latest_per_key_hot_key(spark):
    rows = [(1, i, f"v{i}") for i in range(3000)] + [(2, 5, "x")]
    df = spark.createDataFrame(rows, "k long, o long, v string").repartition(8)
    got = {r.k: r.v for r in upsert.latest_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: "v2999", 2: "x"}


def test_update_mode_changes_existing_keys_only(spark, scratch):
    path = scratch("update")
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k long, o long, v string")
    upd = spark.createDataFrame([(2, 2, "B"), (3, 2, "C")], "k long, o long, v string")
    upsert.upsert_table(spark, path, upd, ["k"], ["o"], mode="update")   # no table yet: no-op
    from tidewater import paths
    assert not paths.exists(spark, path)
    upsert.upsert_table(spark, path, base, ["k"], ["o"], buckets=2)
    upsert.upsert_table(spark, path, upd, ["k"], ["o"], mode="update")
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {1: "a", 2: "B"}


def test_empty_event_gives_no_cells_missing_key_fails(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    empty = _events(spark, [(datetime(2024, 1, 1), 1, "{}")])
    assert cells.event_cells(empty, "m", "k", "cf", ORDER).count() == 0
    keyless = _events(spark, [(datetime(2024, 1, 1), 1, '{"x":"a"}')])
    with pytest.raises((PySparkException, Py4JJavaError)):
        cells.event_cells(keyless, "m", "k", "cf", ORDER).collect()


def test_rebucket_keeps_rows_and_later_merges(spark, scratch):
    from tidewater.sinks import files
    path = scratch("rebucket")
    base = spark.createDataFrame([(k, 1, f"v{k}") for k in range(30)], "k long, o long, v string")
    upsert.upsert_table(spark, path, base, ["k"], ["o"], buckets=2)
    files.rebucket(spark, path, ["k"], 8)
    assert spark.read.parquet(path).select("bucket").distinct().count() == 8
    upd = spark.createDataFrame([(k, 2, f"w{k}") for k in range(0, 30, 3)], "k long, o long, v string")
    upsert.upsert_table(spark, path, upd, ["k"], ["o"])
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {k: (f"w{k}" if k % 3 == 0 else f"v{k}") for k in range(30)}
    assert spark.read.parquet(path).count() == 30


def test_only_touched_buckets_are_rewritten(spark, scratch):
    from tidewater import paths
    from tidewater.sinks import files
    path = scratch("touched")
    base = spark.createDataFrame([(k, 1, f"v{k}") for k in range(200)], "k long, o long, v string")
    upsert.upsert_table(spark, path, base, ["k"], ["o"], buckets=8)
    before = {b: paths.list_names(spark, f"{path}/{b}") for b in paths.list_names(spark, path)
              if b.startswith(files.BUCKET_COL + "=")}
    one = spark.createDataFrame([(7, 2, "new")], "k long, o long, v string")
    upsert.upsert_table(spark, path, one, ["k"], ["o"])
    after = {b: paths.list_names(spark, f"{path}/{b}") for b in before}
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1                           # one bucket rewritten, seven untouched
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got[7] == "new" and len(got) == 200


def test_put_cells_must_exist(spark, scratch):
    import pytest
    ev = _events(spark, [(datetime(2024, 1, 1), 1, '{"k":1,"x":"a"}')])
    with pytest.raises(FileNotFoundError):
        cells.put_cells(spark, scratch("missing"), cells.event_cells(ev, "m", "k", "cf", ORDER), ORDER,
                        must_exist=True)


def test_outgrown_buckets_warn(spark, scratch, monkeypatch):
    import pytest
    from tidewater.plans import sizing
    path = scratch("outgrown")
    base = spark.createDataFrame([(k, 1, "v") for k in range(50)], "k long, o long, v string")
    upsert.upsert_table(spark, path, base, ["k"], ["o"], buckets=2)
    monkeypatch.setattr(sizing, "TARGET_BUCKET_BYTES", 1)
    with pytest.warns(UserWarning, match="rebucket"):
        upsert.upsert_table(spark, path, base.limit(1), ["k"], ["o"])
