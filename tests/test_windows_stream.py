from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.sinks import files
from tidewater.sources import files as source_files
from tidewater.sources.windows import read_window, split_windows
from tidewater.streaming import completeness, delivery
from tidewater.streaming import windows as ingest


def _events(spark):
    base = datetime(2024, 1, 1)
    rows = [(i, base + timedelta(hours=6 * i)) for i in range(12)]   # 3 days, 4 per day
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz")


def test_window_edges(spark):
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, lo), (2, lo + timedelta(hours=5)), (3, hi)], "id long, ts timestamp_ntz")
    assert sorted(r.id for r in read_window(df, "ts", lo, hi).collect()) == [1, 2]
    assert [r.id for r in read_window(df, "ts", hi, hi + timedelta(days=1)).collect()] == [3]
    assert split_windows(lo, lo + timedelta(hours=5), timedelta(hours=2))[-1] == (lo + timedelta(hours=4), lo + timedelta(hours=5))


def test_replay_after_stop_between_write_and_mark(spark, scratch):
    ev = _events(spark)
    root = scratch("win")
    control = ingest.ControlTable(spark, f"{root}/control")
    out = f"{root}/out"
    start, day = datetime(2024, 1, 1), timedelta(days=1)

    def deliver(df, pending):
        ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)

    ingest.run_windows(spark, "ev", ev, "ts", control, deliver, start, datetime(2024, 1, 2), day)
    with pytest.raises(ingest.StopAfterWrite):
        ingest.run_windows(spark, "ev", ev, "ts", control, deliver, start, datetime(2024, 1, 4), day,
                           stop_after_write=True)
    assert control.last("ev").window_id == 0
    done = ingest.run_windows(spark, "ev", ev, "ts", control, deliver, start, datetime(2024, 1, 4), day)
    assert [w.window_id for w in done] == [1, 2]
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.collect()) == list(range(12))          # each row once
    per = {r.window_id: r.n for r in got.groupBy("window_id").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 4, 1: 4, 2: 4}
    assert ingest.run_windows(spark, "ev", ev, "ts", control, deliver, start, datetime(2024, 1, 4), day) == []


def test_one_by_one_form_and_lag(spark, scratch):
    ev = _events(spark)
    root = scratch("win1")
    control = ingest.ControlTable(spark, f"{root}/control")
    out = f"{root}/out"
    start, day = datetime(2024, 1, 1), timedelta(days=1)
    deliver = lambda df, w: ingest.write_window(df.select("id"), out, w.window_id)
    with pytest.raises(ingest.StopAfterWrite):
        ingest.run_windows_one_by_one(spark, "ev", ev, "ts", control, deliver, start,
                                      datetime(2024, 1, 4), day, stop_after_write=1)
    ingest.run_windows_one_by_one(spark, "ev", ev, "ts", control, deliver, start,
                                  datetime(2024, 1, 4, 12), day, lag=timedelta(hours=12))
    assert control.last("ev").hi == datetime(2024, 1, 4)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(12))


def _stage(spark, df, path, n):
    df.repartitionByRange(n, "id").write.parquet(path)


def test_file_stream_replay_and_idle(spark, scratch):
    root = scratch("fs")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    _stage(spark, df, src, 4)
    for _ in range(2):
        q = delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt,
                                    delivery.delivery_batch(out))
        q.awaitTermination()
        last = max((n for n in paths.list_names(spark, f"{ckpt}/commits") if n.isdigit()), key=int)
        paths.delete(spark, f"{ckpt}/commits/{last}")
    got = spark.read.parquet(out)
    assert got.count() == 100 and got.select("id").distinct().count() == 100
    batches = sorted(r.batch_id for r in got.select("batch_id").distinct().collect())
    assert batches == [0, 1, 2, 3]
    # idle trigger: nothing new, nothing written
    q = delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt,
                                delivery.delivery_batch(out))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 100


def test_stream_quarantine(spark, scratch):
    root = scratch("fq")
    src, out, bad, ckpt = f"{root}/in", f"{root}/out", f"{root}/bad", f"{root}/ckpt"
    bodies = spark.createDataFrame([(i, '{"a":%d}' % i if i % 3 else "oops") for i in range(30)],
                                   "id long, body string")
    _stage(spark, bodies, src, 3)
    fn = delivery.delivery_batch(out, quarantine_path=bad, body_col="body", schema="a long")
    delivery.start_delivery(delivery.read_file_stream(spark, src, bodies.schema), ckpt, fn).awaitTermination()
    assert sorted(r.a for r in spark.read.parquet(out).select("event.a").collect()) == [i for i in range(30) if i % 3]
    assert spark.read.parquet(bad).count() == 10


def test_stream_completeness_emits_once(spark, scratch):
    root = scratch("cs")
    src, out, state, ckpt = f"{root}/in", f"{root}/out", f"{root}/state", f"{root}/ckpt"
    rows = [(0, "g1", "A"), (1, "g2", "A"), (2, "g2", "B"), (3, "g1", "B"), (4, "g1", "A"), (5, "g3", "C")]
    df = spark.createDataFrame(rows, "id long, g string, m string")
    _stage(spark, df, src, 3)
    fn = completeness.completeness_batch(state, out, "g", "m", ["A", "B"], buckets=2)
    for _ in range(2):
        delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt, fn).awaitTermination()
        last = max((n for n in paths.list_names(spark, f"{ckpt}/commits") if n.isdigit()), key=int)
        paths.delete(spark, f"{ckpt}/commits/{last}")
    got = sorted((r.g, r.batch_id) for r in spark.read.parquet(out).collect())
    assert [g for g, _ in got] == ["g1", "g2"]


def test_control_table_compaction_keeps_mark(spark, scratch):
    control = ingest.ControlTable(spark, f"{scratch('ctl')}/control")
    lo = datetime(2024, 1, 1)
    for i in range(6):
        w = ingest.Window(i, lo + timedelta(hours=i), lo + timedelta(hours=i + 1))
        control.commit("s", w)
        control.compact(max_files=3)
    assert control.last("s").window_id == 5
    assert control.history("s").count() == 6
    files = [n for n in paths.list_names(spark, control.path) if n.endswith(".parquet")]
    assert len(files) <= 3


def test_stream_of_bodies_into_keyed_table(spark, scratch):
    root = scratch("bodies")
    src, table, bad, ckpt = f"{root}/in", f"{root}/table", f"{root}/bad", f"{root}/ckpt"
    rows = [(i, '{"user_id": %d, "seq": %d, "v": "v%d"}' % (i % 3, i, i)) for i in range(12)]
    rows += [(100, "not json"), (101, "")]
    df = spark.createDataFrame(rows, "id long, body string")
    _stage(spark, df, src, 3)
    fn = delivery.upsert_batch(table, ["user_id"], ["seq"], body_col="body",
                               schema="user_id long, seq long, v string", quarantine_path=bad)
    delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt, fn).awaitTermination()
    got = {r.user_id: r.v for r in spark.read.parquet(table).collect()}
    assert got == {0: "v9", 1: "v10", 2: "v11"}
    assert [r.body for r in spark.read.parquet(bad).collect()] == ["not json"]


def test_stream_completeness_with_empty_files(spark, scratch):
    root = scratch("cse")
    src, out, state, ckpt = f"{root}/in", f"{root}/out", f"{root}/state", f"{root}/ckpt"
    schema = "g string, m string"
    spark.createDataFrame([], schema).write.parquet(f"{src}")                      # an empty file
    spark.createDataFrame([("g1", "A"), ("g1", "B")], schema).write.mode("append").parquet(src)
    fn = completeness.completeness_batch(state, out, "g", "m", ["A", "B"], buckets=1)
    stream = delivery.read_file_stream(spark, src, schema)
    delivery.start_delivery(stream, ckpt, fn).awaitTermination()
    assert [r.g for r in spark.read.parquet(out).collect()] == ["g1"]


def test_failing_body_blocks_then_recovers_with_quarantine(spark, scratch):
    from pyspark.errors import StreamingQueryException
    root = scratch("t3")
    src, out, bad, ckpt = f"{root}/in", f"{root}/out", f"{root}/bad", f"{root}/ckpt"
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "broken"), (3, '{"a":3}')], "id long, body string")
    df.coalesce(1).write.parquet(src)
    failing = delivery.delivery_batch(out, body_col="body", schema="a long")
    q = delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt, failing)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    assert not paths.list_names(spark, f"{ckpt}/commits")         # the batch is not acknowledged
    fixed = delivery.delivery_batch(out, body_col="body", schema="a long", quarantine_path=bad)
    delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt, fixed).awaitTermination()
    assert sorted(r.a for r in spark.read.parquet(out).select("event.a").collect()) == [1, 3]
    assert [r.body for r in spark.read.parquet(bad).collect()] == ["broken"]


def test_poll_loop_retries_failed_poll_and_sleeps_after_success(spark, scratch):
    ev = _events(spark)
    root = scratch("poll")
    control = ingest.ControlTable(spark, f"{root}/control")
    out = f"{root}/out"
    clock = iter([datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 4)])
    slept, errors, calls = [], [], {"n": 0}

    def deliver(df, pending):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("sink down")          # second poll fails
        ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)

    n = ingest.poll_windows(spark, "ev", ev, "ts", control, deliver, datetime(2024, 1, 1),
                            timedelta(days=1), 500, max_polls=3, now=lambda: next(clock),
                            sleep=slept.append, on_error=errors.append)
    assert n == 3 and len(errors) == 1 and slept == [0.5, 0.5]
    assert control.last("ev").hi == datetime(2024, 1, 4)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(12))


def test_run_windows_with_a_bounded_source_factory(spark, scratch):
    ev = _events(spark)
    root = scratch("factory")
    control = ingest.ControlTable(spark, f"{root}/control")
    out, asked = f"{root}/out", []

    def factory(lo, hi):                      # e.g. a JDBC read partitioned on [lo, hi)
        asked.append((lo, hi))
        return read_window(ev, "ts", lo, hi)

    deliver = lambda df, pending: ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)
    ingest.run_windows(spark, "ev", factory, "ts", control, deliver, datetime(2024, 1, 1),
                       datetime(2024, 1, 3), timedelta(days=1))
    ingest.run_windows(spark, "ev", factory, "ts", control, deliver, datetime(2024, 1, 1),
                       datetime(2024, 1, 4), timedelta(days=1))
    assert asked == [(datetime(2024, 1, 1), datetime(2024, 1, 3)), (datetime(2024, 1, 3), datetime(2024, 1, 4))]
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(12))


def test_catch_up_bounded_per_poll(spark, scratch):
    ev = _events(spark)
    root = scratch("cap")
    control = ingest.ControlTable(spark, f"{root}/control")
    out = f"{root}/out"
    deliver = lambda df, pending: ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)
    polls = []
    while True:
        done = ingest.run_windows(spark, "ev", ev, "ts", control, deliver, datetime(2024, 1, 1),
                                  datetime(2024, 1, 4), timedelta(days=1), max_windows=2)
        if not done:
            break
        polls.append([w.window_id for w in done])
    assert polls == [[0, 1], [2]]
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(12))


def test_stream_completeness_empty_required_emits_every_group_once(spark, scratch):
    root = scratch("cs0")
    src, out, state, ckpt = f"{root}/in", f"{root}/out", f"{root}/state", f"{root}/ckpt"
    df = spark.createDataFrame([(0, "g1", "A"), (1, "g2", "B"), (2, "g1", "C")], "id long, g string, m string")
    _stage(spark, df, src, 2)
    fn = completeness.completeness_batch(state, out, "g", "m", [], buckets=1)
    delivery.start_delivery(delivery.read_file_stream(spark, src, df.schema), ckpt, fn).awaitTermination()
    assert sorted(r.g for r in spark.read.parquet(out).collect()) == ["g1", "g2"]


def test_window_source_stream_delivers_each_row_once_with_replay(spark, scratch):
    from tidewater.streaming import window_source as ws
    ev = _events(spark)                                   # 12 rows over 3 days
    root = scratch("wsrc")
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    day = timedelta(days=1)
    deliver = lambda df, pending: ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)
    fn = ws.windows_batch(ev, "ts", day, deliver)
    for end in (datetime(2024, 1, 2, 12), datetime(2024, 1, 4)):   # the second poll sees more time
        stream = ws.window_stream(spark, datetime(2024, 1, 1), day, end=end, max_windows=10)
        delivery.start_delivery(stream, ckpt, fn).awaitTermination()
    last = max((n for n in paths.list_names(spark, f"{ckpt}/commits") if n.isdigit()), key=int)
    paths.delete(spark, f"{ckpt}/commits/{last}")                  # lose the last acknowledgement
    stream = ws.window_stream(spark, datetime(2024, 1, 1), day, end=datetime(2024, 1, 4), max_windows=10)
    delivery.start_delivery(stream, ckpt, fn).awaitTermination()   # replays it
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.collect()) == list(range(12))
    assert sorted(r.window_id for r in got.select("window_id").distinct().collect()) == [0, 1, 2]


def test_window_source_reader_offsets():
    from tidewater.streaming.window_source import _WindowReader
    r = _WindowReader({"start": "2024-01-01T00:00:00", "step_seconds": "3600",
                       "end": "2024-01-01T05:30:00", "max_windows": "3"})
    rows, off = r.read(r.initialOffset())
    assert [w[0] for w in rows] == [0, 1, 2] and off == {"next": 3}
    rows, off = r.read(off)
    assert [w[0] for w in rows] == [3, 4] and off == {"next": 5}     # window 5 is not complete yet
    assert list(r.read(off)[0]) == []
    again = list(r.readBetweenOffsets({"next": 3}, {"next": 5}))       # replay: same bounds
    assert again == [(3, datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 4)),
                     (4, datetime(2024, 1, 1, 4), datetime(2024, 1, 1, 5))]


def test_window_source_requires_start_and_step():
    from tidewater.streaming.window_source import _WindowReader
    with pytest.raises(ValueError, match="start"):
        _WindowReader({"step_seconds": "60"})
    with pytest.raises(ValueError, match="step_seconds"):
        _WindowReader({"start": "2024-01-01T00:00:00"})


def test_window_source_with_a_processing_time_trigger(spark, scratch):
    """Live cadence: windows end as the clock moves; stop between batches."""
    import time as _time
    from datetime import timezone
    from tidewater.streaming import window_source as ws
    tz = spark.conf.get("spark.sql.session.timeZone")
    assert tz == "UTC"
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    start, step = now - timedelta(seconds=10), timedelta(seconds=2)
    src = spark.createDataFrame([(i, start + timedelta(milliseconds=500 * i)) for i in range(20)],
                                "id long, ts timestamp_ntz")
    root = scratch("live")
    out = f"{root}/out"
    deliver = lambda df, pending: ingest.write_windows(df.select("id", ingest.WINDOW_COL), out)
    q = delivery.start_delivery(ws.window_stream(spark, start, step), f"{root}/ckpt",
                                ws.windows_batch(src, "ts", step, deliver),
                                trigger=delivery.poll_trigger("500"))
    _time.sleep(4)
    q.processAllAvailable()          # stop between batches, not inside one
    q.stop()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(20))


def test_staged_files_follow_the_size_and_not_the_tasks(spark, scratch):
    src = f"{scratch('staged')}/in"
    df = spark.range(4000).repartition(40)
    assert source_files.stage_files(df, src) == 1000
    n = spark.read.parquet(src).groupBy(F.input_file_name()).count().collect()
    assert 4 <= len(n) <= 8 and max(r["count"] for r in n) <= 1000 and sum(r["count"] for r in n) == 4000


def test_merge_tasks_are_bounded_by_rows_and_not_by_compressed_files(spark, scratch, monkeypatch):
    root = scratch("merge_tasks")
    monkeypatch.setattr(files, "MERGE_PARTITION_BYTES", 20_000)
    fn = completeness.completeness_batch(f"{root}/state", f"{root}/out", "g", "m", ["A", "B"], buckets=1)
    stored = spark.range(3000).selectExpr("id AS g", "'A' AS m")
    fn(stored, 0)
    fn(stored.where("g < 10").selectExpr("g", "'B' AS m"), 1)
    state = spark.read.parquet(f"{root}/state")
    tasks = state.groupBy(F.input_file_name()).count().collect()
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 1000 and state.count() == 3000
    assert sorted(r.g for r in spark.read.parquet(f"{root}/out").collect()) == list(range(10))


def test_a_batch_of_one_file_is_decoded_by_all_cores(spark, scratch):
    root = scratch("spread")
    bodies = spark.range(400).selectExpr("""'{"a":' || id || '}' AS body""").coalesce(1)
    delivery.delivery_batch(f"{root}/out", body_col="body", schema="a long", quarantine_path=f"{root}/bad")(bodies, 0)
    files_out = spark.read.parquet(f"{root}/out").groupBy(F.input_file_name()).count().collect()
    assert len(files_out) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in files_out) == 400
