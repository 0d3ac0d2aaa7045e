"""The retry ledger, and windows that are delivered again when late rows change them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.functions.rows import strict_event
from tidewater.sinks.keyed import KeyedTable
from tidewater.streaming import reconcile as rec
from tidewater.streaming import windows as ingest
from tidewater.streaming.retry import RetryLedger, retry_batch

T0, HOUR = datetime(2024, 1, 1), timedelta(hours=1)


def _bodies(spark, bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


def _from(batch):
    """Bodies that name a batch decode from that batch on."""
    def decode(df, i):
        event = strict_event("body", "k long, ready int")
        return F.when(F.coalesce(event["ready"], F.lit(0)) <= i, event)
    return decode


def _setup(spark, scratch, n=3):
    out, ledger = scratch("out"), RetryLedger(spark, scratch("ledger"), n)
    run = retry_batch(out, ledger, _from(0), lambda d: d.select("event.k"))
    read = lambda: sorted(r.k for r in spark.read.schema("k long, batch_id long").parquet(out).collect()) \
        if paths.exists(spark, out) else []
    state = lambda: {r.body: (r.attempts, r.copies, r.state) for r in ledger.read().collect()}
    return run, read, state, ledger, out


def test_fails_twice_then_lands_once(spark, scratch):
    run, read, state, _, _ = _setup(spark, scratch)
    late = '{"k":7,"ready":2}'
    run(_bodies(spark, ['{"k":1}', late, "", None]), 0)
    assert read() == [1] and state() == {late: (1, 1, "waiting")}
    run(_bodies(spark, ['{"k":2}']), 1)
    assert read() == [1, 2] and state() == {late: (2, 1, "waiting")}
    run(_bodies(spark, ['{"k":3}']), 2)
    assert read() == [1, 2, 3, 7] and state() == {late: (2, 1, "landed")}
    run(_bodies(spark, ['{"k":4}']), 3)
    assert read() == [1, 2, 3, 4, 7]


def test_set_aside_after_n_and_offered_no_more(spark, scratch):
    run, read, state, _, _ = _setup(spark, scratch, 2)
    for i in range(4):
        run(_bodies(spark, ["nope"] * 3 if i == 0 else []), i)
    assert read() == [] and state() == {"nope": (2, 3, "aside")}
    run(_bodies(spark, ["nope"]), 4)                     # sent again: starts anew
    assert state() == {"nope": (1, 1, "waiting")}


def test_copies_land_as_often_as_sent(spark, scratch):
    run, read, _, _, _ = _setup(spark, scratch)
    late = '{"k":7,"ready":1}'
    run(_bodies(spark, [late, late, '{"k":1}', '{"k":1}']), 0)
    run(_bodies(spark, [late]), 1)
    assert read() == [1, 1, 7, 7, 7]


def test_replayed_batches_repeat_their_outcome(spark, scratch):
    run, read, state, _, _ = _setup(spark, scratch)
    batches = [['{"k":7,"ready":2}', "nope"], ['{"k":2}'], ['{"k":3}', "nope"]]
    for i, b in enumerate(batches):
        for _ in range(2):
            run(_bodies(spark, b), i)
    assert read() == [2, 3, 7]
    assert state() == {'{"k":7,"ready":2}': (2, 1, "landed"), "nope": (3, 2, "aside")}


def test_crash_between_output_and_ledger(spark, scratch, monkeypatch):
    run, read, state, _, _ = _setup(spark, scratch)
    run(_bodies(spark, ['{"k":7,"ready":1}']), 0)
    real = KeyedTable.apply
    monkeypatch.setattr(KeyedTable, "apply", lambda self, df: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run(_bodies(spark, ["nope"]), 1)
    monkeypatch.setattr(KeyedTable, "apply", real)
    run(_bodies(spark, ["nope"]), 1)
    assert read() == [7] and state() == {'{"k":7,"ready":1}': (1, 1, "landed"), "nope": (1, 1, "waiting")}


def _events(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(minutes=m), v) for i, m, v in rows], "id long, ts timestamp_ntz, v string")


def _ingest(spark, scratch, step=HOUR):
    root = scratch("rec")
    control, prints = ingest.ControlTable(spark, f"{root}/control"), rec.Fingerprints(spark, f"{root}/prints")
    seen = []

    def deliver(df, pending):
        seen.append([w.window_id for w in pending])
        ingest.write_windows(df.select("id", "v", "ts", ingest.WINDOW_COL), f"{root}/out", windows=pending, time_col="ts")
    poll = lambda df, hours: rec.run_windows_with_prints(
        spark, "s", df, "ts", control, prints, deliver, T0, T0 + hours * HOUR, step)
    check = lambda df, **k: rec.reconcile(spark, "s", df, "ts", control, prints, deliver, **k)
    read = lambda: sorted((r.id, r.v, r.window_id) for r in spark.read.parquet(f"{root}/out").collect())
    return poll, check, read, seen, f"{root}/out"


def test_late_changed_and_deleted_rows(spark, scratch):
    poll, check, read, seen, out = _ingest(spark, scratch)
    rows = [(1, 10, "a"), (2, 70, "b"), (3, 130, "c"), (4, 190, None)]
    poll(_events(spark, rows), 4)
    assert check(_events(spark, rows)) == 0 and len(seen) == 1
    files = paths.list_names(spark, f"{out}/window_id=2")
    later = [(1, 10, "a"), (5, 20, "late"), (2, 70, "B"), (3, 130, "c"), (6, 500, "after the mark")]
    assert check(_events(spark, later)) == 3 and seen[-1] == [0, 1, 3]
    assert read() == [(1, "a", 0), (2, "B", 1), (3, "c", 2), (5, "late", 0)]
    assert paths.list_names(spark, f"{out}/window_id=2") == files          # an unchanged window is not rewritten
    assert check(_events(spark, later)) == 0
    assert check(_events(spark, rows), since=T0 + 3 * HOUR) == 1 and seen[-1] == [3]


def test_equal_rows_swapped_between_windows_are_seen(spark, scratch):
    poll, check, read, seen, _ = _ingest(spark, scratch)
    poll(_events(spark, [(1, 10, "a"), (1, 10, "a"), (2, 70, "b")]), 2)
    assert check(_events(spark, [(1, 10, "a"), (2, 70, "b"), (2, 70, "b")])) == 2


def test_windows_of_uneven_lengths(spark, scratch):
    poll, check, read, seen, _ = _ingest(spark, scratch, step=timedelta(hours=5))
    rows = [(i, i * 7, "v") for i in range(60)]
    for hours in (0.5, 3, 7):                     # windows are cut short at each poll
        poll(_events(spark, rows), hours)
    assert check(_events(spark, rows)) == 0
    assert check(_events(spark, rows + [(99, 100, "late")])) == 1 and seen[-1] == [1]
    assert [r[0] for r in read()] == [*range(60), 99]


def test_windows_from_before_the_fingerprints(spark, scratch):
    poll, check, read, seen, out = _ingest(spark, scratch)
    df = _events(spark, [(1, 10, "a")])
    control = ingest.ControlTable(spark, out.replace("/out", "/control"))
    ingest.run_windows(spark, "s", df, "ts", control, lambda d, p: None, T0, T0 + 2 * HOUR, HOUR)
    assert check(df) == 2 and check(df) == 0 and read() == [(1, "a", 0)]
    assert rec.reconcile(spark, "other", df, "ts", control, rec.Fingerprints(spark, scratch("p")), None) == 0
