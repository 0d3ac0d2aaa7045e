"""Incremental window ingest with a durable high-water mark.

A source is read in consecutive half-open time windows ``[lo, hi)``. A poll
delivers every pending window in one batch job whose write is keyed by
``window_id``; only after that write committed are the windows' rows
appended to the control table ``(source, window_id, lo, hi)``. The mark is
therefore durable and moves only past delivered windows:

* a crash before the write leaves nothing behind;
* a crash between the write and the mark makes the next poll repeat those
  windows, and the keyed write (dynamic partition overwrite of
  ``window_id=N``) replaces the earlier copies, so every row lands once.

The control table lives in the shared checkpoint folder (or any path the
caller gives). It is a plain parquet table with one small file per poll,
folded into one file once there are many.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import paths
from ..sinks import layout
from ..sources.windows import read_window, truncate_to_second

CONTROL_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("window_id", T.LongType(), False),
    T.StructField("lo", T.TimestampNTZType(), False),
    T.StructField("hi", T.TimestampNTZType(), False),
])

WINDOW_COL = "window_id"
MAX_PENDING = layout.MAX_GROUPS      # windows that are held and delivered at a time

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Window:
    window_id: int
    lo: datetime
    hi: datetime


class ControlTable:
    """The durable mark: one row per delivered window of each source."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self, source: str) -> DataFrame | None:
        if not paths.exists(self.spark, self.path):
            return None
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(self.path) \
            .filter(F.col("source") == source)

    def last(self, source: str) -> Window | None:
        rows = self._rows(source)
        if rows is None:
            return None
        top = rows.orderBy(F.col("window_id").desc()).limit(1).collect()
        return Window(top[0].window_id, top[0].lo, top[0].hi) if top else None

    def commit(self, source: str, window: Window) -> None:
        self.commit_all(source, [window])

    def commit_all(self, source: str, done: list[Window]) -> None:
        rows = [(source, w.window_id, w.lo, w.hi) for w in done]
        self.spark.createDataFrame(rows, CONTROL_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(self.path)
        self.compact()

    def compact(self, max_files: int = 64) -> None:
        """Fold the small per-commit files into one once there are many.

        The folded file is added before the old ones are removed, so a crash
        in between leaves duplicate rows (harmless: the mark is the greatest
        window id), never a missing mark.
        """
        names = [n for n in paths.list_names(self.spark, self.path) if n.endswith(".parquet")]
        if len(names) <= max_files:
            return
        tmp = f"{self.path}.compact-{uuid.uuid4().hex[:10]}"
        self.spark.read.schema(CONTROL_SCHEMA).parquet(*[f"{self.path}/{n}" for n in names]) \
            .dropDuplicates(["source", "window_id"]).coalesce(1).write.parquet(tmp)
        for n in paths.list_names(self.spark, tmp):
            if n.endswith(".parquet"):
                paths.rename(self.spark, f"{tmp}/{n}", f"{self.path}/compacted-{uuid.uuid4().hex[:10]}.parquet")
        for n in names:
            paths.delete(self.spark, f"{self.path}/{n}")
        paths.delete(self.spark, tmp)

    def history(self, source: str) -> DataFrame:
        rows = self._rows(source)
        return rows if rows is not None else self.spark.createDataFrame([], CONTROL_SCHEMA)


def next_windows(last: Window | None, start: datetime, now: datetime, step: timedelta,
                 lag: timedelta = timedelta(0), max_windows: int | None = None) -> list[Window]:
    """Windows still to deliver, from the mark (or ``start``) up to
    ``now - lag`` (whole seconds). ``lag`` keeps the reader behind rows that
    are committed late at the source; ``max_windows`` bounds one poll (a long
    catch-up then proceeds over several polls)."""
    lo = last.hi if last else truncate_to_second(start)
    wid = (last.window_id + 1) if last else 0
    end = truncate_to_second(now - lag)
    out = []
    while lo < end and (max_windows is None or len(out) < max_windows):
        hi = min(lo + step, end)
        out.append(Window(wid, lo, hi))
        lo, wid = hi, wid + 1
    return out


class StopAfterWrite(RuntimeError):
    """Raised by the test hook between a window's write and its mark."""


def write_window(df: DataFrame, path: str, window_id: int, fmt: str = "parquet") -> None:
    """Keyed delivery: replace exactly the partition ``window_id=N``; an empty
    result leaves no rows there."""
    if df.isEmpty():
        paths.delete(df.sparkSession, f"{path}/{WINDOW_COL}={window_id}")
        return
    (df.withColumn(WINDOW_COL, F.lit(window_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(WINDOW_COL).format(fmt).save(path))


def assign_windows(table: DataFrame, time_col: str, pending: list[Window],
                   step: timedelta) -> DataFrame:
    """Rows of all ``pending`` windows, each tagged with ``window_id`` and
    ``window_lo`` by arithmetic on the time column (no join, no loop).

    The arithmetic runs on wall-clock values (``timestamp_ntz``), like the
    window bounds themselves, so it does not depend on the session zone or
    its daylight-saving shifts.
    """
    first, last = pending[0], pending[-1]
    rows = read_window(table, time_col, first.lo, last.hi)
    step_us = int(step / timedelta(microseconds=1))
    wall = F.col(time_col).cast("timestamp_ntz")
    base = F.lit(first.lo.isoformat(sep=" ")).cast("timestamp_ntz")
    diff = F.timestamp_diff("MICROSECOND", base, wall)
    idx = F.floor(diff / F.lit(step_us)).cast("long")
    lo = F.timestamp_add("MICROSECOND", idx * F.lit(step_us), base)
    return rows.withColumn(WINDOW_COL, idx + F.lit(first.window_id)) \
        .withColumn("window_lo", lo.cast(table.schema[time_col].dataType))


TableOrFactory = DataFrame | Callable[[datetime, datetime], DataFrame]


def _source(table: TableOrFactory, lo: datetime, hi: datetime) -> DataFrame:
    return table(lo, hi) if callable(table) else table


def run_windows(spark: SparkSession, source: str, table: TableOrFactory, time_col: str,
                control: ControlTable, deliver: Callable[[DataFrame, list[Window]], None],
                start: datetime, now: datetime, step: timedelta,
                lag: timedelta = timedelta(0), stop_after_write: bool = False,
                max_windows: int | None = None) -> list[Window]:
    """Deliver the pending windows of ``table`` (at most ``max_windows``), up to
    ``MAX_PENDING`` in one batch job; the mark moves after each job. Returns the
    delivered windows, the last ``MAX_PENDING`` of them.

    ``table`` is a DataFrame, or a factory ``(lo, hi) -> DataFrame`` called
    with the bounds of this poll (e.g. a JDBC read partitioned on the time
    column between exactly those bounds).

    ``deliver(rows, windows)`` receives the rows of all pending windows
    tagged with ``window_id`` / ``window_lo`` and must write them keyed by
    ``window_id`` (see ``write_windows``). The marks of all those windows
    are appended afterwards, in one write. ``stop_after_write`` (tests)
    raises between the two to exercise the replay path.
    """
    done: deque[Window] = deque(maxlen=MAX_PENDING)
    while True:
        cap = MAX_PENDING if max_windows is None else min(MAX_PENDING, max_windows)
        pending = next_windows(control.last(source), start, now, step, lag, cap)
        if not pending:
            return list(done)
        src = _source(table, pending[0].lo, pending[-1].hi)
        deliver(assign_windows(src, time_col, pending, step), pending)
        if stop_after_write:
            raise StopAfterWrite(f"stopped after writing windows {pending[0].window_id}..")
        control.commit_all(source, pending)
        done.extend(pending)
        if len(pending) < cap:
            return list(done)
        if max_windows is not None:
            max_windows -= len(pending)
            if not max_windows:
                return list(done)


def run_windows_one_by_one(spark: SparkSession, source: str, table: TableOrFactory, time_col: str,
                           control: ControlTable, deliver: Callable[[DataFrame, Window], None],
                           start: datetime, now: datetime, step: timedelta,
                           lag: timedelta = timedelta(0),
                           stop_after_write: int | None = None) -> list[Window]:
    """The polling form: one read, one write and one mark per window, for
    sinks that take a window at a time."""
    done: deque[Window] = deque(maxlen=MAX_PENDING)
    while pending := next_windows(control.last(source), start, now, step, lag, MAX_PENDING):
        for w in pending:
            deliver(read_window(_source(table, w.lo, w.hi), time_col, w.lo, w.hi), w)
            if stop_after_write is not None and w.window_id == stop_after_write:
                raise StopAfterWrite(f"stopped after writing window {w.window_id}")
            control.commit(source, w)
            done.append(w)
    return list(done)


def write_windows(df: DataFrame, path: str, fmt: str = "parquet",
                  windows: list[Window] | None = None, time_col: str | None = None,
                  drop_time: bool = False, target_bytes: int = layout.TARGET_BYTES) -> None:
    """Keyed delivery of many windows: replace exactly their partitions.

    Tasks and files hold about ``target_bytes`` at most, however the rows are
    spread over the windows; with ``time_col`` a large window is cut by time
    (``drop_time``: that column is not stored). With ``windows`` (the windows of
    this delivery), those without rows in the new result are cleared.
    """
    full = layout.write_groups(df, path, WINDOW_COL, time_col, target_bytes, fmt, drop_time)
    if windows and len(full) < len(windows):
        spark = df.sparkSession
        stored = set(paths.list_names(spark, path))
        for w in windows:
            if w.window_id not in full and f"{WINDOW_COL}={w.window_id}" in stored:
                paths.delete(spark, f"{path}/{WINDOW_COL}={w.window_id}")


def poll_windows(spark: SparkSession, source: str, table: TableOrFactory, time_col: str,
                 control: ControlTable, deliver: Callable[[DataFrame, list[Window]], None],
                 start: datetime, step: timedelta, interval_ms: int,
                 lag: timedelta = timedelta(0), max_polls: int | None = None,
                 now: Callable[[], datetime] = datetime.now,
                 sleep: Callable[[float], None] | None = None,
                 on_error: Callable[[Exception], None] | None = None,
                 max_windows: int | None = None, max_failures: int = 10) -> int:
    """The polling loop (S4 around T1): deliver what is pending, then wait.

    A successful poll is followed by ``interval_ms`` of sleep. A failed one
    is logged and tried again at once, then after 1, 2, 4 ... seconds, at most
    a minute (the mark did not move, so the next poll covers the failed windows
    again). ``max_failures`` failures in a row, or an error in the query
    itself, end the loop with that error. Each poll is one batch job; nothing
    loops over rows on the driver. ``now`` gives wall-clock time in the
    session zone. Returns the number of polls run (``max_polls`` bounds it,
    for tests).
    """
    sleep = sleep or time.sleep
    polls = failures = 0
    while max_polls is None or polls < max_polls:
        polls += 1
        try:
            run_windows(spark, source, table, time_col, control, deliver, start, now(), step, lag,
                        max_windows=max_windows)
        except AnalysisException:       # would fail in the same way again
            raise
        except Exception as e:  # noqa: BLE001 - a failed poll is retried
            failures += 1
            log.warning("poll of %s failed (%d in a row): %s", source, failures, e)
            if on_error is not None:
                on_error(e)
            if failures >= max_failures:
                raise
            if failures > 1:
                sleep(min(60.0, 2.0 ** (failures - 2)))
            continue
        failures = 0
        sleep(interval_ms / 1000.0)
    return polls
