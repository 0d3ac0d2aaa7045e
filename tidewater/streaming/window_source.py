"""Time windows as a Structured Streaming source (S4, S5, T1 on the stream engine).

The source emits one small row per complete window,
``(window_id, lo, hi)`` with ``lo = start + id * step``; it never touches
the data. The stream's checkpoint is then the durable high-water mark (its
offsets are window ids), the trigger interval is the poll cadence, and
``foreachBatch`` reads the rows of those windows from the real source
(pushed-down bounds, JVM side) and writes them keyed by ``window_id``. A
batch replayed after a crash gets the same windows and rewrites the same
partitions, so every row lands once.

Only complete windows are emitted (``hi <= now - lag``), so a window is
never cut short and ids always map to the same bounds.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from .windows import TableOrFactory, Window, _source, assign_windows

SOURCE_NAME = "tidewater_windows"
MAX_PENDING = 4096          # as in windows; the source's classes are shipped without that module
WINDOW_SCHEMA = "window_id long, lo timestamp_ntz, hi timestamp_ntz"


class WindowSource(DataSource):
    """Options: ``start`` (ISO time), ``step_seconds``, optional
    ``lag_seconds`` (default 0), ``end`` (ISO time: stop there; otherwise
    the current wall clock in zone ``tz``) and ``max_windows`` per batch
    (default:
    ``MAX_PENDING``; ``delivery.start_delivery`` goes on until none is pending)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return WINDOW_SCHEMA

    def simpleStreamReader(self, schema):
        return _WindowReader(self.options)


class _WindowReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        for key in ("start", "step_seconds"):
            if not options.get(key):
                raise ValueError(f"window source option '{key}' is required")
        self.start = datetime.fromisoformat(options["start"])
        self.step = timedelta(seconds=float(options["step_seconds"]))
        if self.step <= timedelta(0):
            raise ValueError("step_seconds must be positive")
        self.lag = timedelta(seconds=float(options.get("lag_seconds", "0")))
        self.end = datetime.fromisoformat(options["end"]) if options.get("end") else None
        cap = options.get("max_windows")
        self.max_windows = int(cap) if cap else MAX_PENDING
        self.tz = options.get("tz")

    def _now(self) -> datetime:
        """Wall-clock now in the session zone (naive, like the bounds)."""
        if not self.tz:
            return datetime.now()
        from zoneinfo import ZoneInfo
        return datetime.now(ZoneInfo(self.tz)).replace(tzinfo=None)

    def _complete(self) -> int:
        """Number of windows that have ended (``hi <= now - lag``)."""
        limit = self.end if self.end is not None else self._now() - self.lag
        if limit <= self.start:
            return 0
        return int((limit - self.start) / self.step)

    def _rows(self, a: int, b: int):
        return [(i, self.start + i * self.step, self.start + (i + 1) * self.step) for i in range(a, b)]

    def initialOffset(self):
        return {"next": 0}

    def read(self, start):
        a = int(start["next"])
        b = self._complete()
        b = max(a, min(b, a + self.max_windows))
        return iter(self._rows(a, b)), {"next": b}

    def readBetweenOffsets(self, start, end):
        return iter(self._rows(int(start["next"]), int(end["next"])))


def window_stream(spark: SparkSession, start: datetime, step: timedelta,
                  lag: timedelta = timedelta(0), end: datetime | None = None,
                  max_windows: int | None = None) -> DataFrame:
    """A stream of complete windows ``(window_id, lo, hi)``."""
    # The source runs in Spark's Python workers, which need not have this
    # package installed: ship its classes by value, not as an import path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(WindowSource)
    reader = (spark.readStream.format(SOURCE_NAME)
              .option("start", start.isoformat())
              .option("step_seconds", str(step.total_seconds()))
              .option("lag_seconds", str(lag.total_seconds()))
              .option("tz", spark.conf.get("spark.sql.session.timeZone")))
    if max_windows is not None:
        reader = reader.option("max_windows", str(max_windows))
    if end is not None:
        reader = reader.option("end", end.isoformat())
    return reader.load()


def windows_batch(table: TableOrFactory, time_col: str, step: timedelta,
                  deliver: Callable[[DataFrame, list[Window]], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the batch holds window descriptors (at most
    ``max_windows`` small rows, collected); their rows are read from
    ``table`` in one job and handed to ``deliver`` tagged with ``window_id``
    and ``window_lo`` (write them with ``write_windows``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        pending = sorted((Window(r.window_id, r.lo, r.hi) for r in batch.collect()),
                         key=lambda w: w.window_id)
        if not pending:
            return
        src = _source(table, pending[0].lo, pending[-1].hi)
        deliver(assign_windows(src, time_col, pending, step), pending)

    return run
