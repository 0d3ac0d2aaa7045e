"""Late rows: delivered windows are checked again by fingerprint.

A window that was delivered is not read again, so a row that the source commits
late, dated before the mark, would be missed. Beside the mark a fingerprint is
kept for each delivered window: its number of rows and an order-free hash of
them. ``reconcile`` computes the fingerprints anew and delivers those windows
whose fingerprint changed, and no others; since delivery replaces a window's
partition, late, changed and deleted rows all come out right.

A fingerprint is taken before its window is delivered. Rows that arrive in
between make the next check deliver the window once more, never the reverse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import versions
from ..sinks.keyed import KeyedTable
from ..sinks.layout import row_hash
from ..sources.windows import read_window, window_predicate
from .windows import MAX_PENDING, WINDOW_COL, ControlTable, TableOrFactory, Window, _source, run_windows

SLOTS = 8192          # of the time span of a run of windows, to match rows with windows
FEW = 64              # ranges that are passed to the scan one by one
PRINTS = "source string, window_id long, n long, h decimal(38,0), check long"


def _wall(c: Column) -> Column:
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", base, c.cast("timestamp_ntz"))


def _micros(t: datetime) -> int:
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def tag_windows(table: DataFrame, time_col: str, wins: list[Window]) -> DataFrame:
    """The rows of ``table`` that lie in ``wins`` (at most ``MAX_PENDING``, of any
    lengths), each with its ``window_id`` and ``window_lo``. The span is cut into
    ``SLOTS`` slots; a window has a row for each slot it touches, so the side that
    is broadcast is bounded by windows and slots, and rows meet by slot."""
    if len(wins) > MAX_PENDING:
        raise ValueError(f"at most {MAX_PENDING} windows at a time")
    lo, hi = min(w.lo for w in wins), max(w.hi for w in wins)
    first, width = _micros(lo), max(1, -(-(_micros(hi) - _micros(lo)) // SLOTS))
    spans = [(w.window_id, _micros(w.lo), _micros(w.hi)) for w in wins]
    slots = [(s, i, a, b) for i, a, b in spans for s in range((a - first) // width, (b - 1 - first) // width + 1)]
    side = table.sparkSession.createDataFrame(slots, "_slot long, _id long, _lo long, _hi long")
    rows = read_window(table, time_col, lo, hi)
    if len(wins) <= FEW:
        wanted = F.lit(False)
        for w in wins:
            wanted = wanted | window_predicate(table, time_col, w.lo, w.hi)
        rows = rows.where(wanted)
    at = _wall(F.col(time_col))
    rows = rows.withColumn("_at", at).withColumn("_slot", F.floor((F.col("_at") - first) / width))
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (rows.join(F.broadcast(side), "_slot")
            .where((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
            .withColumn(WINDOW_COL, F.col("_id"))
            .withColumn("window_lo", F.timestamp_add("MICROSECOND", F.col("_lo"), base)
                        .cast(table.schema[time_col].dataType))
            .drop("_slot", "_id", "_lo", "_hi", "_at"))


class Fingerprints:
    """The fingerprints of delivered windows, a keyed table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = KeyedTable(spark, path, ["source", "window_id"], ["check"])

    def read(self, source: str) -> DataFrame:
        if not versions.versions(self.spark, self.table.path):
            return self.spark.createDataFrame([], PRINTS)
        return self.table.read().where(F.col("source") == source)

    def take(self, table: DataFrame, time_col: str, wins: list[Window]) -> dict[int, tuple]:
        """(rows, hash) of each window; windows without rows have (0, 0). The hash is a
        sum over the rows, so tasks add up their own and order does not matter."""
        got = tag_windows(table.withColumn("_h", row_hash(table)), time_col, wins).groupBy(WINDOW_COL).agg(
            F.count("*").alias("n"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("h")).collect()
        found = {r[WINDOW_COL]: (r.n, int(r.h)) for r in got}
        return {w.window_id: found.get(w.window_id, (0, 0)) for w in wins}

    def store(self, source: str, prints: dict[int, tuple], check: int) -> None:
        rows = [(source, i, n, h, check) for i, (n, h) in prints.items()]
        if rows:
            self.table.apply(self.spark.createDataFrame(
                rows, "source string, window_id long, n long, h string, check long")
                .withColumn("h", F.col("h").cast("decimal(38,0)")))


def run_windows_with_prints(spark: SparkSession, source: str, table: TableOrFactory, time_col: str,
                            control: ControlTable, prints: Fingerprints,
                            deliver: Callable[[DataFrame, list[Window]], None], start: datetime, now: datetime,
                            step: timedelta, lag: timedelta = timedelta(0),
                            max_windows: int | None = None) -> list[Window]:
    """``run_windows`` that also keeps the fingerprints of what it delivers."""
    def with_prints(rows: DataFrame, pending: list[Window]) -> None:
        taken = prints.take(_source(table, pending[0].lo, pending[-1].hi), time_col, pending)
        deliver(rows, pending)
        prints.store(source, taken, 0)

    return run_windows(spark, source, table, time_col, control, with_prints, start, now, step, lag,
                       max_windows=max_windows)


def _delivered(control: ControlTable, source: str, since: datetime | None) -> Iterator[list[Window]]:
    """The delivered windows in runs of at most ``MAX_PENDING``, by id."""
    rows = control.history(source).dropDuplicates(["window_id"])
    if since is not None:
        rows = rows.where(F.col("hi") > F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    last = -1
    while True:
        run = [Window(r.window_id, r.lo, r.hi) for r in
               rows.where(F.col("window_id") > last).orderBy("window_id").limit(MAX_PENDING).collect()]
        if not run:
            return
        yield run
        last = run[-1].window_id


def reconcile(spark: SparkSession, source: str, table: TableOrFactory, time_col: str, control: ControlTable,
              prints: Fingerprints, deliver: Callable[[DataFrame, list[Window]], None],
              since: datetime | None = None) -> int:
    """Deliver the windows before the mark whose rows have changed since they were
    delivered (``since``: only windows that end after it are checked); returns their
    number. A window without a fingerprint, from before they were kept, counts as
    changed. A crash between delivery and fingerprint delivers again: same rows."""
    n = 0
    for run in _delivered(control, source, since):
        src = _source(table, min(w.lo for w in run), max(w.hi for w in run))
        stored = {r.window_id: r for r in prints.read(source).where(
            F.col("window_id").between(run[0].window_id, run[-1].window_id)).collect()}
        now = prints.take(src, time_col, run)
        changed = [w for w in run if w.window_id not in stored
                   or (stored[w.window_id].n, int(stored[w.window_id].h)) != now[w.window_id]]
        if not changed:
            continue
        deliver(tag_windows(src, time_col, changed), changed)
        check = 1 + max([0, *(r.check for r in stored.values())])
        prints.store(source, {w.window_id: now[w.window_id] for w in changed}, check)
        n += len(changed)
    return n
