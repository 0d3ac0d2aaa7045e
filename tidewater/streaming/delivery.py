"""Stream delivery with Structured Streaming.

* S6 / S4: files arriving in a folder are the queue of ready batches; the
  trigger sets the cadence (``processingTime``) or drains what is there
  (``availableNow``), ``maxFilesPerTrigger`` bounds one micro-batch.
* T2: every micro-batch goes through ``foreachBatch``. The write is keyed
  by ``batch_id`` (dynamic overwrite of partition ``batch_id=N``), and the
  stream checkpoint records offsets before and commits after the batch, so
  a batch replayed after a crash rewrites its own partition: each row lands
  once.
* T3: events whose body does not decode fail the batch (default) or go to
  a quarantine table keyed the same way (``on_bad='quarantine'``).
* T4: an idle trigger runs no batch and writes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import paths
from ..fixed import DEFAULT_INTERVAL_MS
from ..functions.rows import is_nonempty, strict_event
from ..sinks.keyed import KeyedTable

BATCH_COL = "batch_id"
ON_BAD_FAIL = "fail"
ON_BAD_QUARANTINE = "quarantine"




def poll_trigger(interval: str | int | None) -> dict:
    """The trigger for a poll interval setting in milliseconds.

    An empty or non-numeric setting falls back to ``DEFAULT_INTERVAL_MS``.
    """
    try:
        ms = int(str(interval).strip())
    except (TypeError, ValueError):
        ms = DEFAULT_INTERVAL_MS
    if ms <= 0:
        ms = DEFAULT_INTERVAL_MS
    return {"processingTime": f"{ms} milliseconds"}


def read_file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                     max_files_per_trigger: int | None = 1,
                     max_bytes_per_trigger: int | str | None = None) -> DataFrame:
    """A folder of files as an ordered stream of batches. A batch is bounded by
    its number of files or, with ``max_bytes_per_trigger`` (a number, or a text like
    ``512m``), by their bytes: many small files then share a batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Keyed write: replace exactly partition ``batch_id=N`` of ``path``; an
    empty result leaves no rows there. A column of that name is refused."""
    if BATCH_COL in df.columns:
        raise ValueError(f"the column name {BATCH_COL} is taken by the table itself")
    if df.isEmpty():
        paths.delete(df.sparkSession, f"{path}/{BATCH_COL}={batch_id}")
        return
    (df.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH_COL).format(fmt).save(path))


@dataclass
class Decoded:
    good: DataFrame
    bad: DataFrame | None
    rows: DataFrame      # both, to persist before good and bad are written


def decode_bodies(df: DataFrame, body_col: str = "body", schema=None,
                  on_bad: str = ON_BAD_FAIL, event_col: str = "event",
                  required: Sequence[str] = ()) -> Decoded:
    """P6 + P7 + T3 on a batch: skip empty bodies, decode the rest.

    Good rows carry the decoded ``event_col`` next to the input columns. A
    non-empty body is bad if it is not a JSON object, if a field does not
    have its type in ``schema``, or if a ``required`` field (a key) is null.
    With ``on_bad='fail'`` a bad body fails the task, also if the event is not
    used further on; with ``'quarantine'`` such rows are returned in ``bad``.
    """
    event = strict_event(body_col, schema, required)
    present = df.filter(is_nonempty(body_col))
    if on_bad == ON_BAD_FAIL:
        failed = F.raise_error(F.concat(F.lit("undecodable event body: "),
                                        F.substring(F.col(body_col), 1, 200)))
        # The test is a filter, so no projection prunes it. Generating the event anew
        # (one item) keeps the decoding in the projection below, where it runs once.
        good = present.withColumn(event_col, event).select(
            *[c for c in present.columns if c != event_col],
            F.explode_outer(F.array(event_col)).alias(event_col)) \
            .filter(F.when(F.col(event_col).isNull(), failed.cast("boolean")).otherwise(F.lit(True)))
        return Decoded(good, None, good)
    if on_bad != ON_BAD_QUARANTINE:
        raise ValueError("on_bad must be 'fail' or 'quarantine'")
    both = present.withColumn(event_col, event)
    return Decoded(both.filter(F.col(event_col).isNotNull()),
                   both.filter(F.col(event_col).isNull()).drop(event_col), both)


def spread(batch: DataFrame) -> DataFrame:
    """``batch`` over all cores: a file of small compressed bodies is read by one
    task or a few, and decoding costs far more than moving the bodies."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch if batch.rdd.getNumPartitions() >= cores else batch.repartition(cores)


@contextmanager
def _decoded(batch: DataFrame, batch_id: int, body_col: str, schema,
             quarantine_path: str | None, required: Sequence[str] = ()) -> Iterator[DataFrame]:
    """The good rows of a micro-batch; its bad rows go to ``quarantine_path``.
    The batch is decoded once for both outputs, by all cores."""
    batch = spread(batch)
    if quarantine_path is None:
        yield decode_bodies(batch, body_col, schema, ON_BAD_FAIL, required=required).good
        return
    dec = decode_bodies(batch, body_col, schema, ON_BAD_QUARANTINE, required=required)
    dec.rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_batch(dec.bad, quarantine_path, batch_id)
        yield dec.good
    finally:
        dec.rows.unpersist()


def delivery_batch(out_path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                   quarantine_path: str | None = None, body_col: str | None = None,
                   schema=None, required: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: decode (optional), transform, keyed write."""

    def deliver(df: DataFrame, batch_id: int) -> None:
        write_batch(transform(df) if transform is not None else df, out_path, batch_id)

    def run(batch: DataFrame, batch_id: int) -> None:
        if body_col is None:
            deliver(batch, batch_id)
            return
        with _decoded(batch, batch_id, body_col, schema, quarantine_path, required) as good:
            deliver(good, batch_id)

    return run


class DrainingQuery:
    """A query that stops by itself, run again until a run finds no input. Everything
    but ``awaitTermination`` is that of the run in hand. A source that caps its
    batches (the window source with ``max_windows``) offers one batch a run."""

    def __init__(self, start: Callable[[], StreamingQuery]):
        self._start, self._query, self.runs = start, start(), 1

    def __getattr__(self, name):
        return getattr(self._query, name)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802 - as in StreamingQuery
        end = None if timeout is None else time.monotonic() + timeout
        while True:
            if end is None:
                self._query.awaitTermination()
            elif not self._query.awaitTermination(max(0.001, end - time.monotonic())):
                return False
            if not self._more():
                return None if timeout is None else True
            self._query, self.runs = self._start(), self.runs + 1

    def _more(self) -> bool:
        """Whether the run had input from a source that may hold back more: the file
        source gives all files that were there in one run of several batches."""
        return any(s["numInputRows"] and not s["description"].startswith("FileStreamSource")
                   for p in self._query.recentProgress for s in p["sources"])


def start_delivery(stream: DataFrame, checkpoint: str,
                   batch_fn: Callable[[DataFrame, int], None],
                   trigger: dict | None = None, name: str | None = None) -> StreamingQuery | DrainingQuery:
    """Run ``batch_fn`` per micro-batch with a durable checkpoint.

    ``trigger`` is passed to ``DataStreamWriter.trigger``. By default the query
    delivers what there is and stops: ``awaitTermination`` returns when nothing is
    pending, over as many runs as the source's caps need.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_fn)
    if name:
        writer = writer.queryName(name)
    if trigger:
        return writer.trigger(**trigger).start()
    return DrainingQuery(lambda: writer.trigger(availableNow=True).start())


def drain(start: Callable[[], StreamingQuery | DrainingQuery]) -> int:
    """Run a query that stops by itself again and again until a run finds no
    input; returns the number of runs."""
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        runs += 1
        if not any(p["numInputRows"] for p in query.recentProgress):
            return runs


def upsert_batch(path: str, keys: list[str], order: list[str], buckets: int | None = None,
                 body_col: str | None = None, schema=None,
                 quarantine_path: str | None = None,
                 columns: Sequence[Column | str] | None = None,
                 required: Sequence[str] | None = None,
                 table: KeyedTable | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for K4 in a stream: merge each micro-batch
    into the keyed file table at ``path``. Replays are harmless: the merge
    keeps the greatest order tuple per key.

    With ``body_col`` the batch holds JSON bodies: empty ones are skipped,
    the rest decoded with ``schema``; ``columns`` of the decoded batch become
    the table's columns (default: the fields of the event; parameters bound
    by ``rows.bind_params`` are the other use). Bad bodies, and those whose
    ``required`` fields are null (default: the keys that are event fields),
    fail the batch or, with ``quarantine_path``, are written there keyed by
    batch id. With ``table`` the batch is appended to that keyed table as a delta
    instead, which costs by the batch and not by the buckets it touches.
    """
    from ..operators.upsert import upsert_table
    if required is None:
        required = keys if columns is None else ()
    columns = ["event.*"] if columns is None else columns

    def merge(rows: DataFrame) -> None:
        if table is not None:
            table.apply(rows)
        else:
            upsert_table(rows.sparkSession, path, rows, keys, order, buckets)

    def run(batch: DataFrame, batch_id: int) -> None:
        if body_col is None:
            merge(batch)
            return
        with _decoded(batch, batch_id, body_col, schema, quarantine_path, required) as good:
            merge(good.select(*columns))

    return run


def console_stream(stream: DataFrame, rows: int = 20, trigger: dict | None = None) -> StreamingQuery:
    """K7 for streams: print each micro-batch (a report, not a delivery)."""
    writer = stream.writeStream.format("console").option("numRows", str(rows)) \
        .option("truncate", "false")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
