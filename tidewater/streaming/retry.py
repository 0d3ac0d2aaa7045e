"""Failing events that are offered again: a ledger with attempt counts.

An event that does not decode is kept by the hash of its body, with the number
of attempts and of copies. The next batch offers it again beside its own
events; after ``max_attempts`` it is set aside. So a failing event neither
stops the events behind it nor gets lost, and one that decodes later, say when
the rows it refers to have arrived, lands once for each time it was sent.

The ledger is a keyed table with deltas, so a batch writes what it changes.
A batch notes the ledger's version before its first write; a replay reads that
version again and so repeats the same outcome.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import paths
from ..functions.rows import is_nonempty
from ..sinks import versions
from ..sinks.keyed import KeyedTable
from .delivery import write_batch

WAITING, LANDED, ASIDE = "waiting", "landed", "aside"
LEDGER = "body_hash string, body string, attempts int, copies long, state string, batch_id long"
KEEP_NOTES = 100


class RetryLedger:
    """The ledger at ``path``: one row per distinct failing body."""

    def __init__(self, spark: SparkSession, path: str, max_attempts: int = 3):
        if max_attempts < 1:
            raise ValueError("max_attempts must be at least 1")
        self.spark, self.path, self.max_attempts = spark, path.rstrip("/"), max_attempts
        self.table = KeyedTable(spark, f"{self.path}/events", ["body_hash"], ["batch_id"])

    def read(self, version: int | None = None) -> DataFrame:
        """All failing bodies with their state: waiting, landed or aside."""
        if version == -1 or (version is None and not versions.versions(self.spark, self.table.path)):
            return self.spark.createDataFrame([], LEDGER)
        return self.table.read(version)

    def version_before(self, batch_id: int) -> int:
        """The ledger's version as the batch first saw it (-1: none yet)."""
        note = f"{self.path}/notes/{batch_id}"
        if paths.exists(self.spark, note):
            return int(paths.read_text(self.spark, note))
        known = versions.versions(self.spark, self.table.path)
        version = known[-1] if known else -1
        paths.write_text(self.spark, f"{note}.tmp", str(version))
        paths.rename(self.spark, f"{note}.tmp", note)
        paths.delete(self.spark, f"{self.path}/notes/{batch_id - KEEP_NOTES}")
        return version


def retry_batch(out_path: str, ledger: RetryLedger, decode: Callable[[DataFrame, int], Column],
                transform: Callable[[DataFrame], DataFrame] | None = None, body_col: str = "body",
                event_col: str = "event") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: bodies whose ``decode(rows, batch_id)`` is not null
    land in ``batch_id=N`` of ``out_path``, the others wait in the ledger.

    Empty bodies are skipped. A body that was sent twice lands twice. Equal failing
    bodies are one row of the ledger with their number of copies, reduced in their
    tasks, so a body that makes up a third of a batch costs a row a task. A body
    that was set aside and is sent again starts anew.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        before = ledger.version_before(batch_id)
        fresh = batch.where(is_nonempty(body_col)).select(
            F.col(body_col).alias("body"), F.lit(0).alias("attempts"), F.lit(1).cast("long").alias("copies"))
        waiting = ledger.read(before).where(F.col("state") == WAITING).select("body", "attempts", "copies")
        offered = fresh.unionByName(waiting)
        decoded = offered.withColumn(event_col, decode(offered, batch_id)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = decoded.where(F.col(event_col).isNotNull())
            landed = good.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))) \
                .select("body", event_col)
            write_batch(transform(landed) if transform is not None else landed, out_path, batch_id)
            failed = decoded.where(F.col(event_col).isNull()).groupBy("body").agg(
                (F.max("attempts") + 1).cast("int").alias("attempts"), F.sum("copies").alias("copies"))
            state = F.when(F.col("attempts") >= ledger.max_attempts, ASIDE).otherwise(WAITING)
            kept = failed.withColumn("state", state)
            done = good.where("attempts > 0").select("body", "attempts", "copies", F.lit(LANDED).alias("state"))
            rows = kept.unionByName(done).select(
                F.sha2("body", 256).alias("body_hash"), "body", "attempts", "copies", "state",
                F.lit(batch_id).cast("long").alias("batch_id"))
            if not rows.isEmpty():
                ledger.table.apply(rows)
        finally:
            decoded.unpersist()

    return run
