"""Group completeness over a stream: emit each group once, when its
members first cover the required set (X2, stream form).

State is a keyed file table ``(group, mask, completed_batch, bucket)``
holding the member mask of each group (a long for each 62 names). Per micro-batch:

1. the batch is reduced to ``(group, bit_or(member bits))`` with map-side
   partial aggregation (a hot group costs one row per task);
2. the touched state buckets are merged with it in one aggregation:
   ``mask = bit_or``, ``completed_batch`` = the stored value, or this
   batch's id when the mask just became full;
3. groups with ``completed_batch == batch_id`` are written to the output
   partition ``batch_id=N`` *before* the new state is swapped in.

A replay of batch N after a crash sees either the old state (same result)
or the new one, where those groups already carry ``completed_batch = N``:
the emission is the same both times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.groups import is_full, mask_columns, member_mask
from ..sinks import files
from .delivery import write_batch

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_state_store(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB and checkpoint changes only, unless the
    session has chosen a store. Call it before the query starts."""
    provider = next(iter(STATE_STORE))
    if "RocksDB" in spark.conf.get(provider, ""):
        return
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def complete_stream(stream: DataFrame, group: str, member: str, required: Sequence[str]) -> DataFrame:
    """X2 on Spark's state store: the groups of a stream, each in the batch in which
    its members first cover ``required`` (extra members allowed; with nothing
    required, the batch in which it is first seen). Run it in update mode.

    The state of a group is, for each required name, the time of the batch that
    first held it. A group completes at the latest of these times, and a batch
    reports the groups that it changes, so those whose completion is the batch's
    own time are the new ones: no output is read back. A replayed batch has the
    time it had before and reports the same groups. Rows are reduced in their
    tasks before the shuffle, so a hot group costs a row for each task; a batch
    writes the state of the groups that it changes. (Should the driver's clock be
    set back between two batches, a complete group may be reported again.)
    """
    names = list(dict.fromkeys(required))
    now = F.col("_now")
    if names:
        stream = stream.where(F.col(member).isin(names))
    stream = stream.select(group, member, F.current_timestamp().alias("_now"))
    first = [F.min(F.when(F.col(member) == name, now)).alias(f"_first{i}") for i, name in enumerate(names)] \
        or [F.min(now).alias("_first0")]
    seen = stream.groupBy(group).agg(*first, F.max(now).alias("_last"))
    times = [F.col(f"_first{i}") for i in range(len(first))]
    ok = times[0].isNotNull()
    for t in times[1:]:
        ok = ok & t.isNotNull()
    done = F.greatest(*times) if len(times) > 1 else times[0]
    return seen.where(ok & (done == F.col("_last"))).select(group)


def start_complete(stream: DataFrame, checkpoint: str, out_path: str, group: str, member: str,
                   required: Sequence[str], trigger: dict | None = None):
    """Run ``complete_stream``: newly complete groups go to ``batch_id=N`` of ``out_path``."""
    use_state_store(stream.sparkSession)
    writer = (complete_stream(stream, group, member, required).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, batch_id: write_batch(df, out_path, batch_id)))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def completeness_batch(state_path: str, out_path: str, group: str, member: str,
                       required: Sequence[str], buckets: int = 16):
    """``foreachBatch`` function maintaining completeness state."""
    req = list(dict.fromkeys(required))
    masked = mask_columns(len(req))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        if batch.isEmpty():          # an empty file: nothing can complete
            return
        n = files.table_buckets(spark, state_path, None, buckets)
        masks = (member_mask(batch, group, member, req)
                 .withColumn("completed_batch", F.lit(None).cast("long"))
                 .withColumn(files.BUCKET_COL, files.bucket_of([group], n)))

        def reduce(both: DataFrame) -> DataFrame:
            agg = both.groupBy(group, files.BUCKET_COL).agg(
                *[F.bit_or(m).alias(m) for m in masked],
                F.min("completed_batch").alias("_prev"))
            done = F.when(is_full(len(req)), F.lit(batch_id).cast("long"))
            return agg.select(group, *masked,
                              F.coalesce(F.col("_prev"), done).alias("completed_batch"),
                              files.BUCKET_COL)

        def emit(staged: str) -> None:
            newly = (spark.read.schema(masks.schema).parquet(staged)
                     .filter(F.col("completed_batch") == F.lit(batch_id))
                     .select(group))
            write_batch(newly, out_path, batch_id)

        files.merge_into_buckets(spark, state_path, masks, reduce, [group], before_swap=emit)

    return run
