"""File-table sinks: staged overwrite and partition-scoped replacement.

K2: a table can be saved over the very path it was read from. Spark refuses
(or empties the target) when a job overwrites its own input, so the rows are
first written to a sibling staging path; only after that job committed is
the old directory moved aside and the staged one moved in. A failure before
the swap leaves the old table untouched.

Every swap is described by a small manifest written after the staged job
committed and before the first rename. If the driver dies in the middle of
the renames, the next write to the table (or ``recover``) finishes the swap
from the manifest: the staged data is complete, so rolling forward is
always valid, and doing it twice changes nothing.

Keyed sinks (upsert, cells) hash their key into a fixed number of bucket
partitions and rewrite only the buckets a batch touches. The set of touched
buckets is bounded by the bucket count, never by the data.
"""

from __future__ import annotations

import json
import math
import uuid
import warnings
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import paths

BUCKET_COL = "bucket"


def _sibling(path: str, tag: str) -> str:
    return f"{path.rstrip('/')}.{tag}-{uuid.uuid4().hex[:10]}"


def _write_manifest(spark: SparkSession, target: str, manifest: dict) -> None:
    """Write the manifest under a temporary name, then rename it in place
    (a reader never sees a half-written manifest)."""
    tmp = f"{target}.tmp-{uuid.uuid4().hex[:10]}"
    paths.write_text(spark, tmp, json.dumps(manifest))
    paths.rename(spark, tmp, target)


def _read_manifest(spark: SparkSession, target: str) -> dict | None:
    return json.loads(paths.read_text(spark, target)) if paths.exists(spark, target) else None


def _overwrite_manifest(path: str) -> str:
    return f"{path.rstrip('/')}._swap.json"


def recover_overwrite(spark: SparkSession, path: str) -> None:
    """Finish a staged overwrite of ``path`` that a crash interrupted."""
    marker = _overwrite_manifest(path)
    m = _read_manifest(spark, marker)
    if m is None:
        return
    if paths.exists(spark, m["staging"]):
        if paths.exists(spark, path):
            paths.rename(spark, path, m["old"])
        paths.rename(spark, m["staging"], path)
    paths.delete(spark, m["old"])
    paths.delete(spark, marker)


def staged_overwrite(df: DataFrame, path: str, fmt: str = "parquet",
                     partition_by: list[str] | None = None,
                     before_swap: Callable[[str], None] | None = None) -> str:
    """Replace the table at ``path`` with ``df``, even if ``df`` reads it.
    ``before_swap`` may add files to the complete staged folder."""
    spark = df.sparkSession
    recover_overwrite(spark, path)       # a swap cut short by a crash comes first
    staging = _sibling(path, "staging")
    writer = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staging)
    if before_swap is not None:
        before_swap(staging)
    _write_manifest(spark, _overwrite_manifest(path),
                    {"staging": staging, "old": _sibling(path, "replaced")})
    recover_overwrite(spark, path)
    return path


def bucket_of(key_cols: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(buckets)).cast("int")


def touched_buckets(df: DataFrame) -> list[int]:
    """Distinct bucket ids of a batch (at most the bucket count)."""
    return sorted(r[0] for r in df.select(BUCKET_COL).distinct().collect())


def replace_buckets(spark: SparkSession, merged: DataFrame, path: str,
                    buckets: list[int], fmt: str = "parquet",
                    before_swap: Callable[[str], None] | None = None) -> None:
    """Write ``merged`` (already restricted to ``buckets``) and swap it in.

    Each touched bucket directory is replaced by rename after the whole
    staged write committed; other buckets are not read or written.
    ``before_swap`` gets the staged path once it is complete (to derive
    outputs from the new state before it becomes visible).
    """
    staging = _sibling(path, "staging")
    merged.write.mode("errorifexists").format(fmt).partitionBy(BUCKET_COL).save(staging)
    if before_swap is not None:
        before_swap(staging)
    present = set(paths.list_names(spark, path))
    written = set(paths.list_names(spark, staging))
    names = [f"{BUCKET_COL}={b}" for b in buckets]
    _write_manifest(spark, f"{path}/{SWAP_FILE}", {
        "staging": staging, "trash": _sibling(path, "replaced"),
        "install": [n for n in names if n in written],
        "remove": [n for n in names if n in present and n not in written]})
    recover(spark, path)


SWAP_FILE = "_swap.json"


def recover(spark: SparkSession, path: str) -> None:
    """Finish whatever swap at ``path`` a crash interrupted, of the whole table
    or of some buckets (no-op when none is pending). Each step checks what is
    already done."""
    recover_overwrite(spark, path)
    marker = f"{path}/{SWAP_FILE}"
    m = _read_manifest(spark, marker)
    if m is None:
        return
    staging, trash = m["staging"], m["trash"]
    for name in m["install"]:
        if paths.exists(spark, f"{staging}/{name}"):
            if paths.exists(spark, f"{path}/{name}"):
                paths.rename(spark, f"{path}/{name}", f"{trash}/{name}")
            paths.rename(spark, f"{staging}/{name}", f"{path}/{name}")
    for name in m["remove"]:
        if paths.exists(spark, f"{path}/{name}"):
            paths.rename(spark, f"{path}/{name}", f"{trash}/{name}")
    paths.delete(spark, trash)
    paths.delete(spark, staging)
    paths.delete(spark, marker)


BUCKETS_FILE = "_buckets"


def table_buckets(spark: SparkSession, path: str, sample: DataFrame | None = None,
                  buckets: int | None = None) -> int:
    """The bucket count of the keyed table at ``path``.

    Fixed when the table is created (an explicit ``buckets`` or sized from
    the measured bytes of ``sample``) and stored beside the data, so
    every later batch hashes keys to the same buckets.
    """
    recover(spark, path)
    marker = f"{path}/{BUCKETS_FILE}"
    if paths.exists(spark, marker):
        return int(paths.read_text(spark, marker).strip())
    if buckets is None:
        from ..plans.sizing import choose_buckets, measured_bytes
        buckets = choose_buckets(measured_bytes(sample)) if sample is not None else 1
    paths.write_text(spark, marker, str(int(buckets)))
    return int(buckets)


MERGE_PARTITION_BYTES = 32 * 1024 * 1024     # rows of a merge task, as text: some ten times that in memory if they are narrow
OUTGROWN_FACTOR = 4          # warn when a bucket holds this many times its target size


def merge_into_buckets(spark: SparkSession, path: str, batch: DataFrame,
                       reduce: Callable[[DataFrame], DataFrame], keys: list[str],
                       fmt: str = "parquet",
                       before_swap: Callable[[str], None] | None = None) -> list[int]:
    """Merge a keyed batch into the bucketed table at ``path``.

    ``batch`` must carry ``BUCKET_COL`` and be reduced to one row per key
    already (a partial-aggregated groupBy, so hot keys never cross the
    shuffle row by row). Stored rows of the touched buckets and the batch
    are range-partitioned once on ``(bucket, keys)`` into about 32 MB of rows
    per task (the batch's rows are measured, and stored rows counted at their
    width, since files are compressed), then ``reduce`` (a groupBy on keys and bucket, satisfied by that
    partitioning, so no further exchange) merges them. A task covers a
    contiguous key range of one or two buckets: no task grows with a
    bucket, and each bucket gets few files.
    """
    if batch.select(BUCKET_COL).schema[0].dataType.typeName() != "integer":
        raise TypeError(f"{BUCKET_COL} must be an int column")
    recover(spark, path)                 # a swap cut short by a crash comes first
    n = _bucket_count(spark, path)
    batch = _like_stored(spark, path, batch, keys, fmt)
    # The reduced batch (one row per key) is used twice: for the touched
    # buckets and for the merge. Keep it on the executors instead of running
    # the upstream plan again; a lost block is recomputed from lineage.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        hit = touched_buckets(batch)
        if hit:
            _merge_and_swap(spark, path, batch, hit, reduce, keys, n, fmt, before_swap)
        return hit
    finally:
        batch.unpersist()


def _like_stored(spark, path, batch, keys, fmt) -> DataFrame:
    """``batch`` with the stored column types. A batch that lacks stored columns
    would wipe them, and a key of another type hashes to another bucket: both
    are refused."""
    if not any(n.startswith(BUCKET_COL + "=") for n in paths.list_names(spark, path)):
        return batch
    stored = {f.name: f.dataType for f in spark.read.format(fmt).load(path).schema if f.name != BUCKET_COL}
    missing = [c for c in stored if c not in batch.columns]
    if missing:
        raise ValueError(f"the batch lacks stored columns {missing} of {path}")
    own = {f.name: f.dataType for f in batch.schema}
    changed = [k for k in keys if k in stored and own[k] != stored[k]]
    if changed:
        raise TypeError(f"the key columns {changed} have another type in {path}; cast them first")
    return batch.select(*[F.col(c).cast(stored[c]).alias(c) if c in stored and own[c] != stored[c] else F.col(c)
                          for c in batch.columns])


def _merge_and_swap(spark, path, batch, hit, reduce, keys, n, fmt, before_swap) -> None:
    from ..plans.sizing import TARGET_BUCKET_BYTES, measured_rows
    stored = read_buckets(spark, path, batch.schema, hit, fmt)
    # touched share of the stored bytes (one metadata call) plus the batch
    table_bytes = paths.size(spark, path)
    per_bucket = table_bytes // max(1, n or 1)
    if per_bucket > OUTGROWN_FACTOR * TARGET_BUCKET_BYTES:
        warnings.warn(f"keyed table {path} holds {per_bucket} bytes per bucket; "
                      f"consider files.rebucket with more buckets", stacklevel=3)
    rows, batch_bytes = measured_rows(batch)
    stored_bytes = max(per_bucket * len(hit), stored.count() * batch_bytes // max(1, rows))
    parts = max(1, math.ceil((stored_bytes + batch_bytes) / MERGE_PARTITION_BYTES))
    both = stored.unionByName(batch).repartitionByRange(
        parts, F.col(BUCKET_COL), *[F.col(k) for k in keys])
    replace_buckets(spark, reduce(both).select(*batch.columns), path, hit, fmt, before_swap)


def rebucket(spark: SparkSession, path: str, keys: list[str], buckets: int,
             fmt: str = "parquet") -> None:
    """Rewrite a keyed table with a new bucket count (for a table that grew
    far past the size it was created for). Staged, then swapped in."""
    recover(spark, path)
    old = spark.read.format(fmt).load(path)
    data = old.drop(BUCKET_COL).withColumn(BUCKET_COL, bucket_of(keys, buckets))
    parts = max(1, math.ceil(paths.size(spark, path) / MERGE_PARTITION_BYTES))
    marker = lambda staging: paths.write_text(spark, f"{staging}/{BUCKETS_FILE}", str(int(buckets)))
    staged_overwrite(data.repartitionByRange(parts, F.col(BUCKET_COL), *[F.col(k) for k in keys])
                     .select(*old.columns), path, fmt, partition_by=[BUCKET_COL], before_swap=marker)


def _bucket_count(spark: SparkSession, path: str) -> int | None:
    marker = f"{path}/{BUCKETS_FILE}"
    return int(paths.read_text(spark, marker).strip()) if paths.exists(spark, marker) else None


def read_buckets(spark: SparkSession, path: str, schema, buckets: list[int],
                 fmt: str = "parquet") -> DataFrame:
    """The stored rows of the given buckets (partition-pruned), or empty."""
    if not paths.exists(spark, path) or not paths.list_names(spark, path):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).format(fmt).load(path)
    return stored.filter(F.col(BUCKET_COL).isin(buckets))
