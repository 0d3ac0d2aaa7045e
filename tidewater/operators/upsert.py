"""Keyed upsert: keep the latest row per key by an explicit order.

"Latest" is decided by the caller's order columns, never by arrival order,
so replaying an older batch changes nothing. The reduction is
``max(struct(order..., payload...))`` grouped by key: a declarative
aggregate with map-side partial aggregation, so a key holding a third of
all rows is collapsed inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import files


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Ties on the whole order tuple are broken by the remaining columns (maps and
    variants, which have no order, by their JSON text), so the result is
    deterministic; callers should make ties impossible.
    """
    keys, order = list(keys), list(order)
    if set(keys) & set(order):
        raise ValueError("a column cannot be both a key and an order column")
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order + rest])
    loose = [c for c in rest if not _orderable(df.schema[c].dataType)]
    if loose:
        by = [F.col(c) for c in order + [c for c in rest if c not in loose]]
        packed = F.max_by(row, F.struct(*by, F.to_json(F.struct(*loose)).alias("_text")))
    else:
        packed = F.max(row)
    packed = packed.alias("_latest")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in order + rest])
            .select(*df.columns))


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """The table after applying ``updates`` to ``base`` (insert or update)."""
    return latest_per_key(base.unionByName(updates), keys, order)


def _has_rows(spark: SparkSession, path: str) -> bool:
    from .. import paths
    return paths.exists(spark, path) and any(
        n.startswith(files.BUCKET_COL + "=") for n in paths.list_names(spark, path))


def update_existing(spark: SparkSession, path: str, updates: DataFrame,
                    keys: Sequence[str]) -> DataFrame:
    """The rows of ``updates`` (one per key) whose key is already stored at
    ``path``, with the stored values of the columns they do not name: a join
    that reads the key and those columns only. A stored key is unique."""
    stored = spark.read.parquet(path)
    unnamed = [c for c in stored.columns if c not in updates.columns and c != files.BUCKET_COL]
    return updates.join(stored.select(*keys, *unnamed), list(keys))


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                 order: Sequence[str], buckets: int | None = None, mode: str = "upsert") -> None:
    """Apply ``updates`` to the file table at ``path`` in place.

    Rows are hash-bucketed on the key; only buckets present in the batch are
    read, merged and swapped in. A replayed batch yields the same buckets.
    The bucket count is fixed at creation (``buckets`` or sized from the
    first batch's measured bytes). ``mode='update'`` changes existing keys
    only; columns that ``updates`` does not name keep their stored values.
    """
    keys, order = list(keys), list(order)
    if files.BUCKET_COL in updates.columns:
        raise ValueError(f"the column name {files.BUCKET_COL} is taken by the table itself")
    if mode == "update":
        files.recover(spark, path)
        if not _has_rows(spark, path):
            return                       # nothing stored: nothing to update
        updates = update_existing(spark, path, latest_per_key(updates, keys, order), keys)
    elif mode != "upsert":
        raise ValueError("file tables support update or upsert; use an append for insert")
    bkeys = keys + [files.BUCKET_COL]
    n = files.table_buckets(spark, path, updates, buckets)
    batch = latest_per_key(updates.withColumn(files.BUCKET_COL, files.bucket_of(keys, n)),
                           bkeys, order)
    files.merge_into_buckets(spark, path, batch, lambda both: latest_per_key(both, bkeys, order), keys)
