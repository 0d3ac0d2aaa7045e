"""Writing groups of rows (time windows) into tasks and files of bounded size.

A group may hold a few rows or nearly all of them. The rows are counted per
group first; groups above the target are counted again by slices of their
time range. From these counts every slice gets its place: small groups and
slices share a task, a slice that is too heavy alone (one instant may hold a
third of all rows) is split by a hash of its rows. The plan is a row for each
group with one entry for each slice: ``MAX_SLICES`` entries and ``MAX_GROUPS``
rows at most, so it is small enough to broadcast whatever the data hold.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 256 * 1024 * 1024
MAX_GROUPS = 4096        # groups of one write
MAX_SLICES = 32_768      # slices of all large groups of one write
SLICES_PER_PART = 4      # finer than the parts, so parts come out even

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16, T.NullType: 0}


def row_bytes(df: DataFrame) -> Column:
    """The width of a row in bytes: fixed widths, the lengths of texts, and the
    JSON length of nested values."""
    fixed, parts = 0, []
    for f in df.schema.fields:
        if type(f.dataType) in _FIXED:
            fixed += _FIXED[type(f.dataType)]
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
    total = F.lit(fixed).cast("long")
    for p in parts:
        total = total + p
    return total


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])


def _micros(time_col: str) -> Column:
    """A time as microseconds on the wall clock (a number stays one)."""
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", base, F.col(time_col).cast("timestamp_ntz"))


def plan_parts(sizes: dict[int, list[int]], target: int) -> tuple[dict[int, tuple[list[int], list[int]]], int]:
    """For each group its slices' (first part, number of parts), and the number of all
    parts. ``sizes`` holds the bytes of each group's slices, in order. Neighbours share
    a part until it is full; a slice over ``target`` has parts of its own."""
    out, part, filled = {}, 0, 0
    for group in sorted(sizes):
        first, count = [], []
        for size in sizes[group]:
            own = max(1, math.ceil(size / target))
            if filled and (own > 1 or filled + size > target):
                part, filled = part + 1, 0
            first.append(part)
            count.append(own)
            if own > 1:
                part, filled = part + own, 0
            else:
                filled += size
        out[group] = first, count
    return out, part + (1 if filled else 0)


def write_groups(df: DataFrame, path: str, group_col: str, time_col: str | None = None,
                 target_bytes: int = TARGET_BYTES, fmt: str = "parquet",
                 drop_time: bool = False) -> set[int]:
    """Replace the partitions ``group_col=N`` of ``path`` that ``df`` has rows for, and
    return them. No task and no file gets much more than ``target_bytes`` of rows, and
    their number follows the bytes, not the tasks of the input. With ``time_col`` a
    large group is cut by time, so its files cover time ranges; otherwise by row hash.
    """
    width, when = row_bytes(df), _micros(time_col) if time_col else F.lit(0).cast("long")
    sized = df.select(F.col(group_col).alias("g"), when.alias("t"), width.alias("b"))
    totals = {r.g: r for r in sized.groupBy("g").agg(
        F.count("*").alias("n"), F.sum("b").alias("b"), F.min("t").alias("lo"), F.max("t").alias("hi")
    ).limit(MAX_GROUPS + 1).collect()}
    if not totals:
        return set()
    if len(totals) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in one write; deliver fewer windows at a time")
    if None in totals:
        raise ValueError(f"{group_col} is null")
    everything = sum(r.b for r in totals.values())
    part_bytes = max(target_bytes, math.ceil(everything * SLICES_PER_PART / MAX_SLICES))
    large = {g: r for g, r in totals.items() if r.b > part_bytes and time_col and r.lo is not None and r.hi > r.lo}
    slices = {g: min(r.hi - r.lo + 1, SLICES_PER_PART * math.ceil(r.b / part_bytes)) for g, r in large.items()}
    steps = {g: (r.lo, -(-(r.hi - r.lo + 1) // slices[g]) if g in large else 1) for g, r in totals.items()}
    spark = df.sparkSession
    sizes = {g: [r.b] for g, r in totals.items()}
    if large:
        cut = F.broadcast(spark.createDataFrame([(g, *steps[g]) for g in large], "g long, lo long, step long"))
        found = defaultdict(dict)
        for r in (sized.join(cut, "g").groupBy("g", F.floor((F.col("t") - F.col("lo")) / F.col("step")).alias("s"))
                  .agg(F.sum("b").alias("b")).collect()):
            found[r.g][r.s] = r.b
        sizes |= {g: [found[g].get(s, 0) for s in range(slices[g])] for g in large}
    parts, n = plan_parts(sizes, part_bytes)
    per_file = max(1, math.floor(target_bytes / max(r.b / r.n for r in totals.values())))
    plan = spark.createDataFrame([(g, *steps[g], *parts[g]) for g in parts],
                                 "_g long, _lo long, _step long, _first array<int>, _count array<int>")
    at = F.floor((when - F.col("_lo")) / F.col("_step"))
    at = F.least(at, (F.size("_first") - 1).cast("long")).cast("int")
    part = F.get("_first", at) + F.pmod(row_hash(df), F.get("_count", at)).cast("int")
    columns = [c for c in df.columns if not (drop_time and c == time_col)]
    order = [group_col, time_col] if time_col else [group_col]
    (df.join(F.broadcast(plan), F.col(group_col) == F.col("_g"))
       .withColumn("_part", part).repartitionById(n, F.col("_part"))
       .sortWithinPartitions(*order).select(*columns)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", str(per_file)).partitionBy(group_col).format(fmt).save(path))
    return set(totals)
