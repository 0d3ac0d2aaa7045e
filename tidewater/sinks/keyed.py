"""Keyed tables that grow: appended deltas, merged on read, folded bit by bit (K4, K5).

A batch is reduced to one row per key and appended as a delta; nothing stored
is read. A reader merges base and deltas: the row with the greatest order tuple
wins, so a replayed or late batch changes nothing and it does no harm to apply
a delta twice.

The base is cut into buckets, each a range of the key's hash named by its
leading bits. Every batch earns a credit of ``1 + 1 / share`` times its bytes,
and as many buckets as that pays for are merged with their deltas and rewritten,
``TURN`` or more at a time round the table. So what a batch writes is bounded by
the batch and a few buckets, not by the table, while deltas stay at about ``share`` of
the base. A bucket that has outgrown ``bucket_bytes`` is split there into
buckets with longer prefixes; no other bucket is touched and no key moves.
Equal runs of ``RUN`` small deltas are merged into one, so their number grows
with the logarithm of the batches.

All files are immutable and the state is one manifest (``versions``), so a
crash at any point leaves the version before, and readers keep theirs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import paths
from ..operators.upsert import latest_per_key
from . import versions

HASH = "_h"                  # the key's hash, stored with each row
BUCKET = "_b"
BUCKET_BYTES = 256 * 1024 * 1024
SHARE = 0.5
RUN = 8
TURN = 4
TOP = 1 << 63


def _low(bits: str) -> int:
    """The smallest hash (signed) of a bucket."""
    return int(bits.ljust(64, "0"), 2) - TOP


def _width(bits: str) -> float:
    return 2.0 ** -len(bits)


def bucket_index(prefixes: Sequence[str]) -> Column:
    """The index of a row's bucket among ``prefixes``, neighbours in hash order: an
    array of the buckets' ends is looked up by the leading bits of the hash."""
    depth = max(map(len, prefixes))
    if not depth:
        return F.lit(0)
    first = int(prefixes[0].ljust(depth, "0"), 2)
    at = [i for i, bits in enumerate(prefixes) for _ in range(1 << (depth - len(bits)))]
    leading = F.shiftrightunsigned(F.col(HASH).bitwiseXOR(F.lit(-TOP)), 64 - depth) - F.lit(first)
    return F.get(F.lit(at), leading.cast("int"))


def split(bits: str, size: float, target: int) -> list[str]:
    """The prefixes of a bucket of ``size`` bytes after the splits that it needs."""
    deeper = max(0, math.ceil(math.log2(size / target))) if size > target else 0
    return [bits + format(i, f"0{deeper}b") for i in range(1 << deeper)] if deeper else [bits]


@dataclass
class KeyedTable:
    """The table at ``path``; keys, order and hashed columns are fixed by its first batch."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    order: Sequence[str]
    bucket_bytes: int = BUCKET_BYTES
    share: float = SHARE
    hashed: Sequence[str] = field(default=())       # default: all keys

    def __post_init__(self):
        self.keys, self.order = list(self.keys), list(self.order)
        self.hashed = list(self.hashed) or self.keys
        if not set(self.hashed) <= set(self.keys):
            raise ValueError("hashed columns must be keys")

    # --- reading --------------------------------------------------------------

    def _load(self, m: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        stored = T.StructType([*schema.fields, T.StructField(HASH, T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows, one per key. Without pending deltas this is a plain scan."""
        m = versions.manifest(self.spark, self.path, version)
        if m is None:
            raise FileNotFoundError(f"{self.path} has no version")
        columns = T.StructType.fromJson(json.loads(m["schema"])).names
        return self._merged(m, m["buckets"], m["deltas"]).select(*columns)

    def _merged(self, m: dict, buckets: list[dict], deltas: list[dict]) -> DataFrame:
        rows = self._load(m, [b["folder"] for b in buckets if b["folder"]] + [d["folder"] for d in deltas])
        return latest_per_key(rows, [*self.keys, HASH], self.order) if deltas else rows

    # --- writing --------------------------------------------------------------

    def _conform(self, m: dict | None, batch: DataFrame) -> DataFrame:
        if taken := [c for c in batch.columns if c in (HASH, BUCKET)]:
            raise ValueError(f"the column names {taken} are taken by the table itself")
        if m is not None:
            if [m["keys"], m["order"], m["hashed"]] != [self.keys, self.order, self.hashed]:
                raise ValueError(f"{self.path} was made with other keys: {m['keys']}, {m['order']}, {m['hashed']}")
            schema = T.StructType.fromJson(json.loads(m["schema"]))
            own = {f.name: f.dataType for f in batch.schema}
            if set(own) != set(schema.names):
                raise ValueError(f"the columns of the batch are not those of {self.path}: {schema.names}")
            if wrong := [k for k in self.keys if own[k] != schema[k].dataType]:
                raise TypeError(f"the key columns {wrong} have another type in {self.path}; cast them first")
            batch = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if own[f.name] != f.dataType
                                   else F.col(f"`{f.name}`") for f in schema])
        return batch.withColumn(HASH, F.xxhash64(*[F.col(k) for k in self.hashed]))

    def apply(self, batch: DataFrame) -> int:
        """Insert or update the rows of ``batch`` by key; returns the new version."""
        m = versions.manifest(self.spark, self.path)
        reduced = latest_per_key(self._conform(m, batch), [*self.keys, HASH], self.order)
        if m is None:
            m = {"keys": self.keys, "order": self.order, "hashed": self.hashed, "seq": 0, "credit": 0.0, "next": "",
                 "schema": T.StructType([f for f in reduced.schema if f.name != HASH]).json(),
                 "buckets": [{"bits": "", "folder": None, "bytes": 0, "seq": 0}], "deltas": [], "version": -1}
        m["credit"] += self._append(m, reduced)["bytes"] * (1 + 1 / self.share)
        self._fold(m)
        self._merge_runs(m)
        m["folders"] = [x["folder"] for x in (*m["buckets"], *m["deltas"]) if x["folder"]]
        return versions.publish(self.spark, self.path, m, m["version"])

    def update(self, batch: DataFrame) -> int | None:
        """Change stored keys only; columns that ``batch`` does not name keep their
        values. Reads the buckets that hold the batch's keys, and no others."""
        m = versions.manifest(self.spark, self.path)
        if m is None:
            return None
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        unnamed = [c for c in schema.names if c not in batch.columns]
        if lost := [c for c in unnamed if c in self.keys + self.order]:
            raise ValueError(f"an update names its keys and order columns; missing: {lost}")
        own = {f.name: f.dataType for f in batch.schema}
        if wrong := [k for k in self.keys if own[k] != schema[k].dataType]:
            raise TypeError(f"the key columns {wrong} have another type in {self.path}; cast them first")
        batch = latest_per_key(batch.withColumn(HASH, F.xxhash64(*[F.col(k) for k in self.hashed])),
                               [*self.keys, HASH], self.order)
        index = bucket_index([b["bits"] for b in m["buckets"]])
        hit = {r[0] for r in batch.select(index.alias("i")).distinct().collect()}      # one per bucket at most
        buckets = [b for i, b in enumerate(m["buckets"]) if i in hit]
        stored = self._merged(m, buckets, m["deltas"]).select(*self.keys, HASH, *unnamed)
        on = [batch[c].eqNullSafe(stored[c]) for c in [*self.keys, HASH]]
        joined = batch.join(stored, on).select(*[batch[c] for c in batch.columns if c != HASH],
                                               *[stored[c] for c in unnamed])
        return self.apply(joined.select(*schema.names))

    def _append(self, m: dict, reduced: DataFrame) -> dict:
        """Write a delta, each file sorted by hash: a fold reads the pages of its range."""
        folder = self._write(reduced)
        m["seq"] += 1
        m["deltas"].append({"seq": m["seq"], "folder": folder, "level": 0,
                            "bytes": paths.size(self.spark, f"{self.path}/{folder}")})
        return m["deltas"][-1]

    def _write(self, rows: DataFrame) -> str:
        folder = versions.new_folder(self.path)
        rows.sortWithinPartitions(HASH).write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def _merge_runs(self, m: dict) -> None:
        """Merge the last RUN deltas of one level into one of the next."""
        while len(m["deltas"]) >= RUN and len({d["level"] for d in m["deltas"][-RUN:]}) == 1:
            run = m["deltas"][-RUN:]
            folder = self._write(self._merged(m, [], run))
            m["deltas"][-RUN:] = [{"seq": run[-1]["seq"], "folder": folder, "level": run[0]["level"] + 1,
                                   "bytes": paths.size(self.spark, f"{self.path}/{folder}")}]

    def _pending(self, m: dict, bucket: dict) -> float:
        """Bytes of the deltas that a bucket has not got yet: hashes are even, so its
        share of a delta is its share of the hashes."""
        return sum(d["bytes"] for d in m["deltas"] if d["seq"] > bucket["seq"]) * _width(bucket["bits"])

    def _fold(self, m: dict) -> None:
        """Rewrite the next buckets round the table, as far as the credit goes; it is
        saved until it pays for ``TURN`` of them, or what is left of the table."""
        start = next((i for i, b in enumerate(m["buckets"]) if b["bits"].startswith(m["next"])), 0)
        turn, cost = [], 0.0
        for b in m["buckets"][start:]:
            need = b["bytes"] + self._pending(m, b)
            if cost + need > m["credit"]:
                break
            turn.append(b)
            cost += need
        if not turn or len(turn) < min(TURN, len(m["buckets"]) - start):
            return
        m["credit"] -= cost
        after = start + len(turn)
        m["next"] = m["buckets"][after]["bits"] if after < len(m["buckets"]) else ""
        m["buckets"][start:after] = self._rewrite(m, turn)
        done = min(b["seq"] for b in m["buckets"])
        m["deltas"] = [d for d in m["deltas"] if d["seq"] > done]
        if not m["deltas"]:
            m["credit"] = 0.0            # nothing is owed; a later batch pays for its own

    def _rewrite(self, m: dict, turn: list[dict]) -> list[dict]:
        """The buckets (neighbours) merged with their deltas, split where they are full."""
        prefixes = [p for b in turn for p in split(b["bits"], b["bytes"] + self._pending(m, b), self.bucket_bytes)]
        since = min(b["seq"] for b in turn)
        rows = self._load(m, [b["folder"] for b in turn if b["folder"]]
                          + [d["folder"] for d in m["deltas"] if d["seq"] > since])
        low, high = _low(turn[0]["bits"]), _low(turn[-1]["bits"]) + (1 << (64 - len(turn[-1]["bits"]))) - 1
        rows = rows.where(F.col(HASH).between(low, high)).withColumn(BUCKET, bucket_index(prefixes))
        # a task holds one bucket, and the merge needs no exchange of its own
        merged = latest_per_key(rows.repartitionById(len(prefixes), F.col(BUCKET)),
                                [BUCKET, *self.keys, HASH], self.order)
        folder = versions.new_folder(self.path)
        (merged.sortWithinPartitions(BUCKET, HASH).write.mode("errorifexists").partitionBy(BUCKET)
            .parquet(f"{self.path}/{folder}"))
        full = set(paths.list_names(self.spark, f"{self.path}/{folder}"))
        out = []
        for i, bits in enumerate(prefixes):
            own = f"{folder}/{BUCKET}={i}" if f"{BUCKET}={i}" in full else None
            out.append({"bits": bits, "folder": own, "seq": m["seq"],
                        "bytes": paths.size(self.spark, f"{self.path}/{own}") if own else 0})
        return out
