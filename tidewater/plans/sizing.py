"""Size estimates from the optimizer, used to decide layout and broadcasts.

Nothing here counts rows: estimates come from Catalyst's statistics of the
optimized plan (file sizes for scans, propagated through operators).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target size of one bucket of a keyed file table (compressed bytes on disk
# are smaller; this is the in-memory estimate Catalyst reports).
TARGET_BUCKET_BYTES = 256 * 1024 * 1024
MAX_BUCKETS = 8192


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (may be an over-estimate).

    Where the optimizer's statistics are not reachable (e.g. Spark Connect),
    the total size of the input files is used instead.
    """
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001
        return input_bytes(df)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as text, summed by a job: right also for a frame
    without statistics."""
    return measured_rows(df)[1]


def measured_rows(df: DataFrame) -> tuple[int, int]:
    """The rows of ``df`` and their bytes as text."""
    if not df.columns:
        return df.count(), 0
    row = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    n, size = df.agg(F.count("*"), F.sum(row)).first()
    return int(n), int(size or 0)


def input_bytes(df: DataFrame) -> int:
    """Total size of the files ``df`` reads (0 when it reads none)."""
    files = df.inputFiles()
    if not files:
        return 0
    from .. import paths
    return sum(paths.size(df.sparkSession, f) for f in files)


def choose_buckets(size_bytes: int, target: int = TARGET_BUCKET_BYTES) -> int:
    """Bucket count for a table of about ``size_bytes``, as a power of two."""
    n = max(1, math.ceil(size_bytes / target))
    return min(MAX_BUCKETS, 1 << (n - 1).bit_length())
