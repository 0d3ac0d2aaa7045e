"""File folders as inputs: staging a table as a run of files, the way an
upstream producer drops them into a folder that a file stream reads (S6)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from ..plans.sizing import estimated_bytes

TARGET_FILE_BYTES = 128 * 1024 * 1024


def stage_files(df: DataFrame, path: str, min_files: int = 4, fmt: str = "parquet") -> int:
    """Write ``df`` as a run of files of bounded row count, without a
    shuffle: every task cuts its rows into files of ``maxRecordsPerFile``.
    The file count follows the estimated size, at least ``min_files``, and not
    the number of tasks that read ``df``: a stream that takes a file a batch
    pays a batch's fixed cost for each. Returns the number of rows per file."""
    rows = df.count()                        # parquet answers this from footers
    files = max(min_files, math.ceil(estimated_bytes(df) / TARGET_FILE_BYTES))
    per_file = max(1, math.ceil(rows / files))
    df.coalesce(files).write.format(fmt).option("maxRecordsPerFile", str(per_file)).save(path)
    return per_file
