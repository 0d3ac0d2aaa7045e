"""Time-window reads (S3) over any table with a time column.

A window is half-open, ``lo <= t < hi``: consecutive windows neither
overlap nor leave a gap, and a row stamped exactly at ``hi`` belongs to the
next window. Bounds are wall-clock text, fractions of a second included, cast to the
column's own type (timestamp or timestamp_ntz), so both comparisons reach
the scan as pushed filters (parquet row-group skipping, JDBC WHERE).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bound(df: DataFrame, time_col: str, value) -> Column:
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(df.schema[time_col].dataType)


def window_predicate(df: DataFrame, time_col: str, lo, hi) -> Column:
    t = F.col(time_col)
    return (t >= _bound(df, time_col, lo)) & (t < _bound(df, time_col, hi))


def read_window(df: DataFrame, time_col: str, lo, hi) -> DataFrame:
    """Rows of ``df`` with ``lo <= time_col < hi``."""
    return df.filter(window_predicate(df, time_col, lo, hi))


def split_windows(start: datetime, end: datetime, step: timedelta) -> list[tuple[datetime, datetime]]:
    """Consecutive half-open windows covering ``[start, end)``."""
    if step <= timedelta(0):
        raise ValueError("step must be positive")
    out, lo = [], start
    while lo < end:
        hi = min(lo + step, end)
        out.append((lo, hi))
        lo = hi
    return out


def truncate_to_second(t: datetime) -> datetime:
    """A poll starts and ends on whole seconds; window bounds between may not."""
    return t.replace(microsecond=0)


def read_until(df: DataFrame, time_col: str, hi) -> DataFrame:
    """Rows with ``time_col < hi`` (an open-start window)."""
    return df.filter(F.col(time_col) < _bound(df, time_col, hi))


def read_since(df: DataFrame, time_col: str, lo) -> DataFrame:
    """Rows with ``time_col >= lo`` (an open-end window)."""
    return df.filter(F.col(time_col) >= _bound(df, time_col, lo))
