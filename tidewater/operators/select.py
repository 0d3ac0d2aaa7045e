"""Views, SQL text queries, projection and the band filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.rows import in_range


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Name tables for SQL (session scope)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """D3: a SQL text query over registered (or given) views."""
    if views:
        register_views(spark, views)
    return spark.sql(sql)


def band_filter(df: DataFrame, column: str, lo, hi, columns: Sequence[str] | None = None) -> DataFrame:
    """P1 + P2: rows with ``lo <= column <= hi``, projected to ``columns``."""
    out = df.filter(in_range(column, lo, hi))
    return out.select(*columns) if columns else out
