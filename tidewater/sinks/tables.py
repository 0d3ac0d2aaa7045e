"""Row-literal inserts (K6), driver collection (K1) and console output (K7)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, like: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Literal rows typed like ``like`` (for a union before a save)."""
    return spark.createDataFrame(list(rows), like.schema)


def insert_values(spark: SparkSession, table: str, columns: Sequence[str],
                  rows: Sequence[tuple]) -> None:
    """K6: ``INSERT INTO table(cols) VALUES ...`` on a catalog table.

    Values are bound through a DataFrame, not spliced into SQL text.
    """
    target = spark.table(table)
    cols = list(columns)
    schema = target.select(*cols).schema
    df = spark.createDataFrame(list(rows), schema)
    # insertInto is positional: fill the other columns with nulls, in order.
    from pyspark.sql import functions as F
    full = df.select(*[F.col(c) if c in cols else F.lit(None).cast(target.schema[c].dataType).alias(c)
                       for c in target.columns])
    full.write.insertInto(table)


def iter_maps(df: DataFrame, map_col: str) -> Iterator[dict]:
    """K1: the values of a map column, streamed to the driver one partition
    at a time (the driver never holds more than one partition).

    For results known to be small, e.g. a report over a filtered table.
    """
    for row in df.select(map_col).toLocalIterator():
        yield row[0]


def show(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """K7: print the first ``n`` rows (a report, not a delivery)."""
    df.show(n, truncate=truncate)
