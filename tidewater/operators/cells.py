"""Wide-column cells: events to (rowkey, family, qualifier, value) and the
cell-store put.

An event becomes one cell per field present in it. The row key is the
key field's text reversed (spreads sequential keys over key ranges); the
key field is also kept, un-reversed, as an ordinary cell. A null value is
stored as the text ``null`` unless ``null_values='skip'``.

Putting cells: the latest write to ``(rowkey, family, qualifier)`` wins by
the caller's order columns (not arrival order); cells absent from an event
keep their stored value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NULL_TEXT
from ..functions.rows import NULL_KEY_FAIL, reverse_key
from .. import paths
from ..sinks import files

CELL_COLUMNS = ["rowkey", "family", "qualifier", "value"]


def event_cells(events: DataFrame, event_col: str, key_field: str, family: str,
                order: Sequence[str] = (), null_values: str = "text",
                on_null_key: str = NULL_KEY_FAIL) -> DataFrame:
    """Explode decoded events (``map<string,string>``) into cells.

    Absent fields give no cell; only fields present in the map are emitted.
    """
    ev = F.col(event_col)
    # explode_outer, then drop the empty rows: plain explode makes Catalyst
    # infer a size(map) > 0 filter and inline the decoding into it, which
    # decodes every event a second and third time. The row key is computed
    # after the filter, so an empty event gives no cell (and no key check).
    exploded = events.select(
        ev.getItem(key_field).alias("_key"),
        F.explode_outer(ev).alias("qualifier", "value"),
        *[F.col(c) for c in order],
    ).filter(F.col("qualifier").isNotNull())
    cells = exploded.select(
        reverse_key("_key", on_null_key).alias("rowkey"),
        F.lit(family).alias("family"),
        "qualifier", "value", *order)
    if null_values == "skip":
        cells = cells.filter(F.col("value").isNotNull())
    elif null_values == "text":
        cells = cells.withColumn("value", F.coalesce(F.col("value"), F.lit(NULL_TEXT)))
    else:
        raise ValueError("null_values must be 'text' or 'skip'")
    return cells.select(*CELL_COLUMNS, *order)


def column_cells(df: DataFrame, key_col: str, value_cols: Sequence[str], family: str,
                 order: Sequence[str] = (), on_null_key: str = NULL_KEY_FAIL) -> DataFrame:
    """Dense form: every listed column becomes a cell (``unpivot``)."""
    cols = list(value_cols)
    as_text = df.select(
        reverse_key(F.col(key_col), on_null_key).alias("rowkey"),
        *[F.col(c).alias(f"_order_{c}") for c in order],     # an order column may be a cell too
        *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)).alias(c) for c in cols],
    )
    long = as_text.unpivot(["rowkey", *[f"_order_{c}" for c in order]], cols, "qualifier", "value")
    return long.select("rowkey", F.lit(family).alias("family"), "qualifier", "value",
                       *[F.col(f"_order_{c}").alias(c) for c in order])


def merge_cells(cells: DataFrame, order: Sequence[str]) -> DataFrame:
    """Latest value per cell by ``order``; partial-aggregated per task."""
    order = list(order)
    latest = F.max(F.struct(*[F.col(c) for c in order], F.col("value"))).alias("_w")
    keys = ["rowkey", "family", "qualifier"]
    extra = [c for c in cells.columns if c not in keys + order + ["value"]]
    return (cells.groupBy(*keys, *extra).agg(latest)
            .select(*keys, F.col("_w.value").alias("value"),
                    *[F.col(f"_w.{c}").alias(c) for c in order], *extra))


def put_cells(spark: SparkSession, path: str, cells: DataFrame, order: Sequence[str],
              buckets: int | None = None, must_exist: bool = False) -> None:
    """K5 against a file cell table at ``path``: read touched row-key buckets,
    merge with the new cells, swap the buckets in. With ``must_exist`` a
    missing table fails before any job runs (instead of being created)."""
    if must_exist and not paths.exists(spark, f"{path}/{files.BUCKETS_FILE}"):
        raise FileNotFoundError(f"cell table does not exist: {path}")
    n = files.table_buckets(spark, path, cells, buckets)
    batch = merge_cells(cells.withColumn(files.BUCKET_COL, files.bucket_of(["rowkey"], n)),
                        order)
    files.merge_into_buckets(spark, path, batch, lambda both: merge_cells(both, order),
                             ["rowkey", "family", "qualifier"])
