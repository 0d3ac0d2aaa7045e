"""End-to-end batch flows composed from the operators.

``range_report``: delimited text -> typed records (S1, D1) -> a named view
(D2) -> a SQL range query (D3, P1, P2) -> one string map per row (P3).
``save_parsed``: the parsed records saved over the folder they were read
from (K2), through staging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.rows import to_string_map
from ..operators.select import register_views, run_sql
from ..sinks.files import staged_overwrite
from ..sources import text

RANGE_SQL = "SELECT id, name, age FROM {view} WHERE age >= {lo} AND age <= {hi}"


def range_report(spark: SparkSession, lines_path: str, lo: int, hi: int,
                 view: str = "person") -> DataFrame:
    """Rows of the text at ``lines_path`` with ``lo <= age <= hi``, each as
    a ``map<string,string>`` keyed by column name (column ``m``)."""
    people = text.read_delimited(spark, lines_path, text.PEOPLE_SCHEMA).good
    register_views(spark, {view: people})
    found = run_sql(spark, RANGE_SQL.format(view=view, lo=int(lo), hi=int(hi)))
    return found.select(to_string_map("id", "name", "age").alias("m"))


def save_parsed(spark: SparkSession, lines_path: str, fmt: str = "parquet") -> None:
    """Replace the text folder with its parsed records (own input, staged)."""
    people = text.read_delimited(spark, lines_path, text.PEOPLE_SCHEMA).good
    staged_overwrite(people, lines_path, fmt)
