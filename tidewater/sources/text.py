"""Delimited text scan: one record per line, fields at fixed positions.

The scan is ``spark.read.text`` plus column expressions, so it splits into
file blocks like any text read and never leaves the JVM. Field checks are
strict: an integral field must be an optional sign and digits only
(surrounding blanks and tabs are rejected) and must fit its type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import PEOPLE_FIELDS, PEOPLE_SEPARATOR

_TYPES = {"long": T.LongType(), "string": T.StringType(), "int": T.IntegerType()}

# The record layout of the people fixture (position -> name, type).
PEOPLE_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in PEOPLE_FIELDS])

ON_BAD_FAIL = "fail"
ON_BAD_QUARANTINE = "quarantine"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INT_PATTERN = r"^[+-]?[0-9]+$"


@dataclass
class ScanResult:
    good: DataFrame
    bad: DataFrame | None


def _field_checks(parts: Column, schema: T.StructType) -> tuple[list[Column], Column]:
    values, ok = [], F.lit(True)
    n = len(schema.fields)
    ok = ok & (F.size(parts) >= n)
    for i, field in enumerate(schema.fields):
        raw = F.element_at(parts, i + 1)  # null when the line is short
        if isinstance(field.dataType, _INTEGRAL):
            typed = raw.try_cast(field.dataType)
            ok = ok & raw.rlike(_INT_PATTERN) & typed.isNotNull()
        elif isinstance(field.dataType, T.StringType):
            typed = raw
            ok = ok & raw.isNotNull()          # an empty text field is a value
        else:
            typed = raw.try_cast(field.dataType)
            ok = ok & typed.isNotNull()
        values.append(typed.alias(field.name))
    return values, F.coalesce(ok, F.lit(False))


def parse_lines(lines: DataFrame, schema: T.StructType = PEOPLE_SCHEMA, sep: str = PEOPLE_SEPARATOR,
                on_bad: str = ON_BAD_FAIL, line_col: str = "value") -> ScanResult:
    """Split each line on ``sep`` (a literal, not a pattern) and type fields.

    Fields past the schema are ignored. With ``on_bad='fail'`` a bad line
    fails the task that meets it; with ``'quarantine'`` bad lines come back
    in ``ScanResult.bad`` with the original text.
    """
    if not sep or "\\E" in sep:
        raise ValueError("separator must be non-empty literal text")
    parts = F.split(F.col(line_col), "\\Q" + sep + "\\E", -1)   # Java regex literal quoting
    values, ok = _field_checks(parts, schema)
    staged = lines.select(F.col(line_col).alias("_line"), ok.alias("_ok"), *values)
    names = [f.name for f in schema.fields]
    if on_bad == ON_BAD_FAIL:
        checked = staged.select(
            *[F.when(F.col("_ok"), F.col(n)).otherwise(
                F.raise_error(F.concat(F.lit("bad record: "), F.col("_line")))
            ).cast(schema[n].dataType).alias(n) for n in names])
        return ScanResult(checked, None)
    if on_bad != ON_BAD_QUARANTINE:
        raise ValueError("on_bad must be 'fail' or 'quarantine'")
    good = staged.filter(F.col("_ok")).select(*names)
    bad = staged.filter(~F.col("_ok")).select(F.col("_line").alias("line"))
    return ScanResult(good, bad)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType = PEOPLE_SCHEMA,
                   sep: str = PEOPLE_SEPARATOR, on_bad: str = ON_BAD_FAIL) -> ScanResult:
    """Scan text files at ``path`` into typed columns."""
    return parse_lines(spark.read.text(path), schema, sep, on_bad)
