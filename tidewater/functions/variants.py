"""Events without a schema: nested values of any type, taken by path.

A body is decoded to a VARIANT, which keeps objects, arrays and the types of
their values. Of fields with one name the last wins, at every level. The parser
reads a number as a value, so ``1.50`` becomes 1.5; with ``numbers="text"`` each
number becomes a text of exactly its digits instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import ColumnOrName, _col, is_one_object

DUPLICATES = "spark.sql.variant.allowDuplicateKeys"
# A JSON text or number; the mark is a control character, which no JSON text holds as such.
_TOKEN = r'("(?:[^"\\]|\\.)*+")|(-?[0-9][0-9.eE+\-]*+)'
_MARK = "\u0001"


def quote_numbers(body: ColumnOrName) -> Column:
    """The JSON text with every number as a text of the same digits."""
    b = _col(body)
    marked = F.regexp_replace(b, _TOKEN, f"$1{_MARK}$2{_MARK}")
    quoted = F.replace(F.replace(marked, F.lit(_MARK * 2), F.lit("")), F.lit(_MARK), F.lit('"'))
    return F.when(F.instr(b, _MARK) == 0, quoted).otherwise(b)


def decode_variants(df: DataFrame, body_col: str = "body", event_col: str = "event",
                    numbers: str = "value") -> DataFrame:
    """``df`` with the decoded event, null where the body is not exactly one JSON object."""
    if numbers not in ("value", "text"):
        raise ValueError("numbers must be 'value' or 'text'")
    conf = df.sparkSession.conf
    before = conf.get(DUPLICATES)
    conf.set(DUPLICATES, "true")         # the plan takes the setting when it is analysed
    try:
        text = quote_numbers(body_col) if numbers == "text" else F.col(body_col)
        return df.withColumn(event_col, F.when(is_one_object(body_col), F.try_parse_json(text)))
    finally:
        conf.set(DUPLICATES, before)


def field(event: ColumnOrName, path: str, kind: str = "string") -> Column:
    """The value at ``path`` (``$.a.b[0]``) as ``kind``; null if there is none or it
    is not of that kind."""
    return F.try_variant_get(_col(event), path, kind)
