"""Row-level column expressions (filters, maps, keys, templates).

All of these return ``Column`` objects built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen and Catalyst can push filters and
prune columns through them. None of them runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import NULL_TEXT

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P1: closed-range filter -------------------------------------------------

def in_range(c: ColumnOrName, lo, hi) -> Column:
    """``lo <= c <= hi``; a null ``c`` is not kept (the predicate is null).

    Written as two comparisons so the parquet reader receives both as
    pushed filters (``GreaterThanOrEqual`` / ``LessThanOrEqual``).
    """
    c = _col(c)
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


# --- P3: row to string map ----------------------------------------------------

def to_string_map(*cols: str) -> Column:
    """``map(name -> value as text, ...)`` for the given columns, in order."""
    pairs: list[Column] = []
    for name in cols:
        pairs += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*pairs)


# --- P4: IEEE double addition -----------------------------------------------

def add_doubles(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Binary double addition (``0.09 + 0.01 = 0.09999999999999999``).

    Both sides are cast to double first: a SQL literal ``0.09`` is a decimal
    in Spark and would sum exactly.
    """
    return _col(a).cast("double") + _col(b).cast("double")


# --- P5 / P6: JSON events ----------------------------------------------------

def to_json_event(cols: Sequence[str] | None = None, keep_nulls: bool = True) -> Column:
    """All (or the named) columns of a row as one JSON object text.

    Null fields are written as ``null`` rather than dropped, so an absent
    value and a null value stay distinguishable downstream only when the
    caller asks for it (``keep_nulls=False`` reproduces Spark's default). A
    column that is named twice is written once. For a frame in which several
    columns have the same name, use ``json_events``.
    """
    target = F.struct(*dict.fromkeys(cols)) if cols else F.struct("*")
    opts = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(target, opts)


def json_events(df: DataFrame, body_col: str = "body", keep_nulls: bool = True) -> DataFrame:
    """The rows of ``df`` as JSON events. Of columns that share a name, as after a
    join, the last one is the event's field."""
    last = {name: i for i, name in enumerate(df.columns)}
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    target = F.struct(*[F.col(f"c{i}").alias(name) for name, i in last.items()])
    return by_place.select(F.to_json(target, {"ignoreNullFields": "false" if keep_nulls else "true"}).alias(body_col))


def parse_event(body: ColumnOrName, schema=None) -> Column:
    """JSON object text -> ``map<string,string>`` (or the given struct).

    Numbers are re-rendered (``1.50`` -> ``1.5``), nested values keep their
    JSON text, and text that is not a JSON object gives null.
    """
    return F.from_json(_col(body), schema or "map<string,string>")


def is_nonempty(body: ColumnOrName) -> Column:
    """True when the body is neither null nor zero-length."""
    b = _col(body)
    return b.isNotNull() & (F.length(b) > 0)


FLAT_OBJECT = r"^\s*\{[^{}]*\}\s*$"      # its braces are the first and the last, so nothing follows them


def is_one_object(body: ColumnOrName) -> Column:
    """True when the whole text is one JSON object: the parser itself stops after
    the first value. A text with further braces is parsed as the first item of an
    array whose second item is the text's own hash: both must come back."""
    body = _col(body)
    own = F.xxhash64(body).cast("string")
    items = F.from_json(F.concat(F.lit("["), body, F.lit(","), own, F.lit("]")), "array<string>")
    whole = (F.size(items) == 2) & (F.get(items, F.lit(1)) == own)
    return F.when(body.rlike(FLAT_OBJECT), F.lit(True)).otherwise(
        body.rlike(r"^\s*\{") & F.coalesce(whole, F.lit(False)))


def strict_event(body: ColumnOrName, schema=None, required: Sequence[str] = ()) -> Column:
    """The decoded event, or null where the body is not exactly one JSON object, a
    field does not have its type in ``schema``, or a ``required`` field is null.

    With a struct schema the parser itself keeps the text of a malformed record
    in a column of its own, whose name no field has.
    """
    body = _col(body)
    ok = is_one_object(body)
    if schema is None:
        event = parse_event(body)
        ok = ok & event.isNotNull()
    else:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        malformed = "_malformed"
        while malformed in fields.names:
            malformed += "_"
        marked = T.StructType([*fields.fields, T.StructField(malformed, T.StringType())])
        parsed = F.from_json(body, marked, {"columnNameOfCorruptRecord": malformed})
        ok = ok & parsed[malformed].isNull()
        event = parsed.dropFields(malformed)
    for name in required:
        ok = ok & event.getItem(name).isNotNull()
    return F.when(ok, event)


# --- P8 / P9: named fields to positional parameters ---------------------------

def split_param_names(param_names: str) -> list[str]:
    """Comma-separated names in bind order; no trimming; empty -> none."""
    if param_names is None or param_names == "":
        return []
    return param_names.split(",")


def bind_params(event: ColumnOrName, names: Iterable[str], as_text: bool = False,
                prefix: str = "p", reverse_field: str | None = None,
                on_null_key: str = "fail") -> list[Column]:
    """One output column per parameter name, in bind order.

    ``event`` is a decoded event: a map (lookup by key) or a struct (field
    access). Absent fields give null; with ``as_text`` every value is
    rendered as text and null becomes the text ``null``. In the text form a
    parameter named ``reverse_field`` (the row key) is bound reversed, with
    ``reverse_key``'s null policy.
    """
    ev = _col(event)
    out = []
    for i, name in enumerate(names, start=1):
        v = ev.getItem(name)
        if as_text and name == reverse_field:
            v = reverse_key(v, on_null_key)
        elif as_text:
            v = F.coalesce(v.cast("string"), F.lit(NULL_TEXT))
        out.append(v.alias(f"{prefix}{i}"))
    return out


# --- P10: reversed row key ----------------------------------------------------

NULL_KEY_FAIL = "fail"
NULL_KEY_LITERAL = "literal"


def reverse_key(key: ColumnOrName, on_null: str = NULL_KEY_FAIL) -> Column:
    """Text of the key reversed character by character.

    ``reverse`` works on characters, so surrogate pairs stay whole. A null
    key fails the task by default; ``on_null='literal'`` keys it as the
    reversed text ``null`` (``llun``), which makes all such rows collide.
    """
    k = _col(key).cast("string")
    if on_null == NULL_KEY_LITERAL:
        return F.reverse(F.coalesce(k, F.lit(NULL_TEXT)))
    if on_null != NULL_KEY_FAIL:
        raise ValueError(f"on_null must be '{NULL_KEY_FAIL}' or '{NULL_KEY_LITERAL}'")
    return F.when(k.isNull(), F.raise_error(F.lit("row key is null"))).otherwise(F.reverse(k))


# --- P12 / P13: templating ------------------------------------------------------

def text_equals(left: ColumnOrName, right) -> Column:
    """Equality after rendering both sides as text (``2 == "2"`` is true)."""
    r = right if isinstance(right, Column) else F.lit(right)
    return _col(left).cast("string") == r.cast("string")


def quiet(c: ColumnOrName) -> Column:
    """A quiet reference: the value as text, or nothing when null."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def render_template(parts: Sequence[str | Column]) -> Column:
    """Concatenate literal text and quiet column references, in order."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else quiet(p) for p in parts])
