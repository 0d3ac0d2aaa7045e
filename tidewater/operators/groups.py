"""Set operators and predicates over groups.

X1 ``intersect_by_name``: distinct rows present in both inputs, columns
matched by name (never by position).

X2 ``group_completeness``: a group is complete when every required member
name occurs among its members. Implemented as one aggregation whose state
is a bit mask per group (one long for each 62 names), so map-side partial aggregation collapses
any hot group to one row per task before the shuffle; no member list is
ever materialised per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Required names per long mask; a larger set takes several masks.
MASK_BITS = 62


def intersect_by_name(left: DataFrame, right: DataFrame,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` that also occur in ``right``; duplicates collapse.

    Both sides are projected to the same names in the same order, then each
    side is de-duplicated before the semi join: a key that holds a third of
    the rows is reduced map-side instead of crossing the shuffle row by row.
    Nulls compare equal, as in SQL ``INTERSECT``.
    """
    cols = list(columns) if columns else list(left.columns)
    missing = [c for c in cols if c not in right.columns]
    if missing:
        raise ValueError(f"right side lacks columns {missing}")
    # One struct key per row: never null, and struct equality treats null
    # fields as equal (INTERSECT semantics), so the distinct's hash
    # partitioning is reused by the join instead of a second shuffle.
    lhs = left.select(F.struct(*cols).alias("_k")).distinct()
    rhs = right.select(F.struct(*cols).alias("_k")).distinct()
    # Written as a semi join of the two distinct sides: ``lhs.intersect(rhs)``
    # puts a distinct above the join and Catalyst then drops the left-side
    # distinct as redundant, so the left would cross the shuffle row by row.
    return lhs.join(rhs, "_k", "left_semi").select(*[F.col(f"_k.{c}").alias(c) for c in cols])


def _member_bit(member: Column, required: Sequence[str]) -> Column:
    if not required:
        return F.lit(0).cast("long")
    pos = F.array_position(F.array(*[F.lit(r) for r in required]), member)
    one = F.lit(1).cast("long")
    return F.when(pos > 0, F.call_function("shiftleft", one, (pos - 1).cast("int"))) \
        .otherwise(F.lit(0).cast("long"))


def full_mask(n: int) -> int:
    return (1 << n) - 1


def _cols(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def group_completeness(df: DataFrame, group: str | Sequence[str], member: str,
                       required: Sequence[str]) -> DataFrame:
    """One row per group: ``(*group, complete)``; ``group`` is one column or
    several (a composite key).

    ``complete`` is true when ``set(required) <= set(members)``. An empty
    required list makes every group complete. Duplicate required names
    count once.
    """
    keys = _cols(group)
    req = list(dict.fromkeys(required))
    if not req:
        return df.groupBy(*keys).agg(F.lit(True).alias("complete"))
    return _masks(df, keys, member, req).select(*keys, is_full(len(req)).alias("complete"))


def complete_groups(df: DataFrame, group: str | Sequence[str], member: str,
                    required: Sequence[str]) -> DataFrame:
    """Only the groups that are complete (the group key columns)."""
    return group_completeness(df, group, member, required) \
        .filter(F.col("complete")).select(*_cols(group))


def member_mask(df: DataFrame, group: str, member: str, required: Sequence[str]) -> DataFrame:
    """Partial state for incremental completeness: ``(group, *mask_columns)``."""
    return _masks(df, [group], member, list(dict.fromkeys(required)))


def _masks(df: DataFrame, keys: list[str], member: str, req: list[str]) -> DataFrame:
    names = mask_columns(len(req))
    bits = [_member_bit(F.col(member), req[i * MASK_BITS:(i + 1) * MASK_BITS]).alias(n)
            for i, n in enumerate(names)]
    return df.select(*keys, *bits).groupBy(*keys).agg(*[F.bit_or(n).alias(n) for n in names])


def mask_columns(n: int) -> list[str]:
    """Names of the mask columns of ``n`` required names (at least one)."""
    return ["mask", *[f"mask{i}" for i in range(1, -(-n // MASK_BITS))]]


def is_full(n: int) -> Column:
    """All ``n`` required names are in the masks."""
    full = F.lit(True)
    for i, name in enumerate(mask_columns(n)):
        full = full & (F.col(name) == F.lit(full_mask(min(MASK_BITS, n - i * MASK_BITS))).cast("long"))
    return full
