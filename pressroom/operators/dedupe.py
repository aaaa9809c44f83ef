"""Distinct, first-seen, latest-version and merge operators (AGG1-AGG4, AGG7, WIN1-WIN4).

"Pick one row per key" is written as an aggregation, not as a window:
``groupBy(key).agg(min_by/max_by(row, order))``.  The aggregate runs a partial
(map-side) step first, so a key that holds a third of all rows is reduced to one
row per map task before the shuffle, instead of being sorted in one task as a
``row_number`` window would do.  Ties are broken by explicit columns so results
do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def pick_per_key(df: DataFrame, keys, order: Sequence, how: str = "first") -> DataFrame:
    """One row per ``keys``: the smallest (``how='first'``) or largest (``'last'``) ``order``.

    ``order`` is a list of column names / Columns compared left to right; add a
    unique tie-break column last.  Nulls in the order sort lowest (so 'last'
    means "descending, nulls last").  Output keeps ``df``'s columns and order.
    """
    keys = _names(keys)
    payload = [c for c in df.columns if c not in keys]
    ord_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ord_struct = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(ord_cols)])
    row = F.struct(*[F.col(f"`{c}`") for c in payload]) if payload else F.lit(1)
    agg = F.min_by(row, ord_struct) if how == "first" else F.max_by(row, ord_struct)
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(agg.alias("_w"))
    return out.select(*[F.col(f"`{c}`") if c in keys else F.col("_w").getField(c).alias(c)
                        for c in df.columns])


def full_order(df: DataFrame, first: Sequence[str], exclude: Sequence[str] = ()) -> list:
    """``first`` then every other orderable column (sorted by name) as the tie-break, so the
    row picked for a key depends only on the data, never on arrival order."""
    from pyspark.sql import types as T

    def orderable(dt):
        if isinstance(dt, (T.MapType, T.VariantType)):
            return False
        if isinstance(dt, T.ArrayType):
            return orderable(dt.elementType)
        if isinstance(dt, T.StructType):
            return all(orderable(f.dataType) for f in dt.fields)
        return True
    rest = sorted(f.name for f in df.schema.fields
                  if f.name not in first and f.name not in exclude and orderable(f.dataType))
    return [*first, *[F.col(f"`{c}`") for c in rest]]


def first_seen(df: DataFrame, key, order: Sequence) -> DataFrame:
    """AGG2: the first row per key in discovery order (ordinal columns, ascending)."""
    return pick_per_key(df, key, order, how="first")


def latest_by(df: DataFrame, keys, order: Sequence) -> DataFrame:
    """WIN1/WIN2: the latest row per key by ``order`` descending (nulls last)."""
    return pick_per_key(df, keys, order, how="last")


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG1: whole-row distinct (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AGG3: the unordered set of values of one column."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def ci_distinct(arr) -> Column:
    """AGG4: case-insensitive distinct inside an array, first spelling kept, order kept."""
    from ..functions.authors import ci_distinct as _ci
    return _ci(F.col(arr) if isinstance(arr, str) else arr)


def distinct_authors(*arrays) -> Column:
    """AGG7: distinct author names over several list columns of a row, sorted."""
    cols = [F.coalesce(F.col(a) if isinstance(a, str) else a, F.array().cast("array<string>"))
            for a in arrays]
    merged = F.flatten(F.array(*cols))
    return F.array_sort(F.array_distinct(F.filter(merged, lambda x: x.isNotNull() & (x != ""))))


def merge_latest(new: DataFrame, old: DataFrame | None, keys, order: Sequence) -> DataFrame:
    """WIN3 core: history ∪ new (by name), then the latest row per key."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return latest_by(both, keys, order)


def merge_distinct(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """WIN4 core: history ∪ new (by name), whole-row distinct."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return both.dropDuplicates()
