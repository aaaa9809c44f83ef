"""Per-source caps and ordering (LIM1-LIM7).

Caps are ``row_number() <= n`` over a window.  With a literal ``n`` Spark plans a
``WindowGroupLimit`` below the shuffle: every map task keeps at most ``n`` rows
per group before exchanging data, so a hot source costs ``n`` rows per task,
not a third of the table in one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def cap_per(df: DataFrame, part, n: int | None, order: Sequence, rank_col: str | None = None) -> DataFrame:
    """LIM1/LIM5: the first ``n`` rows per ``part`` in ``order`` (ascending; add a tie-break).

    Without a cap (``n`` None) every row stays, and its rank, which would sort a whole part in one
    task, is null."""
    if n is None:
        return df.withColumn(rank_col, F.lit(None).cast("bigint")) if rank_col else df
    w = Window.partitionBy(*_cols(part)).orderBy(*_cols(order))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= F.lit(int(n)))
    return out.withColumn(rn, F.col(rn).cast("bigint")) if rank_col else out.drop(rn)


def cap_sequential(df: DataFrame, site: str, n: int | None, feed_ord: str = "feed_ord",
                   item_ord: str = "item_ord", valid: Column | None = None,
                   rank_col: str | None = None) -> DataFrame:
    """LIM5: a quota of ``n`` consumed across ordered feeds (valid rows only)."""
    if valid is not None:
        df = df.filter(valid)
    return cap_per(df, site, n, [feed_ord, item_ord], rank_col=rank_col)


def head_of_each(df: DataFrame, ordinal: str, n: int) -> DataFrame:
    """LIM2/LIM3/LIM4: keep ordinals below ``n`` (0-based) -- a cap applied before any filter."""
    return df.filter(F.col(ordinal) < F.lit(int(n)))


def first_distinct(df: DataFrame, key: str, part, n: int | None, order: Sequence) -> DataFrame:
    """LIM6: distinct keys in first-seen order, then the first ``n`` per ``part``.

    The reference over-collects 2N from a set and cuts arbitrarily; here the
    ordinal decides, so the result is repeatable.
    """
    from .dedupe import first_seen
    parts = [part] if isinstance(part, str) else list(part)
    firsts = first_seen(df, parts + [key], order)
    return cap_per(firsts, part, n, order)


def priority_rank(is_match: Column, pos: Column) -> list[Column]:
    """LIM7: sort keys putting matches first, later matches ahead of earlier ones."""
    return [is_match.desc(), F.when(is_match, -pos).otherwise(pos)]
