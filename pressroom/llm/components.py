"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round rewires every node to the smallest node it has seen until all components are
stars. A round is two aggregations and two joins over the links; nothing is collected. The
per-node minima are written before they are joined, so both join sides come from an
exchange and a node with very many links is split by the skew join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.scratch import Scratch


def _star(edges: DataFrame, scratch: Scratch, large: bool) -> DataFrame:
    """One star operation: (a, b) pairs with b < a."""
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    mins = scratch.save(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
    joined = both.join(mins, "a")
    if large:
        pairs = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        pairs = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(mins.select("a", F.col("m").alias("b"))))
    out = scratch.save(pairs.filter("a <> b").distinct())
    scratch.drop(mins)
    return out


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node long, root long) of every node that has a link; root is the smallest node of its component.

    ``links``: two long columns ``a`` and ``b``, any direction, repeats allowed. Null ends and
    links from a node to itself are ignored; without links the result is empty.
    """
    edges = scratch.save(links.filter("a <> b")
                         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        big = _star(edges, scratch, large=True)
        small = _star(big, scratch, large=False)
        scratch.drop(edges, big)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indexes by the given links (inside one task)."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        open_ = root[left] != root[right]
        left, right = left[open_], right[open_]
    return root
