"""Exact top-k search in binary codes by incremental multi-index hashing (operator 6).

A code of ``bits`` bits is cut in ``m`` segments. Two codes that differ in at most
``m * (r + 1) - 1`` bits differ in at most r bits on one of the segments. The search therefore
grows the segment radius r = 0, 1, 2, ...: every open query probes, in each segment, all values at
exactly r bits from its own, verifies the full distance of what it meets and keeps its k best. A
query closes when its k-th distance is at most ``m * (r + 1) - 1``: no code it hasn't met can be nearer.

Equal codes are one index entry: for a top k by (distance, id) the k smallest ids of a code are
all that can appear, so a code that very many rows share costs k rows. Equal queries are one query.
Segments have at most log2(number of codes) bits, so a bucket holds a few codes at every size. What a
query meets beyond its k-th distance so far is discarded in the join.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressroom.llm.scratch import Scratch

K = 10
BITS = 64


def sign_code(vector: str, bits: int = BITS) -> Column:
    """The signs of the first ``bits`` components as a long: bit i is 1 if component i is above 0.

    Null for a null vector, one with fewer components, or one with null or non-finite components.
    """
    v = F.col(vector)
    one = [F.when(F.get(v, F.lit(i)) > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
           for i in range(bits)]
    code = one[0]
    for x in one[1:]:
        code = code.bitwiseOR(x)
    fine = (F.size(v) >= bits) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(fine, code)


def _cuts(bits: int, m: int) -> list[tuple[int, int]]:
    edges = [bits * j // m for j in range(m + 1)]
    return [(edges[j], edges[j + 1] - edges[j]) for j in range(m)]


def _segments(code: str, cuts: list[tuple[int, int]]) -> Column:
    return F.array(*(F.struct(F.lit(j).alias("seg"),
                              F.shiftrightunsigned(code, lo).bitwiseAND((1 << n) - 1).alias("val"))
                     for j, (lo, n) in enumerate(cuts)))


def _masks(cuts: list[tuple[int, int]], r: int) -> list[tuple[int, int]]:
    """(segment, value with r of its bits set) for every segment."""
    return [(j, sum(1 << i for i in c)) for j, (_, n) in enumerate(cuts) for c in combinations(range(n), r)]


def _first_meeting(r: int, cuts: list[tuple[int, int]]) -> Column:
    """Whether the pair (q, code) meets here for the first time: r is its smallest segment distance,
    and no earlier segment has it. Each pair is met once in the whole search."""
    diff = F.col("q").bitwiseXOR(F.col("code"))
    gaps = [F.bit_count(F.shiftrightunsigned(diff, lo).bitwiseAND((1 << n) - 1)) for lo, n in cuts]
    on = F.lit(True)
    for j, gap in enumerate(gaps):
        on = on & F.when(F.col("seg") > j, gap > r).otherwise(gap >= r)
    return on


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """(query_id, rank, id, distance): the k rows of ``codes`` nearest to each query, by (distance, id).

    ``codes``: id (long) and code (long); ``queries``: query_id and code. Null codes and ids are left
    out; a query finds itself if it is among the codes. With fewer than k codes all are returned.
    Repeated rows count as one, repeated queries give one set of rows.
    """
    spark, scratch = codes.sparkSession, Scratch(codes.sparkSession, "topk")
    rows = codes.filter("id is not null and code is not null").select("id", "code").distinct()
    ids = scratch.save(rows.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id")))
                       .filter(F.col("n") <= k).drop("n"))
    asked = scratch.save(queries.filter("code is not null").select("query_id", "code").distinct())
    index = scratch.save(ids.groupBy("code").agg(F.count("*").cast("int").alias("members"), F.min("id").alias("first")))
    m = max(1, min(bits, math.ceil(bits / math.log2(max(2, index.count())))))
    cuts = _cuts(bits, m)
    buckets = scratch.save(index.select("code", "members", "first", F.explode(_segments("code", cuts)).alias("s"))
                           .select("s.seg", "s.val", "code", "members", "first"))
    # bound: no code beyond this distance can still be among the k nearest
    open_ = scratch.save(asked.select(F.col("code").alias("q"), F.lit(bits).alias("bound")).distinct())
    # best: the k nearest codes so far of each open query. By (distance, smallest id) a code behind
    # k others has no id among the k nearest, as each of the others has one before it.
    best, finished = None, []
    order = Window.partitionBy("q").orderBy("d", "first")
    for r in range(max(n for _, n in cuts) + 1):
        masks = spark.createDataFrame(_masks(cuts, r), "seg int, mask long")
        own = open_.select("q", "bound", F.explode(_segments("q", cuts)).alias("s")).select("q", "bound", "s.seg", "s.val")
        # the masks are a fixed list: binomial(segment bits, r) per segment
        probes = (own.join(F.broadcast(masks), "seg")
                  .select("q", "bound", F.col("seg").alias("seg"), F.col("val").bitwiseXOR(F.col("mask")).alias("val")))
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        new = (probes.join(buckets, ["seg", "val"]).filter((distance <= F.col("bound")) & _first_meeting(r, cuts))
               .select("q", "code", "members", "first", distance.alias("d")))
        met = scratch.save((new if best is None else best.unionByName(new))
                           .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n"))
        near = F.sum(F.when(F.col("d") <= m * (r + 1) - 1, F.col("members")).otherwise(0))
        far = F.when(F.count("*") >= k, F.max("d")).otherwise(bits)
        now = scratch.save(met.groupBy("q").agg((near >= k).alias("done"), far.alias("far")))
        closed = now.filter("done").select("q")
        finished.append(scratch.save(met.join(closed, "q", "left_semi")))
        after = scratch.save(open_.join(now, "q", "left").filter("done is null or not done")
                             .select("q", F.coalesce("far", "bound").alias("bound")))
        if best is not None:
            scratch.drop(best)
        best = scratch.save(met.join(closed, "q", "left_anti"))
        scratch.drop(open_, met, now)
        open_ = after
        if not open_.head(1):
            break
    found = best                                            # left over: all codes were met, fewer than k rows exist
    for f in finished:
        found = found.unionByName(f)
    hits = (asked.join(found.select("q", F.col("code").alias("c"), "d"), F.col("code") == F.col("q")).drop("code")
            .join(ids, F.col("c") == F.col("code")))
    last = Window.partitionBy("query_id").orderBy("d", "id")
    return (hits.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", F.col("d").cast("int").alias("distance")))
