"""Embedding near-duplicates by an epsilon grid order join (operator 4).

Two vectors with the same label link when their cosine is at least ``cosine``, that is, when the
unit vectors are at most eps = sqrt(2 - 2 * cosine) apart. A projection on principal dimensions
never lengthens a distance, so

1. equal vectors of a label become one class (aggregated before the shuffle) with its size;
2. the classes are projected on the ``DIMS`` leading principal dimensions (second moments summed in
   Spark; one d x d matrix per vector length reaches the driver), laid on a grid of cells of side
   eps, sorted by (label, cells) and cut in blocks of ``BLOCK`` classes;
3. block pairs meet by label and first grid cell (equal or adjacent) and only if their boxes in the
   projected space are within eps;
4. a block pair is one row of work: its two sequence intervals are halved recursively, interval
   pairs with distant boxes are skipped, small ones are compared in double precision;
5. links go out as a spanning forest and as link counts per class, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.components import components, forest
from pressroom.llm.scratch import Scratch

COSINE = 0.98
DIMS = 6
BLOCK = 512
LEAF = 64


def _units(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)               # keeps the squares of huge and tiny vectors finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = b.column("dim").to_numpy(zero_copy_only=False)
    for d in np.unique(dims):
        yield int(d), b.filter(pa.array(dims == d))


def _moments(classes: DataFrame) -> dict[int, np.ndarray]:
    """Second moments of the unit vectors, per vector length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, part in _by_length(b):
                u = _units(_matrix(part.column("embedding"), d))
                sums[d] = sums.get(d, 0) + u.T @ u
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d)),
                                              pa.array(s.ravel())], names=["dim", "i", "v"])

    rows = (classes.select("dim", "embedding").mapInArrow(run, "dim int, i long, v double")
            .groupBy("dim", "i").agg(F.sum("v").alias("v")).toPandas().sort_values(["dim", "i"]))
    return {int(d): g["v"].to_numpy().reshape(int(d), int(d)) for d, g in rows.groupby("dim")}


def _axes(moment: np.ndarray) -> np.ndarray:
    """The leading eigenvectors as columns, padded with zero columns to DIMS."""
    values, vectors = np.linalg.eigh(moment)
    lead = vectors[:, np.argsort(-values)][:, :DIMS]
    return np.pad(lead, ((0, 0), (0, DIMS - lead.shape[1])))


def _placed(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """classes with their projected coordinates and grid cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, part in _by_length(b):
                at = _units(_matrix(part.column("embedding"), d)) @ axes[d]
                cells = np.floor(at / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names),
                     pa.array(list(at), pa.list_(pa.float64())), pa.array(list(cells), pa.list_(pa.int32()))],
                    names=[*part.schema.names, "at", "cells"])

    schema = classes.withColumns({"at": F.array().cast("array<double>"), "cells": F.array().cast("array<int>")}).schema
    return classes.mapInArrow(run, schema)


def _blocks(ordered: DataFrame) -> DataFrame:
    """Runs of at most BLOCK rows with the same label and length, in grid order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cut(t: pa.Table, last: bool) -> tuple[list, pa.Table]:
            keys = np.stack([t["label"].to_numpy(), t["dim"].to_numpy()], axis=1).astype(np.int64)
            edges = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, [len(keys)]])
            out, rest = [], len(keys)
            for s, e in zip(edges[:-1], edges[1:]):
                for lo in range(s, e, BLOCK):
                    hi = min(lo + BLOCK, e)
                    if hi == len(keys) and not last and hi - lo < BLOCK:
                        rest = lo
                        break
                    out.append(block(t.slice(lo, hi - lo)))
            return out, t.slice(rest)

        def block(t: pa.Table) -> dict:
            d, t = t["dim"][0].as_py(), t.combine_chunks()
            at = np.array(t["at"].to_pylist())
            raw = _matrix(t["embedding"].combine_chunks() if isinstance(t["embedding"], pa.ChunkedArray) else t["embedding"], d)
            return {"label": t["label"][0].as_py(), "dim": d, "lo": at.min(axis=0).tolist(), "hi": at.max(axis=0).tolist(),
                    "cid": t["cid"].to_numpy().astype("<i8").tobytes(), "n": t["n"].to_numpy().astype("<i8").tobytes(),
                    "vectors": raw.astype("<f4").tobytes(), "at": at.astype("<f8").tobytes()}

        def rows(found: list) -> Iterator[pa.RecordBatch]:
            for r in found:
                yield pa.RecordBatch.from_pylist([r], _BLOCK_ARROW)

        for b in batches:
            t = pa.Table.from_batches([b])
            done, held = cut(pa.concat_tables([held, t]) if held is not None else t, last=False)
            yield from rows(done)
        if held is not None and len(held):
            yield from rows(cut(held, last=True)[0])

    return ordered.mapInArrow(run, "label int, dim int, lo array<double>, hi array<double>, cid binary, n binary, "
                                   "vectors binary, at binary")


_BLOCK_ARROW = pa.schema([("label", pa.int32()), ("dim", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                          ("cid", pa.binary()), ("n", pa.binary()), ("vectors", pa.binary()), ("at", pa.binary())])


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b) ids of block pairs, a <= b, whose boxes are within eps."""
    s = blocks.select("bid", "label", "dim", "lo", "hi", F.floor(F.col("lo")[0] / eps).alias("c"),
                      F.floor(F.col("hi")[0] / eps).alias("e"))
    left = s.select(F.col("bid").alias("a"), "label", "dim", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"),
                    F.col("c").alias("a_c"), F.explode(F.sequence("c", "e")).alias("cell"))
    right = s.select(F.col("bid").alias("b"), "label", "dim", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"),
                     (F.col("c") - 1).alias("b_c"), F.explode(F.sequence(F.col("c") - 1, F.col("e") + 1)).alias("cell"))
    gaps = F.transform(F.arrays_zip("a_lo", "a_hi", "b_lo", "b_hi"),
                       lambda x: F.greatest(x["a_lo"] - x["b_hi"], x["b_lo"] - x["a_hi"], F.lit(0.0)))
    square = F.aggregate(gaps, F.lit(0.0), lambda t, g: t + g * g)
    return (left.join(right, ["label", "dim", "cell"])
            # one meeting cell per pair: the first that both sides have
            .filter((F.col("a") <= F.col("b")) & (F.col("cell") == F.greatest("a_c", "b_c")) & (square <= eps * eps))
            .select("a", "b"))


def _far(x: np.ndarray, y: np.ndarray, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
    return float(gap @ gap) > eps * eps


def interval_links(u: np.ndarray, v: np.ndarray, x: np.ndarray, y: np.ndarray, cosine: float, eps: float,
                   same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of linked rows of two sequence intervals: u, v unit vectors, x, y coordinates.

    ``same``: both are one interval; pairs come with i < j.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(u), 0, len(v))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (same and d <= a + 1) or _far(x[a:b], y[c:d], eps):
            continue
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(u[a:b] @ v[c:d].T >= cosine)
            i, j = i + a, j + c
            on = i < j if same else slice(None)
            out.append((i[on], j[on]))
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def _pair_links(work: DataFrame, cosine: float, eps: float) -> DataFrame:
    """(kind, x, y): kind 0 a link x - y, kind 1 that class x has y more linked vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                same = r["a"] == r["b"]
                side = []
                for s in "ab":
                    cid, n = np.frombuffer(r[f"{s}_cid"], "<i8"), np.frombuffer(r[f"{s}_n"], "<i8")
                    raw = np.frombuffer(r[f"{s}_vectors"], "<f4").reshape(len(cid), -1)
                    side.append((cid, n, _units(raw), np.frombuffer(r[f"{s}_at"], "<f8").reshape(len(cid), -1)))
                (ca, na, ua, xa), (cb, nb, ub, xb) = side
                i, j = interval_links(ua, ub, xa, xb, cosine, eps, same)
                if not len(i):
                    continue
                more_a, more_b = np.bincount(i, nb[j], len(ca)), np.bincount(j, na[i], len(cb))
                cid = ca if same else np.concatenate([ca, cb])
                more = more_a + more_b if same else np.concatenate([more_a, more_b])
                root = forest(len(cid), i, j if same else j + len(ca))
                on, got = root != np.arange(len(cid)), more > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.zeros(on.sum(), np.int32), np.ones(got.sum(), np.int32)])),
                     pa.array(np.concatenate([cid[on], cid[got]])),
                     pa.array(np.concatenate([cid[root[on]], more[got].astype(np.int64)]))], names=["kind", "x", "y"])

    return work.mapInArrow(run, "kind int, x long, y long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors``: vec_id (long), embedding (array<float>), label (int); other columns are ignored.
    Vectors that are null, empty or zero, hold null or non-finite components, or have no label link
    with nothing: n_links 0, component_id their own id, kept. Vectors of different lengths don't
    link. Repeated rows are vectors of their own. A null vec_id links like any other; a component
    of null ids only has a null component_id and is kept.
    """
    spark, scratch, eps = vectors.sparkSession, Scratch(vectors.sparkSession, "embed"), float(np.sqrt(2 - 2 * cosine)) + 1e-9
    v = F.col("embedding")
    fine = (F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    keyed = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).select(
        "vec_id", "label", "embedding", "fine", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2"))
    classes = scratch.save(keyed.filter("fine").groupBy("label", "h1", "h2")
                           .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
                           .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")))
    axes = {d: _axes(m) for d, m in _moments(classes).items()}
    placed = _placed(classes.select("label", "dim", "cid", "n", "embedding"), axes, eps)
    grid = ["label", "dim", *(F.col("cells")[i] for i in range(DIMS)), "cid"]
    blocks = scratch.save(_blocks(placed.repartitionByRange(*grid).sortWithinPartitions(*grid))
                          .withColumn("bid", F.monotonically_increasing_id()))
    pairs = _block_pairs(blocks, eps)
    payload = ["cid", "n", "vectors", "at"]
    work = (pairs.join(blocks.select(F.col("bid").alias("a"), *(F.col(c).alias(f"a_{c}") for c in payload)), "a")
            .join(blocks.select(F.col("bid").alias("b"), *(F.col(c).alias(f"b_{c}") for c in payload)), "b"))
    found = scratch.save(_pair_links(work, cosine, eps))
    roots = components(found.filter("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")), scratch)
    more = found.filter("kind = 1").groupBy(F.col("x").alias("cid")).agg(F.sum("y").alias("more"))
    rooted = scratch.save(classes.select("cid", "label", "h1", "h2", "rep", "n")
                          .join(roots.withColumnRenamed("node", "cid"), "cid", "left").join(more, "cid", "left")
                          .select("label", "h1", "h2", "rep", F.coalesce("root", "cid").alias("root"),
                                  (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("links")))
    least = scratch.save(rooted.groupBy("root").agg(F.min("rep").alias("least")))
    by_vector = scratch.save(rooted.join(least, "root").select(F.lit(True).alias("fine"), "label", "h1", "h2", "links", "least"))
    scratch.drop(classes, blocks, found, rooted, least)
    return (keyed.select("vec_id", "fine", "label", "h1", "h2").join(by_vector, ["fine", "label", "h1", "h2"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("fine"), F.col("least")).otherwise(F.col("vec_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
