"""SimHash near-duplicates with pivot distance tables (operator 10).

Fingerprint: A-Z lower-cased, words of ``[^\\x20\\x09-\\x0D]+``, shingles of ``size`` words joined
by one space (repeats kept; fewer words: the whole sequence). Bit i is 1 if bit i is set in over
half of the shingles' XXH64 values (UTF-8, seed 42). No word: fingerprint zero.

Links between fingerprints of at most ``bits`` differing bits:

1. equal fingerprints collapse to one row (a map-side aggregation, so thousands of copies cost nothing);
2. two fingerprints that differ in at most ``bits`` bits agree on one of ``bits + 1`` slices of the
   64 bits, so rows meet under the key (slice, value); a key with more than ``BLOCK`` rows is cut in
   blocks and every pair of blocks is a group of its own, so no group outgrows ``2 * BLOCK`` rows;
3. in a group, a table of the Hamming distances to ``PIVOTS`` reference fingerprints is computed once
   per row; a pair whose largest coordinate difference exceeds ``bits`` cannot be a link (triangle
   inequality) and is dropped; survivors are verified by XOR and a bit count;
4. a group gives its links as a spanning forest, the forests go to the connected components.

The references are fixed pseudo-random 64-bit words: any words give exact results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.llm.components import components, forest
from pressroom.llm.names import unused
from pressroom.llm.scratch import Scratch

BLOCK = 512
PIVOTS = 16


def fingerprint(text: str | None, size: int, seed: int = 42) -> int:
    words = (text or "").encode().lower().split()          # bytes.lower(): A-Z only; split(): \x20 \x09-\x0D
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = [0, *(ends[:n - 1] + 1).tolist()]
    last = ends[-n:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[s:e], seed) for s, e in zip(first, last)), np.uint64, n)
    # bit counts: 255 rows of 0/1 bytes at a time add up inside the bytes of a uint64
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    bits = np.concatenate([bits, np.zeros((-n % 255, 64), np.uint8)]).view(np.uint64).reshape(-1, 255, 8)
    ones = bits.sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """docs' columns without text, and fp (long: the 64 bits as a signed number)."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), size)) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), pa.array(fps, pa.int64())],
                                             names=[*others, "fp"])

    schema = docs.select(*others).withColumn("fp", F.lit(0).cast("long")).schema
    return docs.select(*others, "text").mapInArrow(run, schema)


def _references(n: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(f"reference {i}") for i in range(n)), np.uint64, n)


def block_links(left: np.ndarray, right: np.ndarray | None, bits: int, pivots: np.ndarray) -> tuple:
    """Index pairs of two blocks (right None: inside one) within ``bits``, by the pivot tables."""
    a, b = left, left if right is None else right
    ta = np.bitwise_count(a[:, None] ^ pivots).astype(np.int8)
    tb = np.bitwise_count(b[:, None] ^ pivots).astype(np.int8)
    near = np.abs(ta[:, None, 0] - tb[None, :, 0]) <= bits
    if right is None:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    for p in range(1, len(pivots)):
        if len(i) < 256:
            break                                         # few survivors: verifying them is cheaper
        on = np.abs(ta[i, p] - tb[j, p]) <= bits
        i, j = i[on], j[on]
    on = np.bitwise_count(a[i] ^ b[j]) <= bits
    return i[on], j[on]


def fingerprint_links(fps: DataFrame, bits: int, scratch: Scratch, block: int = BLOCK,
                      pivots: int = PIVOTS) -> DataFrame:
    """(a, b) links between the distinct values of ``fps.fp``: each group's spanning forest."""
    n = bits + 1
    cut = [64 * k // n for k in range(n + 1)]
    keys = F.array(*(F.struct(F.lit(k).cast("tinyint").alias("k"),
                              F.shiftrightunsigned("fp", cut[k]).bitwiseAND((1 << (cut[k + 1] - cut[k])) - 1).alias("v"))
                     for k in range(n)))
    rows = fps.select("fp", F.explode(keys).alias("s")).select("fp", "s.k", "s.v")
    sizes = scratch.save(rows.groupBy("k", "v").count().filter("count > 1")
                         .select("k", "v", F.ceil(F.col("count") / block).cast("int").alias("n")))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                       lambda x: F.struct(F.least(x, F.col("own")).alias("x"), F.greatest(x, F.col("own")).alias("y")))
    groups = (rows.join(sizes, ["k", "v"]).withColumn("own", own)
              .select("k", "v", "own", "fp", F.explode(pair).alias("p"))
              .groupBy("k", "v", "p.x", "p.y")
              .agg(F.collect_list(F.when(F.col("own") == F.col("p.x"), F.col("fp"))).alias("l"),
                   F.collect_list(F.when((F.col("own") == F.col("p.y")) & (F.col("p.x") != F.col("p.y")),
                                         F.col("fp"))).alias("r"))
              .select("l", "r", (F.col("x") == F.col("y")).alias("one")))
    refs = _references(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_a, out_b = [], []
            for left, right, one in zip(b.column("l"), b.column("r"), b.column("one").to_pylist()):
                x = left.values.to_numpy(zero_copy_only=False)
                y = None if one else right.values.to_numpy(zero_copy_only=False)
                if len(x) + (0 if y is None else len(y)) < 2:
                    continue
                i, j = block_links(x.view(np.uint64), None if y is None else y.view(np.uint64), bits, refs)
                if not len(i):
                    continue
                nodes = x if y is None else np.concatenate([x, y])
                root = forest(len(nodes), i, j if y is None else j + len(x))
                on = root != np.arange(len(nodes))
                out_a.append(nodes[on])
                out_b.append(nodes[root[on]])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))],
                                                 names=["a", "b"])

    return groups.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, size: int = 4, bits: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``docs``: doc_id (long) and text; other columns are ignored. component_id is the smallest
    doc_id that links reach, the document itself included. Null and empty texts have fingerprint
    zero and link like any other. A null doc_id is returned as null and is in its group; a group
    of null ids only has a null component. Repeated rows each give a row. No rows: an empty table.
    """
    rows = _grouped(docs.select("doc_id", "text"), size, bits)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """The columns of docs but text, fp and component_id."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.save(fingerprints(docs, size))
    classes = scratch.save(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    links = scratch.save(fingerprint_links(classes.select("fp"), bits, scratch))
    roots = components(links, scratch)
    rooted = scratch.save(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                          .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    ids = scratch.save(rooted.groupBy("root").agg(F.min("rep").alias("component_id")))
    by_fp = scratch.save(rooted.join(ids, "root").select("fp", "component_id"))
    scratch.drop(classes, links, rooted, ids)
    return fps.join(by_fp, "fp")


def keep_first(docs: DataFrame, size: int = 4, bits: int = 4) -> DataFrame:
    """docs without the near-duplicates: of each group the document with the smallest doc_id stays.

    All columns and their order stay. Of several rows with a group's smallest doc_id the one with the
    smallest hash of its values stays; a null doc_id is in no position to be chosen, such rows all stay.
    """
    row, = unused(docs, "_row")
    values = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)))
    marked = docs.withColumn(row, values)
    groups = _grouped(marked.select("doc_id", F.col(row).alias("row"), "text"), size, bits)
    kept = (groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.min("row").alias(row)))
    # rows that agree in both are equal
    first = marked.join(kept, ["doc_id", row], "left_semi").dropDuplicates(["doc_id", row])
    return first.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
