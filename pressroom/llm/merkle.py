"""Merkle manifest of a table (operator 11): a hash tree per group, and a tree over the groups' roots.

Rows of a group ascend by key; every ``fanout`` consecutive nodes of a level (the last run may
hold fewer, even one) become one node, until one is left. Per level, lag and lead at fixed
offsets, masked by the node's slot in its run and by the run's length, bring a node its
siblings; the rows of first children hash the parents. A running ``last`` spreads the siblings
of a node over the rows beneath it, so every row holds its way up.

A group is not one window: positions are dealt in aligned blocks of ``fanout ** levels`` nodes, which
no run of the lowest ``levels`` levels crosses. A pass climbs these levels within the blocks (one
exchange, one sort, all windows over the same rows) and hands one node a block to the next pass;
the ways are put together from the top down by joins on the block. Positions come from a
range partitioning, counted per partition, so no task holds a whole group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressroom.llm.scratch import Scratch


@dataclass(frozen=True)
class Shape:
    """``fanout`` nodes become one; a pass climbs ``levels`` levels, so a block holds fanout ** levels nodes."""
    fanout: int = 2
    levels: int = 10

    @property
    def block(self) -> int:
        return self.fanout ** self.levels

_STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts' text put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """H of a row: each field is ``-`` if null, else its UTF-8 byte count, ``:`` and its value (integers in decimal)."""
    def spelt(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(*map(spelt, fields))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its way up give."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step.left, node, step.right))


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a way up, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s.left, s.right)), ""), 256)


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows (grp, key, node, ...) with ``pos`` in the group's order by key and node, and the group's count ``n``.

    Rows of equal group, key and node are interchangeable; a row number deals them over partitions.
    """
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    ranged = scratch.save(rows.repartitionByRange("grp", "key", "node", "salt").withColumn("part", F.spark_partition_id()))
    counts = scratch.save(ranged.groupBy("grp", "part").agg(F.count("*").alias("own")))
    by_part = Window.partitionBy("grp").orderBy("part")
    offsets = counts.select("grp", "part", (F.sum("own").over(by_part) - F.col("own")).alias("before"),
                            F.sum("own").over(Window.partitionBy("grp")).alias("n"))
    place = F.row_number().over(Window.partitionBy("grp", "part").orderBy("key", "node", "salt"))
    out = scratch.save(ranged.withColumn("place", place).join(offsets, ["grp", "part"])
                       .withColumn("pos", F.col("before") + F.col("place") - 1)
                       .drop("salt", "part", "place", "before", "key"))
    scratch.drop(ranged, counts)
    return out


def _climb(nodes: DataFrame, shape: Shape) -> DataFrame:
    """nodes (grp, pos, n, node, ...) with ``blk`` and the windows of a pass: ``up`` is the block's node
    on its first row, ``way_l`` the siblings (left, right) at level l on the rows of that level's nodes.

    Where the level has one node only, both sides are null: there is nothing to hash.
    """
    block, fanout = Window.partitionBy("grp", "blk").orderBy("pos"), shape.fanout
    out = nodes.withColumn("blk", F.expr(f"pos div {shape.block}")).withColumn("up", F.col("node"))
    for level in range(shape.levels):
        width = fanout ** level                             # rows between neighbouring nodes of the level
        near = {}
        for k in range(1, fanout):
            near[f"before{k}"] = F.lag("up", k * width).over(block)
            near[f"after{k}"] = F.lead("up", k * width).over(block)
        out = out.withColumns(near)
        index = F.expr(f"pos div {width}")                  # of the node in its level
        slot = index % fanout
        to_end = F.expr(f"(n + {width - 1}) div {width}") - index
        is_node, has_parent = F.col("pos") % width == 0, F.col("n") > width
        left = F.concat(*(F.when(slot >= k, F.col(f"before{k}")).otherwise("") for k in range(fanout - 1, 0, -1)))
        right = F.concat(*(F.when((slot + k < fanout) & (to_end > k), F.col(f"after{k}")).otherwise("")
                           for k in range(1, fanout)))
        nothing = F.lit(None).cast("string")
        way = F.when(is_node, F.struct(F.when(has_parent, left).otherwise(nothing).alias("left"),
                                       F.when(has_parent, right).otherwise(nothing).alias("right")))
        out = out.withColumn(f"way_{level}", way).drop(*near)
        parent = F.when(has_parent, digest(F.col("up"), F.col(f"way_{level}.right"))).otherwise(F.col("up"))
        out = out.withColumn("up", F.when(F.col("pos") % (width * fanout) == 0, parent))
    return out


def _tops(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The node of each block, as the nodes of the next pass."""
    return (_climb(nodes, shape).filter(F.col("pos") % shape.block == 0)
            .select("grp", F.col("blk").alias("pos"), F.expr(f"(n + {shape.block - 1}) div {shape.block}").alias("n"),
                    F.col("up").alias("node")))


def _ways(nodes: DataFrame, shape: Shape) -> DataFrame:
    """nodes with ``blk`` and ``way``: the siblings at the levels of this pass, for every row."""
    block = Window.partitionBy("grp", "blk").orderBy("pos")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [f"way_{level}" for level in range(shape.levels)]
    out = _climb(nodes, shape).withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in names})
    return out.withColumn("way", F.filter(F.array(*names), lambda s: s.left.isNotNull())).drop("up", *names)


def _tree(nodes: DataFrame, shape: Shape, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows with ``proof`` up to their group's root, (grp, node) of the roots) of numbered nodes."""
    most = nodes.agg(F.max("n")).first()[0] or 0            # one number: the passes that the largest group takes
    passes = [nodes]
    while most > 1:
        passes.append(scratch.save(_tops(passes[-1], shape)))
        most = -(-most // shape.block)
    roots = passes[-1].select("grp", "node")
    proofs = None
    for k in range(len(passes) - 2, -1, -1):
        rows = _ways(passes[k], shape)
        if proofs is None:
            rows = rows.withColumn("proof", F.col("way"))
        else:
            above = proofs.select("grp", F.col("pos").alias("blk"), F.col("proof").alias("above"))
            rows = rows.join(above, ["grp", "blk"]).withColumn("proof", F.concat("way", "above")).drop("above")
        rows = rows.drop("way", "blk")
        proofs = scratch.save(rows) if k else rows
    if proofs is None:
        proofs = nodes.withColumn("proof", F.array().cast(f"array<{_STEP}>"))
    return proofs, roots


def manifest(rows: DataFrame, key: str, group: str, fields: list[str], carry: dict[str, Column] | None = None,
             shape: Shape = Shape()) -> DataFrame:
    """(key, group, pos, leaf, subroot, root, proof, carried columns) of every row.

    ``leaf`` hashes the fields, ``proof`` is array<struct<left,right>>: the siblings at each level
    from the leaf over the group's ``subroot`` to ``root``. Groups ascend by the UTF-8 bytes of
    ``group``, null first. Rows of a group ascend by ``key`` (null first); of rows with equal keys the
    one with the smaller leaf comes first, equal rows stand one behind the other. A null or empty
    field is a value like others. Other columns of ``rows`` are left out, so their names can't
    clash. No rows: an empty manifest.
    """
    scratch, carry = Scratch(rows.sparkSession, "merkle"), carry or {}
    leaves = scratch.save(rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("grp"),
        F.col(f"`{key}`").alias("key"), F.col(f"`{key}`").alias("kept"),
        leaf_digest(*(F.col(f"`{f}`") for f in fields)).alias("node"),
        F.struct(F.lit(0).alias("none"), *(c.alias(name) for name, c in carry.items())).alias("carried")))
    numbered = _numbered(leaves, scratch)
    proofs, roots = _tree(numbered, shape, scratch)
    subroots = _numbered(roots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("grp").alias("sub"), "node"), scratch)
    over, top = _tree(subroots, shape, scratch)
    over = (over.join(top.select("grp", F.col("node").alias("root")), "grp")
            .select(F.col("sub").alias("grp"), F.col("node").alias("subroot"), "root", F.col("proof").alias("over")))
    return (proofs.join(over, "grp")
            .select(F.col("kept").alias(key), F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).alias(group),
                    "pos", F.col("node").alias("leaf"), "subroot", "root", F.concat("proof", "over").alias("proof"),
                    *(F.col(f"carried.`{name}`").alias(name) for name in carry)))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of docs.

    Where 7 divides crc32(decimal doc_id), ``folded_root`` starts at the leaf of the row with 1 added to
    n_chars, elsewhere (and without a doc_id) at the leaf itself; the siblings are the manifest's.
    """
    tampered = {"n_chars": F.col("n_chars") + 1}
    bad = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
                 leaf_digest(*(tampered.get(f, F.col(f)) for f in FIELDS)))
    tree = manifest(docs, "doc_id", "lang", FIELDS, carry={"bad": bad})
    folded = fold(F.coalesce("bad", "leaf"), F.col("proof"))
    return (tree.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                        folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
