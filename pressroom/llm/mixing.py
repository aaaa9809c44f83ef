"""Mixing sources to target weights by entropy balancing (operator 1).

Every document starts at a rate of one copy. Among the rates between 0 and ``CAP`` that give each
source its target number of words, entropy balancing takes the ones closest to the start in
relative entropy (with the upper bound, the two-sided form r log r + (CAP - r) log(CAP - r)). The
solution tilts the odds of every document exponentially in its size,

    r / (CAP - r) = exp(tilt[source] * size / mean size[source]),

and the convex dual has one variable per source. Newton steps on the dual run as Spark jobs over
(source, size, documents of that size), the sufficient statistics of the constraints; a bracket
around each root turns a step that leaves it into a bisection. Rates become copies by comparing
their fraction with a hash of the document; the cut of that comparison moves, per source, to
where the words taken come closest to the target.

DataFrame functions only. What the driver reads per step is one number, the largest residual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressroom.llm.names import unused
from pressroom.llm.scratch import Scratch

CAP = 2.0
SHARE = 1.5
WEIGHTS = (3, 1, 2)
STEPS = 60
TOLERANCE = 1e-7
BINS = 1024
FILLS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_key() -> Column:
    """Hash of all that a document's copies depend on; rows with equal keys are equal rows."""
    return F.xxhash64("doc_id", "source", "text")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float, scratch: Scratch) -> DataFrame:
    """(source, source_size, n, target) per source.

    ``sizes``: source, size. The k-th source by code point (null last) has weight
    ``weights[k % len(weights)]`` and gets that part of ``share`` times all words; a target above
    ``cap`` times its source's words stops there and the excess goes to the others by weight. The
    source table is one row per source, numbered in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights)).cast("double")
    per = scratch.save(per.select("source", "source_size", "n", weight.alias("weight"),
                                  F.lit(False).alias("full"), F.lit(0.0).alias("target")))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    while True:
        spent, free = per.agg(F.sum(F.when(F.col("full"), F.col("target")).otherwise(0.0)),
                              F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight")))).first()
        level = (share * total - (spent or 0.0)) / free if free else 0.0
        most = F.col("source_size") * cap
        over = ~F.col("full") & (F.col("weight") * level > most)
        now = scratch.save(per.withColumn("target", F.when(F.col("full"), F.col("target")).when(over, most)
                                          .otherwise(F.col("weight") * level))
                           .withColumn("full", F.col("full") | over))
        more = now.filter("full").count() > per.filter("full").count()
        scratch.drop(per)
        per = now
        if not more:
            return per.select("source", "source_size", "n", "target")


def _rate(cap: float) -> Column:
    return cap / (1.0 + F.exp(-F.col("tilt") * F.col("x")))


def tilts(sizes: DataFrame, goals: DataFrame, cap: float, scratch: Scratch) -> DataFrame:
    """(source, target, mean, tilt) per source; a null tilt marks a source at its cap or without words.

    ``sizes``: source, size; ``goals``: the table of ``targets``.
    """
    counts = scratch.save(sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("docs")))
    open_ = F.when((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12)), 0.0)
    state = scratch.save(goals.select("source", "source_size", "target", (F.col("source_size") / F.col("n")).alias("mean"),
                                      open_.alias("tilt"), F.lit(None).cast("double").alias("lo"),
                                      F.lit(None).cast("double").alias("hi")))
    for _ in range(STEPS):
        rows = (counts.join(state, counts["source"].eqNullSafe(state["source"])).drop(counts["source"])
                .filter("tilt is not null").withColumn("x", F.col("size") / F.col("mean")))
        words = F.col("docs") * F.col("size")
        sums = rows.groupBy(F.col("source").alias("s")).agg(
            F.sum(words * _rate(cap)).alias("words"),
            F.sum(words * F.col("x") * _rate(cap) * (cap - _rate(cap)) / cap).alias("slope"))
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - gap / F.col("slope")
        bisect = (F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2)
                  .when(hi.isNull(), F.greatest(lo * 2, lo / 2, lo + 1)).otherwise(F.least(hi * 2, hi / 2, hi - 1)))
        inside = (newton > F.coalesce(lo, F.lit(float("-inf")))) & (newton < F.coalesce(hi, F.lit(float("inf"))))
        step = F.when(F.abs(gap) <= TOLERANCE * F.col("target"), F.col("tilt")).when(
            inside & F.col("slope").isNotNull() & (F.col("slope") > 0), newton).otherwise(bisect)
        after = scratch.save(state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").select(
            "source", "source_size", "target", "mean", F.when(F.col("tilt").isNotNull(), step).alias("tilt"),
            lo.alias("lo"), hi.alias("hi"), (F.abs(gap) / F.col("target")).alias("rest")))
        worst = after.agg(F.max("rest")).first()[0]
        scratch.drop(state)
        state = after.drop("rest")
        scratch.paths[id(state)] = scratch.paths.pop(id(after))
        if worst is None or worst <= TOLERANCE:
            break
    # nine digits: sums of doubles may differ in their last bits between runs
    digits = F.pow(F.lit(10.0), 8 - F.floor(F.log10(F.greatest(F.abs("tilt"), F.lit(1e-12)))))
    out = scratch.save(state.select("source", "source_size", "target", "mean", (F.rint(F.col("tilt") * digits) / digits).alias("tilt")))
    scratch.drop(counts, state)
    return out


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """docs (all columns but text) with size, source_size, target, rate and copies per document.

    A document without words has rate 1 and one copy (no constraint speaks of it). A source whose
    target is ``cap`` times its words takes every document ``cap`` times. Equal rows get equal
    copies. Null sources are a source of their own, the last one. No rows: an empty table.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    if not docs.columns or "source" not in docs.columns:
        raise ValueError("docs need a column source")
    # the hash that decides between two copy counts, from all the row's values
    base = scratch.save(docs.select("doc_id", "source", word_count("text").alias("size"), row_key().alias("key")))
    draw = F.pmod("key", F.lit(1 << 40)) / float(1 << 40)
    goals = targets(base, weights, share, cap, scratch)
    tilt = tilts(base, goals, cap, scratch).withColumnRenamed("source", "s")
    rated = (base.join(tilt, base["source"].eqNullSafe(tilt["s"])).drop("s").withColumn("x", F.col("size") / F.col("mean"))
             .withColumn("rate", F.when(F.col("size") == 0, 1.0).when(F.col("tilt").isNotNull(), _rate(cap))
                         .when(F.col("target") > 0, cap).otherwise(0.0)))
    # a document has its rate's floor, and one copy more if its ``step`` lies before its source's cut
    whole = F.floor(F.col("rate"))
    rated = scratch.save(rated.select("doc_id", "source", "size", "key", "source_size", "target", "rate", whole.alias("whole"),
                                      (whole + 1 - F.col("rate") - draw).alias("step")))
    goes_up = _went_up(_cuts(rated, scratch), rated)
    return goes_up.select("doc_id", "size", "source_size", "target", "rate",
                          (F.col("whole") + F.when(F.col("up"), 1).otherwise(0)).cast("long").alias("copies"), "source", "key")


def _went_up(cuts: DataFrame, rated: DataFrame) -> DataFrame:
    """rated with ``up``: the document has one copy more than its rate's floor."""
    up = F.exists("cuts", lambda c: (F.col("size") <= c["most"]) & (F.col("step") < c["cut"]))
    can = (F.col("rate") > F.col("whole")) & (F.col("size") > 0)
    return (rated.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("up", can & F.coalesce(up, F.lit(False))))


def _cuts(rated: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, need, cuts): which documents go up, so that their words come closest to what the floors lack.

    A round goes through a source's documents in order of ``step`` and takes them until the next
    would exceed the need; the following rounds do so with the documents that still fit. The order
    is never made: two passes of ``BINS`` bins narrow the place of the cut to 3 / BINS ** 2, and
    what moves is one row per source, task and bin.
    """
    need = F.col("target") - F.col("floors")
    state = scratch.save(rated.groupBy("source").agg(F.max("target").alias("target"), F.sum(F.col("size") * F.col("whole")).alias("floors"))
                         .select("source", need.alias("need"), F.array().cast("array<struct<cut:double,most:double>>").alias("cuts")))
    for _ in range(FILLS):
        open_ = (_went_up(state, rated).filter("not up and rate > whole and size <= need").select("s", "size", "step"))
        first = _pass(open_, state.select(F.col("source").alias("s"), "need", F.lit(-1.0).alias("from"), F.lit(3.0).alias("width")))
        wide = scratch.save(first)
        second = _pass(open_, wide.filter("width > 0"))
        ends = wide.filter("width = 0").unionByName(second)
        after = scratch.save(state.join(ends.select("s", F.col("need").alias("rest"), "from"), F.col("source").eqNullSafe(F.col("s")), "left")
                             .select("source", F.coalesce("rest", "need").alias("need"),
                                     F.when(F.col("rest").isNull(), F.col("cuts")).otherwise(F.array_append(
                                         "cuts", F.struct(F.col("from").alias("cut"), F.col("need").alias("most")))).alias("cuts")))
        scratch.drop(wide, state)
        state = after
    return state


def _pass(docs: DataFrame, place: DataFrame) -> DataFrame:
    """One pass of bins: (s, need, from, width) after it.

    ``place``: per source the words that are still needed from ``from`` on. The result's ``from``
    is the start of the first bin that exceeds the need and ``width`` that bin's width; if no bin
    does, all are taken: ``from`` is the end and ``width`` zero.
    """
    p = place.withColumnRenamed("s", "p")
    at = F.floor((F.col("step") - F.col("from")) / F.col("width") * BINS)
    bins = (docs.join(p, F.col("s").eqNullSafe(F.col("p"))).filter("step >= `from` and step < `from` + width")
            .groupBy("s", "need", "from", "width", at.alias("bin")).agg(F.sum("size").alias("words")))
    w = Window.partitionBy("s").orderBy("bin")
    run = bins.withColumn("upto", F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    over = F.col("upto") > F.col("need")
    got = run.groupBy("s", "need", "from", "width").agg(F.min(F.when(over, F.col("bin"))).alias("bin"),
                                                        F.max(F.when(~over, F.col("upto"))).alias("used"))
    return got.select("s", (F.col("need") - F.coalesce("used", F.lit(0))).alias("need"),
                      F.when(F.col("bin").isNull(), F.col("from") + F.col("width"))
                      .otherwise(F.col("from") + F.col("bin") * F.col("width") / BINS).alias("from"),
                      F.when(F.col("bin").isNull(), 0.0).otherwise(F.col("width") / BINS).alias("width"))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies, taken (size times copies) per document."""
    c = copies(docs.select("doc_id", "source", "text"), weights, share, cap)
    return c.select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), "rate", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """docs with every row as often as the mix takes it (not at all, once, or up to ``cap`` times)."""
    c = copies(docs.select("doc_id", "source", "text"), weights, share, cap)
    key, times = unused(docs, "_key", "_copies")
    taken = c.filter("copies > 0").select(F.col("key").alias(key), F.col("copies").cast("int").alias(times)).distinct()
    rows = docs.withColumn(key, row_key()).join(taken, key)
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(key)).select(*docs.columns)
