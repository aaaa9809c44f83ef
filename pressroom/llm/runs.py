"""Periodic runs of words by a dictionary of basic factors (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``least`` words and ``exponent`` periods long, that no neighbouring word extends.

For every power of two m the dictionary names the factors (m consecutive words): equal names
mean equal words, and a name of 2m words is the pair of the names of its halves. Occurrences of
a factor within a window of 2m words form one arithmetic progression; its step, the distance to
the successor, is the smallest period there. So successors at most m words apart propose
periods; neighbouring positions with the same step are one stretch, extended over what its
last factor covers, and stretches that several m propose are one run. A run of q words' period and
four periods' length holds both a factor of m >= q words and its successor for the smallest
such m, so with ``exponent`` >= 3 none is missed.

A factor that occurs once in its text has no name: nothing longer that starts there repeats
either. The documents of a batch are laid end to end and named together, some megabytes at a
time; a text is never cut. Work is n log n words, whatever the texts repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose words are named together.
TOGETHER = 2 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return (text or "").encode().split()


def _successors(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose name occurs twice or more, by name and position; their dense names; distance to the successor (0: none)."""
    order = np.argsort(names, kind="stable")
    names, at = names[order], at[order]
    same = names[1:] == names[:-1]
    again = np.zeros(len(names), bool)
    again[1:] |= same
    again[:-1] |= same
    step = np.zeros(len(names), np.int64)
    step[:-1][same] = (at[1:] - at[:-1])[same]
    names, at, step = names[again], at[again], step[again]
    dense = np.cumsum(np.concatenate([[0], names[1:] != names[:-1]])) if len(names) else names
    return at, dense, step


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = 6, exponent: int = 4) -> np.ndarray:
    """The runs of several word sequences laid end to end: rows (start, length, period), by start and period.

    ``ids`` are integers that differ between words, ``ends[i]`` is where the sequence of position i ends.
    """
    n, found = len(ids), []
    if n == 0:
        return np.zeros((0, 3), np.int64)
    at, m = np.arange(n), 1
    longest = int((ends - at).max())
    names = ends * (int(ids.max()) + 1) + ids              # words of different sequences are different
    while len(at):
        at, dense, step = _successors(names, at)
        close = (step > 0) & (step <= m)
        i, q = at[close], step[close]
        order = np.lexsort((i, q))
        i, q = i[order], q[order]
        cut = np.ones(len(i), bool)
        cut[1:] = (i[1:] != i[:-1] + 1) | (q[1:] != q[:-1]) | (ends[i[1:]] != ends[i[:-1]])
        first = np.nonzero(cut)[0]
        last = np.concatenate([first[1:], [len(i)]])[:len(first)] - 1
        length = i[last] - i[first] + q[first] + m         # up to the end of the last successor
        good = length >= np.maximum(least, exponent * q[first])
        found.append(np.stack([i[first], length, q[first]], axis=1)[good])
        if m * exponent >= longest:                        # a longer period has no run in any sequence
            break
        # the names of twice the words: pairs of names, where both halves have one
        name_at = np.full(n, -1, np.int64)
        name_at[at] = dense
        second = at + m
        inside = second < ends[at]
        at, second, dense = at[inside], second[inside], dense[inside]
        half = name_at[second]
        both = half >= 0
        at, names, m = at[both], dense[both] * n + half[both], 2 * m
    return np.unique(np.concatenate(found), axis=0)


def _by_start_and_period(runs: np.ndarray) -> np.ndarray:
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _together(texts: list[str | None]) -> Iterator[list[str | None]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def collapse(texts: list[str | None], least: int = 6, exponent: int = 4) -> Iterator[tuple[np.ndarray, str]]:
    """Each text's runs, and its words joined by a space without those after the first period of a run."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    stops = np.cumsum(sizes)
    flat = [w for ws in words for w in ws]
    code = {w: i for i, w in enumerate(set(flat))}
    ids = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
    runs = _by_start_and_period(find_runs(ids, np.repeat(stops, sizes), least, exponent))
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(cover[:-1]) > 0
    cuts = np.searchsorted(runs[:, 0], np.concatenate([[0], stops]))
    for k, (ws, stop) in enumerate(zip(words, stops)):
        start, own = stop - len(ws), runs[cuts[k]:cuts[k + 1]]
        if len(own):
            ws = [w for w, g in zip(ws, gone[start:stop].tolist()) if not g]
        yield own - [start, 0, 0], b" ".join(ws).decode()


def periodic(text: str | Column, least: int = 6, exponent: int = 4) -> Column:
    """struct(runs, collapsed) of each whole text: its runs by start and period, and the text they collapse to.

    Starts count words from 0. Null, empty and white texts have no runs and collapse to the empty
    text. Each row stands alone, so repeated rows, clashing column names and empty tables need no care.
    """
    if exponent < 3 or least < 1:
        raise ValueError("runs of fewer than three periods need factors that the dictionary doesn't hold")

    @F.arrow_udf(f"struct<runs:{RUNS},collapsed:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in batches:
            rows, offsets, collapsed = [np.zeros((0, 3), np.int64)], [0], []
            for group in _together(b.to_pylist()):
                for own, left in collapse(group, least, exponent):
                    rows.append(own)
                    offsets.append(offsets[-1] + len(own))
                    collapsed.append(left)
            flat = np.concatenate(rows)
            values = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(triple))
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(collapsed, pa.string())],
                names=["runs", "collapsed"])

    return run(text)


def _repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where h = crc32(decimal doc_id) divides by 10, the words from a = g % n on repeat the
    p = 1 + (n - a) div (3 + g % 8) words that stand there, for g = h div 10. Rows without a doc_id stay."""
    staged = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", "[ \\t-\\r]+"), ""))
    staged = staged.withColumn("w", words).withColumn("n", F.size("w").cast("long"))
    changed = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    g = F.floor(F.col("h") / 10)
    a = g % F.col("n")
    tail = F.col("n") - F.col("a")
    p = (1 + F.floor(tail / (3 + g % 8))).cast("int")
    staged = staged.withColumn("a", F.when(changed, a.cast("int"))).withColumn("p", F.when(changed, p))
    head = F.slice("w", F.lit(1), F.col("a"))
    piece = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil(tail / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(piece, times)), F.lit(1), tail.cast("int"))
    return staged.select("doc_id", F.when(changed, F.array_join(F.concat(head, again), " ")).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row of docs.

    The longest run is shown, the smallest start, then period, among equals; four nulls without a run.
    """
    found = _repeat_tails(docs).select("doc_id", periodic("text").alias("r")).select("doc_id", "r.runs", "r.collapsed")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("back"), (-r.period).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","),
                                                   r.period.cast("string"), F.lit("\n")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.less")).alias("period"),
                    F.expr("best.length * 1000 div -best.less").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
