"""Line de-duplication within an edit threshold, by a segment-partition edit join (operator 7).

A line is the text between ``\\n``, compared without spaces, tabs and carriage returns at its
ends. Blank lines are never duplicates. A line goes when an earlier line (by doc_id, then line
number; judged on the input) has the same text or, where both have at least ``min_chars``
characters, is at most ``threshold`` single-character edits away. Shorter lines match exactly only.

Everything is DataFrame work:

1. lines become hashes; the distinct lines keep their first position (aggregated before the
   shuffle, so a line that a third of the documents hold costs one row per task);
2. a distinct line of n characters is cut in ``threshold + 1`` segments. A line within the
   threshold holds one of them unchanged near its place, so every line probes, for the lengths
   n - threshold .. n, the substrings that the multi-match-aware rule leaves. Keys are
   (segment, substring) as one hash, the substring's length being the segment's; the segments go
   two a round, so that the disks hold the keys of one round. Rows are (id, key): an id is 60 bits
   of the line's hash and 4 of its length;
3. a key that more than ``CROWD`` lines hold is left out of that join, which hands on the lines that
   probe it. They meet the lines that hold it under (key, length), and pairs whose counts of fifteen
   letters and the rest, in the whole line or in one of its beginnings, differ too much are discarded in the join:
   an edit changes these counts by two in sum at most. Of all pairs then go those whose counts in the
   whole line differ too much and those of which more than ``threshold`` of sixteen pieces aren't
   found near their place. The rest are verified by a banded bit-parallel edit distance;
4. each distinct line takes the earliest position among itself and its links; occurrences after
   that position are the removed ones.

Lines are told apart by 128-bit hashes; candidates travel by their ids, are verified on texts, and
leave the verification with all 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.names import unused
from pressroom.llm.scratch import Scratch

THRESHOLD = 3
MIN_CHARS = 20
#: Fifteen letters whose counts discard pairs early; any choice is right, frequent ones discard most.
LETTERS = "eanrtioshdulcmp"
#: Pieces of a line that are looked up in the other one before the edit distance.
PIECES = 16
#: Lines that may hold a key before it counts as crowded.
CROWD = 16
#: Beginnings of a line, in characters, whose letters are counted for crowded keys; any choice is right.
HEADS = (64, 128, 192, 256, 320, 384, 448, 512)
#: Segments whose keys are joined in one round (two at most: a place has one bit for them).
A_ROUND = 2


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\r"))


def _second(line: str) -> Column:
    """The second 64 bits that tell lines apart."""
    return F.xxhash64(F.lit(7), line)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: doc_id, th (the text's hash), pos, h1, h2, line."""
    t = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    t = t.select("doc_id", "th", "pos", _trimmed(F.col("raw")).alias("line")).filter("line <> ''")
    return t.select("doc_id", "th", "pos", F.xxhash64("line").alias("h1"), _second("line").alias("h2"), "line")


def _cut(n: Column, k: int, parts: int) -> Column:
    return F.call_function("div", n * k, F.lit(parts)).cast("int")


def _part(line: Column, n: Column, start: Column, size: Column) -> Column:
    """The UTF-8 bytes of size characters from start. Where a character is a byte, none has to be walked over."""
    return (F.when(F.octet_length(line) == n, F.substring(line.cast("binary"), start + 1, size))
            .otherwise(F.substring(line, start + 1, size).cast("binary")))


def index_key(line: Column, n: Column, k: int, threshold: int) -> Column:
    """Key of the line's own segment k."""
    lo, hi = _cut(n, k, threshold + 1), _cut(n, k + 1, threshold + 1)
    return F.xxhash64(F.lit(k), _part(line, n, lo, hi - lo))


def line_id(h1: str, n: str) -> Column:
    """A line's id: its hash, the last 4 bits replaced by its length modulo 16."""
    return F.col(h1).bitwiseAND(~15).bitwiseOR(F.col(n).bitwiseAND(15).cast("long"))


def probes(lines: DataFrame, segments: list[int], threshold: int) -> DataFrame:
    """(p1, key): the keys of the segments under which lines of n - threshold .. n characters within the threshold
    must lie. Lines of neighbouring lengths share most places (start, size), so each place is probed once for all; the
    places are rows before their keys are made: one small expression a key, which the JVM compiles."""
    n, places = F.col("n"), []
    for at, k in enumerate(segments):
        for less in range(threshold + 1):
            m = n - less                                    # length of the indexed line
            lo, hi = _cut(m, k, threshold + 1), _cut(m, k + 1, threshold + 1)
            for shift in range(max(-k, less - (threshold - k)), min(k, less + threshold - k) + 1):
                # lo + threshold keeps the start positive; places that stick out of the line are left out below
                start, size = (lo + (shift + threshold)).cast("long"), (hi - lo).cast("long")
                places.append(F.shiftleft(start, 31).bitwiseOR(size).bitwiseOR(F.lit(at << 62)))
    rows = lines.select(F.col("id").alias("p1"), "line", "n", F.explode(F.array_distinct(F.array(*places))).alias("place"))
    low = (1 << 31) - 1
    start = F.shiftright("place", 31).bitwiseAND(low).cast("int") - threshold
    size, k = F.col("place").bitwiseAND(low).cast("int"), F.shiftright("place", 62).cast("int") + segments[0]
    return (rows.filter((start >= 0) & (start + size <= n))
            .select("p1", F.xxhash64(k, _part(F.col("line"), n, start, size)).alias("key")))


def counts(line: Column, n: Column) -> Column:
    """The counts, modulo 8, of the letters and of all other characters in one long, 4 bits each. The bits of a count are
    a circle on which the next count has one bit changed, so two counts differ in as many bits as they are apart."""
    rest, out = n, None
    for i, letter in enumerate([*LETTERS, None]):
        c = rest if letter is None else F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        rest = rest - c                                     # a letter is one byte
        circle = F.call_function("shiftright", F.lit(0x8CEF7310), c.bitwiseAND(7) * 4)
        bits = F.shiftleft(circle.bitwiseAND(15), 4 * i)
        out = bits if out is None else out.bitwiseOR(bits)
    return out


def ahead(a: str, b: str, threshold: int) -> Column:
    """Whether the line of id a is longer than that of b by ``threshold`` characters at most (modulo 16); lines of one
    length probe each other, and one of the two counts."""
    more = (F.col(a).bitwiseAND(15) - F.col(b).bitwiseAND(15)).bitwiseAND(15)
    return ((more > 0) & (more <= threshold)) | ((more == 0) & (F.col(b) < F.col(a)))


def counts_near(a: str, b: str, threshold: int) -> Column:
    """Whether the counts differ by at most ``2 * threshold`` in sum. A difference modulo 8 is never more than the
    difference, so no pair within the threshold is lost."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 2 * threshold


def pieces_near(x: Column, y: Column, threshold: int) -> Column:
    """Whether all but ``threshold`` of the PIECES equal pieces of x occur in y within ``threshold`` characters of their
    place. An edit changes one piece at most and moves the others by one, so no pair within the threshold is lost."""
    n, found = F.length(x), None
    for i in range(PIECES):
        lo, hi = _cut(n, i, PIECES), _cut(n, i + 1, PIECES)
        from_ = F.greatest(lo - threshold, F.lit(0))
        around = F.substring(y, from_ + 1, hi + threshold - from_)
        hit = F.contains(around, F.substring(x, lo + 1, hi - lo)).cast("int")
        found = hit if found is None else found + hit
    return found >= PIECES - threshold


def edit_distance(a: str, b: str, threshold: int) -> Column:
    """Edit distance of two array-of-character columns, or null beyond ``threshold``.

    One machine word per error count d holds a bit for each diagonal of the band: bit e is 1 if
    the first j characters of ``a`` and the first j + e - threshold of ``b`` are within d edits.
    A step of j shifts and ORs these words (match, substitution, insertion, deletion). The match
    words come first, one a character: inside the fold they would be made anew at every mention.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1

    def match(c: Column, i: Column) -> Column:
        word = None
        for e in range(width):
            bit = F.when(F.get(F.col(b), i + (e - threshold)) == c, 1 << e).otherwise(0)
            word = bit if word is None else word.bitwiseOR(bit)
        return word

    def finish(state: Column) -> Column:
        at = F.size(b) - F.size(a) + threshold
        return F.coalesce(*(F.when(F.call_function("shiftright", state[f"r{d}"], at).bitwiseAND(1) == 1, d)
                            for d in range(threshold + 1)))

    start = F.struct(*(F.lit((((1 << (d + 1)) - 1) << threshold) & full).alias(f"r{d}") for d in range(threshold + 1)))
    steps = F.aggregate(F.transform(a, match), start, lambda state, word: _advance(state, word, threshold, full), finish)
    return F.when(F.abs(F.size(a) - F.size(b)) <= threshold, F.when(F.size(a) == 0, F.size(b)).otherwise(steps))


def _advance(old: Column, match: Column, threshold: int, full: int) -> Column:
    """The words after one more character."""
    new = [old["r0"].bitwiseAND(match)]
    for d in range(1, threshold + 1):
        less = old[f"r{d - 1}"]
        word = old[f"r{d}"].bitwiseAND(match).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1))
        new.append(word.bitwiseOR(F.shiftleft(new[d - 1], 1)).bitwiseAND(full))
    return F.struct(*(w.alias(f"r{d}") for d, w in enumerate(new)))


def _chars(c: str) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _without_head(x: str, y: str, block: int = 32) -> Column:
    """(x, y) without their common first blocks, reversed. Done twice it leaves what lies between the
    common head and tail, in order; neither step changes the edit distance."""
    blocks = F.floor(F.least(F.length(x), F.length(y)) / block).cast("int")
    differs = F.transform(F.sequence(F.lit(0), blocks), lambda k: (k == blocks) | (
        F.substring(F.col(x), k * block + 1, F.lit(block)) != F.substring(F.col(y), k * block + 1, F.lit(block))))
    head = (F.array_position(differs, True) - 1).cast("int") * block
    rest = [F.reverse(F.substring(F.col(c), head + 1, F.length(c))).alias(n) for c, n in ((x, "x"), (y, "y"))]
    return F.struct(*rest)


def _crowded_pairs(chars: DataFrame, asks: DataFrame, holds: DataFrame, threshold: int) -> DataFrame:
    """(a, b) ids that meet under a crowded key, once, at lengths that fit, counts of letters near in the whole line and in every
    beginning. A beginning has the same number of characters in both lines, so an edit changes its counts by two at most."""
    line, sigs = F.col("line"), ["sig", *(f"s{h}" for h in HEADS)]

    def signed(rows: DataFrame) -> DataFrame:
        t = chars.join(rows.select("id").distinct(), "id", "left_semi")
        heads = ((h, F.substring(line, 1, h)) for h in HEADS)
        return t.select("id", "n", "sig", *(counts(x, F.length(x)).alias(f"s{h}") for h, x in heads))

    # a line holds each key once at most, a key a segment; two lines meet under the first one that both have
    held = (holds.groupBy("id").agg(F.collect_list("key").alias("keys")).join(signed(holds), "id")
            .select("id", "n", "keys", *sigs, F.explode("keys").alias("key"))
            .withColumn("before", F.filter("keys", lambda x: x < F.col("key"))).drop("keys"))
    asks = asks.withColumnRenamed("p1", "id")
    ask = (asks.groupBy("id").agg(F.collect_list("key").alias("p_keys")).join(signed(asks), "id")
           .select(F.col("id").alias("p1"), "p_keys", "n", *(F.col(x).alias("p_" + x) for x in sigs), F.explode("p_keys").alias("key"))
           .withColumn("n", F.explode(F.array(*(F.col("n") - less for less in range(threshold + 1))))))
    near = ahead("p1", "id", threshold)
    for x in sigs:
        near = near & counts_near(x, "p_" + x, threshold)
    return (ask.join(held, ["key", "n"]).filter(near & ~F.arrays_overlap("before", "p_keys"))
            .select(F.least("id", "p1").alias("a"), F.greatest("id", "p1").alias("b")))


def line_links(lines: DataFrame, scratch: Scratch, threshold: int, min_chars: int) -> DataFrame:
    """(a, a2, b, b2) hashes of distinct lines within the threshold, both directions.

    ``lines``: h1 and line, one row per distinct line; a2 and b2 are the second hashes.
    """
    line, n, segments = F.col("line"), F.col("n"), list(range(threshold + 1))
    long = lines.withColumn("n", F.length("line")).filter(n >= min_chars).withColumn("id", line_id("h1", "n"))

    def index(of: list[int]) -> DataFrame:
        return long.select("id", F.explode(F.array(*(index_key(line, n, k, threshold) for k in of))).alias("key"))

    crowded = scratch.save(index(segments).groupBy("key").count().filter(F.col("count") > CROWD).select("key"), free=True)
    rounds = []
    for of in (segments[k:k + A_ROUND] for k in range(0, threshold + 1, A_ROUND)):
        # a crowded key is one row without an id: it makes one row of each line that probes it
        held = index(of).join(crowded, "key", "left_anti").select("id", "key").union(crowded.select(F.lit(None).cast("long"), "key"))
        # no key has many rows in held, so the held rows of a partition are a small table and the probes needn't be sorted
        met = probes(long, of, threshold).join(held.hint("shuffle_hash"), "key").filter(F.isnull("id") | ahead("p1", "id", threshold))
        rounds.append(scratch.save(met.select("p1", "id", F.when(F.isnull("id"), F.col("key")).alias("key")), free=True))
    met = rounds[0]
    for more in rounds[1:]:
        met = met.union(more)
    holds = scratch.save(index(segments).join(crowded, "key", "left_semi").select("id", "key"), free=True)
    asks = scratch.save(met.filter("key is not null").select("p1", "key").distinct(), free=True)
    found = met.filter("id is not null").select(F.least("id", "p1").alias("a"), F.greatest("id", "p1").alias("b")).distinct()
    found = scratch.save(found, free=True)
    ids = scratch.save(found.select(F.col("a").alias("id")).union(found.select("b")).union(asks.select("p1"))
                       .union(holds.select("id")).distinct(), free=True)
    # the texts are shuffled once, unsorted: the ids of a partition are a small table beside them
    chars = scratch.save(long.join(ids.hint("shuffle_hash"), "id", "left_semi")
                         .select("id", "h1", _second("line").alias("h2"), "n", "line", counts(line, n).alias("sig")), free=True)
    crowd = _crowded_pairs(chars, asks, holds, threshold)
    pairs = scratch.save(found.union(crowd).distinct(), free=True)

    def side(a: str, x: str) -> DataFrame:
        return chars.select(F.col("id").alias(a + "_id"), F.col("h1").alias(a), F.col("h2").alias(a + "2"), F.col("line").alias(x),
                            F.col("sig").alias(a + "_sig"))

    both = (pairs.withColumnsRenamed({"a": "a_id", "b": "b_id"}).join(side("a", "x"), "a_id").join(side("b", "y"), "b_id"))
    both = both.filter(counts_near("a_sig", "b_sig", threshold) & pieces_near(F.col("x"), F.col("y"), threshold))
    # each step's strings are made once per pair: a generator's output is not substituted into later ones
    for _ in ("heads", "tails"):
        both = both.select("a", "a2", "b", "b2", F.inline(F.array(_without_head("x", "y"))))
    both = both.select("a", "a2", "b", "b2", F.inline(F.array(F.struct(_chars("x").alias("x"), _chars("y").alias("y")))))
    links = both.filter(edit_distance("x", "y", threshold).isNotNull()).select("a", "a2", "b", "b2")
    back = links.select(F.col("b").alias("a"), F.col("b2").alias("a2"), F.col("a").alias("b"), F.col("a2").alias("b2"))
    out = scratch.save(links.unionByName(back), free=True)
    scratch.drop(crowded, holds, asks, found, ids, chars, pairs, *rounds)
    return out


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, removed array<int>): the line numbers (from 0) that go, for documents that lose any.

    ``th`` is the hash of the text, which tells rows with the same doc_id apart; rows that agree
    in both are one document. A null doc_id comes before all others. Null texts have no lines.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = _lines(docs.select("doc_id", "text"))
    at = F.struct("doc_id", "th", "pos")
    occurrences = scratch.save(lines.select("doc_id", "th", "pos", "h1", "h2"))
    distinct = scratch.save(lines.groupBy("h1", "h2").agg(F.first("line").alias("line")), free=True)
    firsts = scratch.save(occurrences.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")), free=True)
    links = line_links(distinct.select("h1", "line"), scratch, threshold, min_chars)
    via = (links.join(firsts.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), "first"), ["b", "b2"])
           .groupBy(F.col("a").alias("h1"), F.col("a2").alias("h2")).agg(F.min("first").alias("via")))
    earliest = scratch.save(firsts.join(via, ["h1", "h2"], "left").filter("n > 1 or via < first")
                            .select("h1", "h2", F.least("first", F.coalesce("via", "first")).alias("earliest")), free=True)
    out = scratch.save(occurrences.join(earliest, ["h1", "h2"]).filter(at > F.col("earliest"))
                       .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("removed")), free=True)
    scratch.drop(occurrences, distinct, firsts, links, earliest)
    return out


def _with_removed(docs: DataFrame, removed: DataFrame) -> tuple[DataFrame, str]:
    doc, th, cut = unused(docs, "_doc", "_th", "_removed")
    r = removed.select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("removed").alias(cut))
    on = docs["doc_id"].eqNullSafe(r[doc]) & (F.xxhash64(docs["text"]) == r[th])
    return docs.join(r, on, "left").drop(doc, th), cut


def line_report(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines (non-blank), n_removed, removed (line numbers, comma-joined)."""
    numbers = docs.select("doc_id", F.xxhash64("text").alias("th"),
                          F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1),
                                          lambda x: _trimmed(x) != "")).cast("long").alias("n_lines"))
    r = removed_lines(docs, threshold, min_chars).withColumnRenamed("doc_id", "_doc").withColumnRenamed("th", "_th")
    return (numbers.join(r, numbers["doc_id"].eqNullSafe(r["_doc"]) & (numbers["th"] == r["_th"]), "left")
            .select("doc_id", "n_lines",
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed")))


def drop_repeated_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the removed lines cut out of text; columns and their order stay.

    A document that loses its last non-blank line goes (its lines are in earlier documents); null,
    empty and blank texts stay as they are. Texts that lose nothing stay unchanged.
    """
    rows, cut = _with_removed(docs, removed_lines(docs, threshold, min_chars))
    kept = F.array_join(F.filter(F.split("text", "\n", -1),
                                 lambda x, i: ~F.array_contains(F.col(cut), i)), "\n")
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept)
    return (rows.withColumn("text", text).filter(F.col(cut).isNull() | (_trimmed(F.translate("text", "\n", " ")) != ""))
            .select(*docs.columns))
