"""Repeated passages by a logarithmic family of sparse suffix arrays (operator 3).

Byte p of a text starts a window of ``WINDOW`` bytes; the window is a repeat if an equal one
starts earlier (smaller doc_id, or the same document and an earlier start). Bytes of repeats go.

1. Sampling. Each window elects an anchor: the position, among its ``GRAM``-byte strings, of the one
   with the smallest hash. The election sees nothing but the window's bytes, so equal windows
   elect the same place. Consecutive windows mostly share their anchor; the bytes that an anchor's
   windows cover are its chunk. A text of n bytes has about n / 31 anchors. A long text is
   read in slices that overlap by a window less a byte.
2. Batches. A task sorts the anchored strings of a batch of documents by the fingerprint of
   their first ``GRAM`` bytes, then of their chunk. Equal chunks inside the batch are settled there
   (all but the earliest repeat), so copies don't travel. Of the chunks that share an anchor two go
   on; they tell every other batch that the anchor is open, and the rest are open at once, so
   an anchor in a third of all texts costs two entries per batch.
3. Levels. The arrays are dealt out by the anchor's fingerprint. A bucket's task holds a family of sorted
   levels: a new batch is merge-scanned against every level; of two equal chunks the later one
   repeats; then the batch becomes a level, and levels of about equal size merge, so that an
   entry is merged a logarithmic number of times.
4. Chunks with equal anchors but different ends are open: parts of them may be equal. Their single
   windows go through the same levels, by the windows' fingerprints.
5. What buckets found leaves them packed by parts of the documents; a part's task makes one row per
   document. The repeats meet their documents again and the kept bytes are cut out.

This departs from suffix arrays in the strict sense: entries are ordered by 128-bit fingerprints of
elected strings (64 of the anchor, 64 of the chunk; windows: two of 64) and compared for equality, where a
suffix array orders by bytes and measures common prefixes. The matches asked for have a fixed
length, for which equality is enough, and an entry of 40 bytes for 31 bytes of text stands where the
suffixes themselves would need the texts in every task. The index family, the batches, the merge
scans and the geometric merging are as named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.scratch import Scratch

WINDOW = 100
GRAM = 40
BUFFER = 1 << 20                                            # bytes that are hashed together
BATCH = 1 << 20                                             # suffixes of a batch
BUCKET = 64 << 20                                           # bytes of text for each bucket
_NO_ID = -(1 << 63)

_PLACE = np.dtype([("did", "<i8"), ("th", "<i8"), ("l", "<i4"), ("r", "<i4")])
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)           # odd, so they have inverses modulo 2 ** 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Fingerprints of all substrings of a buffer: a polynomial over mixed byte values, modulo 2 ** 64."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buf: np.ndarray, which: int = 0):
        up, self.down = self._powers(which, len(buf) + 1)
        values = _mix(np.arange(1 + 256 * which, 257 + 256 * which, dtype=np.uint64))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(values[buf] * up[:len(buf)], out=self.sums[1:])

    @classmethod
    def _powers(cls, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in cls.powers or len(cls.powers[which][0]) < n:
            size, base = max(n, BUFFER + 1), _BASES[which]
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p))
            cls.powers[which] = tuple(both)
        return cls.powers[which]

    def of(self, start, end) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all_of(self, n: int) -> np.ndarray:
        return _mix((self.sums[n:] - self.sums[:-n]) * self.down[:len(self.sums) - n])


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, anchor's fingerprint, chunk's fingerprint) per anchor.

    ``buf``: the documents' bytes one after the other, ``starts`` and ``ends`` their places.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    count = len(buf) - WINDOW + 1
    long = ends - starts >= WINDOW
    if count <= 0 or not long.any():
        return none
    rolling = Rolling(buf)
    gram = rolling.all_of(GRAM)
    low = np.uint64(0xFFFFFFFF)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)       # hash, then the leftmost place
    width, span = WINDOW - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:count], least[width - span:width - span + count])
    at = (least & low).astype(np.int64)
    edge = np.zeros(count + 1, np.int8)
    edge[starts[long]] += 1
    edge[ends[long] - WINDOW + 1] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)           # windows that lie in one document
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    l, r = np.nonzero(new)[0], np.nonzero(last)[0]
    a = at[l]
    chunk = rolling.of(l, r + WINDOW)
    shape = ((a - l) << 32 | (r - l)).astype(np.uint64)
    return np.searchsorted(starts, l, side="right") - 1, l, r, gram[a], _mix(chunk ^ _mix(shape))


def _keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """16-byte strings that sort as (first, second)."""
    return np.stack([first.astype(">u8"), second.astype(">u8")], axis=1).view("S16").ravel()


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether place a is earlier than place b, element by element."""
    return ((a["did"] < b["did"]) | (a["did"] == b["did"]) & ((a["th"] < b["th"]) | (a["th"] == b["th"]) & (a["l"] < b["l"])))


def suffix_array(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with their earliest places, and the places that repeat an earlier one.

    A row given twice gives each of its places twice: they are one place and repeat nothing.
    """
    order = np.lexsort((places["l"], places["th"], places["did"], keys))
    keys, places = keys[order], places[order]
    first, again = np.ones(len(keys), bool), np.zeros(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    again[1:] = ~first[1:]
    for f in ("did", "th", "l"):
        again[1:] &= places[f][1:] == places[f][:-1]
    return keys[first], places[first], places[~first & ~again]


class Levels:
    """A logarithmic family of suffix arrays; each key is in one level, with its earliest place."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.repeats: list[np.ndarray] = []

    def add(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Merge-scan a batch's suffix array against the levels, then take it in as a level."""
        for known, where in self.levels:
            if not len(keys):
                return
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = np.nonzero(known[at] == keys)[0]
            at = at[hit]
            earlier = _before(places[hit], where[at])
            same = (places["did"][hit] == where["did"][at]) & (places["th"][hit] == where["th"][at]) & (places["l"][hit] == where["l"][at])
            self.repeats.append(where[at[earlier]])
            self.repeats.append(places[hit[~earlier & ~same]])
            where[at[earlier]] = places[hit[earlier]]
            rest = np.ones(len(keys), bool)
            rest[hit] = False
            keys, places = keys[rest], places[rest]
        if not len(keys):
            return
        self.levels.append((keys, places.copy()))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            (ka, pa_), (kb, pb) = self.levels.pop(), self.levels.pop()
            at = np.searchsorted(kb, ka)
            self.levels.append((np.insert(kb, at, ka), np.insert(pb, at, pa_)))

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.levels:
            return np.zeros(0, "S16"), np.zeros(0, _PLACE)
        keys, places = np.concatenate([k for k, _ in self.levels]), np.concatenate([p for _, p in self.levels])
        order = np.argsort(keys, kind="stable")
        return keys[order], places[order]

    def repeated(self) -> np.ndarray:
        return np.concatenate(self.repeats) if self.repeats else np.zeros(0, _PLACE)


def without_common_anchors(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (anchor, chunk) keys with at most two chunks of an anchor, and the places of the other chunks."""
    gram = np.frombuffer(keys.tobytes(), ">u8")[::2]
    third = np.zeros(len(keys), bool)
    third[2:] = gram[2:] == gram[:-2]
    return keys[~third], places[~third], places[third]


# ---- what travels --------------------------------------------------------------------------------

def _pack(keys: np.ndarray, *places: np.ndarray) -> bytes:
    head = np.array([len(keys), *map(len, places)], "<i8").tobytes()
    columns = [x[f].tobytes() for x in places for f in _PLACE.names]
    return zstandard.compress(b"".join([head, keys.tobytes(), *columns]), 1)


def _unpack(blob: bytes, lists: int) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n, *sizes = np.frombuffer(raw, "<i8", 1 + lists).tolist()
    at = 8 * (1 + lists)
    out = [np.frombuffer(raw, "S16", n, at)]
    at += 16 * n
    for size in sizes:
        places = np.empty(size, _PLACE)
        for f in _PLACE.names:
            t = _PLACE[f]
            places[f] = np.frombuffer(raw, t, size, at)
            at += size * t.itemsize
        out.append(places)
    return out


_DEALT = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def _deal(keys: np.ndarray, places: np.ndarray, settled: np.ndarray, opened: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A batch's array, cut by bucket. What the batch settled or opened itself goes along, spread evenly."""
    own = (np.frombuffer(keys.tobytes(), ">u8")[::2] % np.uint64(buckets)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
    order = np.argsort(own, kind="stable")                   # keeps the order inside a bucket
    keys, places = keys[order], places[order]
    cuts = [np.searchsorted(own[order], np.arange(buckets + 1)),
            *(np.linspace(0, len(x), buckets + 1).astype(np.int64) for x in (settled, opened))]
    rows = []
    for b in range(buckets):
        k, s, o = (slice(c[b], c[b + 1]) for c in cuts)
        if any(x.start < x.stop for x in (k, s, o)):
            rows.append((b, _pack(keys[k], places[k], settled[s], opened[o])))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      schema=_DEALT)


_PARTS = "part int, open boolean, blob binary"
_SPANS = "did long, th long, open boolean, spans binary"


def _by_part(places: np.ndarray, parts: int, open_: bool) -> pa.Table:
    """Places packed by the part of the documents that they lie in: at most ``parts`` rows."""
    own = (_mix(places["did"].astype(np.uint64) ^ _mix(places["th"].astype(np.uint64))) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(own, kind="stable")
    own, places = own[order], places[order]
    cut = np.append(np.nonzero(np.diff(own, prepend=-1))[0], len(own))
    blobs = [_pack(np.zeros(0, "S16"), places[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table([pa.array(own[cut[:-1]], pa.int32()), pa.array([open_] * len(blobs), pa.bool_()), pa.array(blobs, pa.binary())],
                    names=["part", "open", "blob"])


def _by_document(table: pa.Table) -> pa.Table:
    """Of a part: one row per document and kind (repeats, open chunks) with its (first window, last window) pairs."""
    out = []
    for open_ in (False, True):
        blobs = table.filter(pa.compute.equal(table.column("open"), open_)).column("blob")
        if not len(blobs):
            continue
        places = np.concatenate([_unpack(x.as_py(), 1)[1] for x in blobs])
        places = places[np.lexsort((places["l"], places["th"], places["did"]))]
        new = np.ones(len(places), bool)
        new[1:] = (places["did"][1:] != places["did"][:-1]) | (places["th"][1:] != places["th"][:-1])
        start = np.nonzero(new)[0]
        spans = np.stack([places["l"], places["r"]], axis=1).astype("<i4")
        offsets = pa.py_buffer(np.append(start, len(places)).astype("<i4") * 8)
        packed = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(spans.tobytes())])
        out.append(pa.table([pa.array(places["did"][start]), pa.array(places["th"][start]),
                             pa.array(np.full(len(start), open_)), packed], names=["did", "th", "open", "spans"]))
    return pa.concat_tables(out)


def _found(dealt: DataFrame, chunks: bool, parts: int) -> DataFrame:
    """(did, th, open, spans) of dealt arrays: the buckets' levels, then one row per document and kind."""
    return (dealt.groupBy("bucket").applyInArrow(lambda t: _scan_levels(t, chunks, parts), _PARTS)
            .groupBy("part").applyInArrow(_by_document, _SPANS))


def _slices(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(first window, bytes) of slices of a text; each window lies in one of them."""
    for at in range(0, max(1, len(raw) - WINDOW + 1), BUFFER):
        yield at, raw[at:at + BUFFER + WINDOW - 1]


def _batches(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, blob): the suffix arrays of batches of documents, dealt by fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        ids: list[tuple[int, int, int]] = []
        held: list[tuple] = []
        size = n = 0

        def hashed() -> None:
            nonlocal texts, ids, size, n
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            ends = np.cumsum(lens)
            doc, l, r, gram, chunk = anchors(np.frombuffer(b"".join(texts), np.uint8), ends - lens, ends)
            places = np.empty(len(l), _PLACE)
            own = np.array(ids, np.int64).reshape(-1, 3)
            places["did"], places["th"] = own[doc, 0], own[doc, 1]
            shift = own[doc, 2] - (ends - lens)[doc]
            places["l"], places["r"] = l + shift, r + shift
            held.append((_keys(gram, chunk), places))
            texts, ids, size, n = [], [], 0, n + len(l)

        def array() -> pa.RecordBatch:
            nonlocal n
            keys, places, settled = suffix_array(np.concatenate([k for k, _ in held]), np.concatenate([p for _, p in held]))
            held.clear()
            n = 0
            keys, places, opened = without_common_anchors(keys, places)
            return _deal(keys, places, settled, opened, buckets)

        for b in batches:
            for did, th, text in zip(b.column("did").to_pylist(), b.column("th").to_pylist(), b.column("text").to_pylist()):
                raw = text.encode()
                if len(raw) < WINDOW:
                    continue
                for at, piece in _slices(raw):
                    texts.append(piece)
                    ids.append((did, th, at))
                    size += len(piece)
                    if size >= BUFFER:
                        hashed()
                    if n >= BATCH:
                        yield array()
        if texts:
            hashed()
        if n:
            yield array()

    return docs.select("did", "th", "text").mapInArrow(run, "bucket int, blob binary")


def _scan_levels(table: pa.Table, chunks: bool, parts: int) -> pa.Table:
    """One bucket's batches through its levels: repeats and, of chunks, the open ones."""
    family, repeats, opened = Levels(), [], []
    for blob in table.column("blob"):
        keys, places, settled, direct = _unpack(blob.as_py(), 3)
        repeats.append(settled)
        opened.append(direct)
        family.add(keys, places)
    out = [_by_part(np.concatenate([family.repeated(), *repeats]), parts, False)]
    if chunks:
        keys, places = family.all()
        gram = np.frombuffer(keys.tobytes(), ">u8")[::2]
        same = gram[1:] == gram[:-1]
        open_ = np.zeros(len(keys), bool)
        open_[1:] |= same
        open_[:-1] |= same
        out.append(_by_part(np.concatenate([places[open_], *opened]), parts, True))
    return pa.concat_tables(out)


def _open_windows(joined: DataFrame, buckets: int) -> DataFrame:
    """(bucket, blob): arrays of the single windows of open chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def array() -> pa.RecordBatch:
            out = suffix_array(np.concatenate([k for k, _ in held]), np.concatenate([p for _, p in held]))
            held.clear()
            return _deal(*out, np.zeros(0, _PLACE), buckets)

        for b in batches:
            for did, th, z, spans in zip(*(b.column(c).to_pylist() for c in ("did", "th", "z", "spans"))):
                raw = zstandard.decompress(z)
                pairs = np.frombuffer(spans, "<i4").reshape(-1, 2)
                for at, piece in _slices(raw):
                    own = pairs[(pairs[:, 1] >= at) & (pairs[:, 0] < at + BUFFER)]
                    if not len(own):
                        continue
                    buf = np.frombuffer(piece, np.uint8)
                    p = np.concatenate([np.arange(max(l - at, 0), min(r - at, BUFFER - 1) + 1) for l, r in own.tolist()])
                    places = np.empty(len(p), _PLACE)
                    places["did"], places["th"], places["l"], places["r"] = did, th, p + at, p + at
                    held.append((_keys(Rolling(buf).of(p, p + WINDOW), Rolling(buf, 1).of(p, p + WINDOW)), places))
                    n += len(p)
                    if n >= BATCH:
                        yield array()
                        n = 0
        if n:
            yield array()

    return joined.mapInArrow(run, "bucket int, blob binary")


def _zipped(docs: DataFrame) -> DataFrame:
    """did, th and the text's bytes compressed (texts travel by document)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(1)
        for b in batches:
            z = [tool.compress(t.encode()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "did", "th")), pa.array(z, pa.binary())],
                                             names=["doc_id", "did", "th", "z"])

    return docs.select("doc_id", "did", "th", "text").mapInArrow(run, "doc_id long, did long, th long, z binary")


def removed_runs(n: int, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs of a text of n bytes, from its repeats' window spans."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, pairs[:, 0], 1)
    np.add.at(edge, pairs[:, 1] + WINDOW, -1)
    gone = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    return np.nonzero(gone[1:] & ~gone[:-1])[0], np.nonzero(~gone[1:] & gone[:-1])[0]


def without_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row, and the kept bytes if asked.

    ``docs``: doc_id (long) and text; other columns are ignored. A null text is an empty one, a null
    doc_id comes before all others. Rows with the same doc_id are told apart by their text's hash;
    rows equal in both are one document, and each gets its result. No rows: an empty table.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "suffix")
    base = docs.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0        # one number: what the buckets are to hold
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET)
    base = base.withColumn("th", F.xxhash64("text"))
    found = scratch.save(_found(_batches(base, buckets), True, buckets))
    texts = _zipped(base)
    open_ = found.filter("open").select("did", "th", "spans")
    windows = _open_windows(texts.select("did", "th", "z").join(open_, ["did", "th"]), buckets)
    more = scratch.save(_found(windows, False, buckets))
    repeats = (found.filter("not open").unionByName(more).groupBy("did", "th")
               .agg(F.collect_list("spans").alias("spans")))          # two lists at most
    joined = texts.join(repeats, ["did", "th"], "left").select("doc_id", "z", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, z, blobs in zip(*(b.column(c).to_pylist() for c in ("doc_id", "z", "spans"))):
                raw = zstandard.decompress(z)
                s, e = removed_runs(len(raw), np.frombuffer(b"".join(blobs or []), "<i4").reshape(-1, 2))
                kept = b"".join(raw[a:c] for a, c in zip([0, *e.tolist()], [*s.tolist(), len(raw)]))
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(s), hashlib.sha256(kept).hexdigest(),
                             kept if keep_text else None))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns[:6 if keep_text else 5], names=names[:6 if keep_text else 5])

    extra = ", kept binary" if keep_text else ""
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + extra)
