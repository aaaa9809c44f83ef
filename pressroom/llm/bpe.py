"""Byte-level BPE encoding and decoding (operator 2).

A text is cut in pre-tokens by the vocabulary's pattern. Two tiers turn a pre-token into ids:

1. a minimal perfect hash over the vocabulary finds pre-tokens that are whole vocabulary
   entries: ``n`` entries fill exactly ``n`` slots (hash and displace), the entry in the slot
   is compared byte by byte, so a hit is exact;
2. the rest are merged from bytes: a linked list of symbols and a heap of (rank, position) of
   adjacent pairs; stale heap entries are skipped. Ties go to the leftmost pair.

A task looks up the distinct new pre-tokens of a batch together and keeps recent results in a
memo of at most ``MEMO`` entries; the memo only saves time. The perfect hash is built on the
driver from the vocabulary file (its size bounds the broadcast) and shipped to the executors,
so workers need no access to the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMO = 600_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def load_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank. The file has one ``base64 rank`` line per entry; ranks are 0..n-1."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _hashes(items: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each byte string: a polynomial over its bytes, mixed."""
    lens = np.fromiter(map(len, items), np.int64, len(items))
    flat = np.frombuffer(b"".join(items), np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(lens) - lens
    at = np.arange(len(flat)) - np.repeat(starts, lens)
    power = np.cumprod(np.full(max(1, int(lens.max(initial=1))), 0x9E3779B97F4A7C15, np.uint64))
    out = np.zeros(len(items), np.uint64)
    full = lens > 0
    if full.any():
        out[full] = np.add.reduceat(_mix(flat * power[at]), starts[full])
    return _mix(out ^ lens.astype(np.uint64))


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: slot = mix(hash + displacement[bucket]) mod n.

    Buckets of one entry name their slot directly (a negative displacement).
    """

    def __init__(self, items: list[bytes]):
        self.items, n = items, len(items)
        h = _hashes(items)
        if len(np.unique(h)) != n:
            raise ValueError("vocabulary entries repeat or their hashes collide")
        self.n, self.buckets = n, n // 4 + 1
        self.shift = np.zeros(self.buckets, np.int64)
        self.at = np.full(n, -1, np.int64)                 # slot -> rank
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(n, bool)
        for b in np.argsort(cuts[:-1] - cuts[1:], kind="stable"):
            own = order[cuts[b]:cuts[b + 1]]
            if len(own) == 1:
                break
            first = 1
            while True:
                tries = np.arange(first, first + 64, dtype=np.uint64)
                slots = (_mix(h[own][None, :] + tries[:, None] * _M1) % np.uint64(n)).astype(np.int64)
                ok = free[slots].all(axis=1)
                for t in np.nonzero(ok)[0]:
                    if len(set(slots[t].tolist())) == len(own):
                        break
                else:
                    first += 64
                    continue
                self.shift[b] = first + t
                free[slots[t]] = False
                self.at[slots[t]] = own
                break
        single = np.nonzero(np.diff(cuts) == 1)[0]
        slots = np.nonzero(free)[0][:len(single)]
        self.shift[single] = -slots - 1
        self.at[slots] = order[cuts[single]]

    def find(self, items: list[bytes]) -> list[int]:
        """Rank of each item, -1 where it isn't in the vocabulary."""
        if not items or not self.n:
            return [-1] * len(items)
        h = _hashes(items)
        shift = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        slots = (_mix(h + shift.astype(np.uint64) * _M1) % np.uint64(self.n)).astype(np.int64)
        ranks = self.at[np.where(shift < 0, -shift - 1, slots)].tolist()
        known = self.items
        return [r if r >= 0 and known[r] == x else -1 for r, x in zip(ranks, items)]


class Splitter:
    """All matches of a pattern in a text.

    The pattern's Unicode classes need the ``regex`` module. For texts of code points below
    ``WIDE`` the classes are spelt out once, as the ``regex`` module defines them, and the
    standard library's matcher, which is faster, gives the same matches.
    """

    WIDE = 0x250

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern).findall
        narrow = "".join(map(chr, range(self.WIDE)))
        spelt = {name: "".join(f"\\u{ord(c):04x}" for c in regex.findall(name, narrow))
                 for name in (r"\p{L}", r"\p{N}", r"\s")}
        out, inside = "", False
        for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern):
            if part == "[" or part == "]":
                inside = part == "["
            if part == r"\S":
                part = f"[^{spelt[r'\s']}]"
            elif part in spelt:
                part = spelt[part] if inside else f"[{spelt[part]}]"
            out += part
        self.narrow = re.compile(out).findall
        self.wide = re.compile(f"[^\\x00-\\u{self.WIDE - 1:04x}]").search

    def __call__(self, text: str) -> list[str]:
        return (self.full if self.wide(text) else self.narrow)(text)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: list[bytes], pattern: str):
        self.ranks, self.pattern, self.hash = ranks, pattern, PerfectHash(ranks)
        self._ready = False

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "hash": self.hash, "_ready": False}

    def _prepare(self) -> None:
        self.split = Splitter(self.pattern)
        rank_of = {x: i for i, x in enumerate(self.ranks)}
        self.byte_id = [rank_of[bytes([b])] for b in range(256)]
        #: (left id << 32 | right id) -> id of the joined entry, for every way to halve an entry
        self.pair = {rank_of[x[:k]] << 32 | rank_of[x[k:]]: i for i, x in enumerate(self.ranks)
                     for k in range(1, len(x)) if x[:k] in rank_of and x[k:] in rank_of}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.text_of = list(map(str, range(len(self.ranks))))
        self._ready = True

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """Ids of a pre-token that isn't a vocabulary entry: merges by a heap over linked symbols."""
        byte_id, pair = self.byte_id, self.pair.get
        ids = [byte_id[b] for b in raw]
        n = len(ids)
        heap = [r << 40 | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := pair(a << 32 | b)) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFFFF
            j, a = after[i], ids[i]
            if a < 0 or j >= n or pair(a << 32 | ids[j]) != top >> 40:
                continue                                   # one of the two symbols has changed
            r = ids[i] = top >> 40
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := pair(r << 32 | ids[k])) is not None:
                    heappush(heap, x << 40 | i)
            k = before[i]
            if k >= 0 and (x := pair(ids[k] << 32 | r)) is not None:
                heappush(heap, x << 40 | k)
        return tuple([x for x in ids if x >= 0])

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        if not self._ready:
            self._prepare()
        for text in texts:
            parts = self.split(text)
            if len(self.memo) > MEMO:
                self.memo.clear()
            memo = self.memo
            new = [x for x in set(parts) if x not in memo]
            if new:
                raw = [x.encode() for x in new]
                for x, b, r in zip(new, raw, self.hash.find(raw)):
                    memo[x] = (r,) if r >= 0 else self.merge(b)
            yield list(chain.from_iterable(map(memo.__getitem__, parts)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.__getitem__, ids))


def encode(docs: DataFrame, ranks: list[bytes], pattern: str, out: str = "ids") -> DataFrame:
    """docs with a column ``out`` (array<int>): the ids of each whole text.

    Null and empty texts have no ids (an empty array). Other columns and repeated rows are kept
    as they are; an existing column ``out`` is replaced. No rows: an empty table.
    """
    kept = [c for c in docs.columns if c != out]
    shared = docs.sparkSession.sparkContext.broadcast(Codec(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for b in batches:
            ids = pa.array(codec.encode([t or "" for t in b.column("text").to_pylist()]), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), ids], names=[*kept, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.mapInArrow(run, f"{fields}, `{out}` array<int>")


def round_trip(docs: DataFrame, ranks: list[bytes], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, then decodes the ids.

    Each row stands alone; a null text is an empty one, repeated rows give repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Codec(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for b in batches:
            n, coded, decoded = [], [], []
            for ids in codec.encode([t or "" for t in b.column("text").to_pylist()]):
                n.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(codec.text_of.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded),
                                              pa.array(decoded)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
