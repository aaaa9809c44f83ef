"""Token counts by heap-and-linked-list byte-pair merging (operator 13).

A text is cut at the tokenizer's added tokens (one token each), the parts are cut in pre-tokens,
and a pre-token's bytes are merged: a heap holds (rank, position) of the adjacent pairs of a
linked list, the lowest rank is popped first, the leftmost among equals, stale entries are
skipped. A merge makes two symbols one, so the count is the bytes less the merges; ids are
never put together.

Counts of recent pre-tokens are kept in a memo that belongs to one task and is emptied at
``MEMO_BYTES``; it only saves time. A pre-token of any length is merged whole, in time n log n.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm.bpe import Splitter

MEMO_BYTES = 48 << 20
#: What an entry of the memo takes besides its characters: string, dict slot.
_ENTRY = 160


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Merges:
    """The merge table of a byte-level BPE tokenizer file.

    Raises ValueError for settings that would change counts and that this class doesn't apply.
    """

    def __init__(self, spec: dict, pattern: str):
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges")
                or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")):
            raise ValueError("not a plain byte-level BPE tokenizer")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("an added token has matching options")
        vocab = model["vocab"]
        self.pattern = pattern
        self.added = sorted((t["content"] for t in added), key=len, reverse=True)
        self.byte_id = [vocab[c] for c in byte_letters()]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id << 32 | right id) -> rank, and the id that each rank makes
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]

    @classmethod
    def load(cls, path: str, pattern: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f), pattern)

    def count(self, raw: bytes) -> int:
        """Tokens of one pre-token."""
        rank, made, byte_id = self.rank.get, self.made, self.byte_id
        ids = [byte_id[b] for b in raw]
        n = left = len(ids)
        heap = [r << 40 | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 32 | b)) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFFFF, top >> 40
            j, a = after[i], ids[i]
            if a < 0 or j >= n or rank(a << 32 | ids[j]) != r:
                continue                                   # one of the two symbols has changed
            left -= 1
            x = ids[i] = made[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(x << 32 | ids[k])) is not None:
                    heappush(heap, r << 40 | i)
            k = before[i]
            if k >= 0 and (r := rank(ids[k] << 32 | x)) is not None:
                heappush(heap, r << 40 | k)
        return left

    def counts(self, texts: Iterator[list[str | None]]) -> Iterator[list[int]]:
        """Tokens of each text, list by list."""
        split = Splitter(self.pattern)
        parts_of = re.compile("|".join(map(re.escape, self.added))).split if self.added else lambda t: [t]
        memo: dict[str, int] = {}
        room = MEMO_BYTES
        for group in texts:
            out = []
            for text in group:
                parts = parts_of(text or "")
                total = len(parts) - 1
                for part in parts:
                    words = split(part)
                    new = set(words).difference(memo)
                    if new:
                        room -= sum(map(len, new)) + _ENTRY * len(new)
                        if room < 0:                       # empty the memo before it outgrows its bytes
                            memo.clear()
                            new = set(words)
                            room = MEMO_BYTES - sum(map(len, new)) - _ENTRY * len(new)
                        for w in new:
                            memo[w] = self.count(w.encode())
                    total += sum(map(memo.__getitem__, words))
                out.append(total)
            yield out


def n_tokens(spark: SparkSession, text: str | Column, merges: Merges) -> Column:
    """The number of tokens (long) of each whole text, without begin and end tokens; null and empty texts: 0.

    A string of an added token inside a text counts as that token. Each row stands alone, so
    repeated rows, clashing column names and empty tables need no care. The merge table is
    broadcast; the tokenizer's file bounds it.
    """
    shared = spark.sparkContext.broadcast(merges)

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for out in shared.value.counts(b.to_pylist() for b in batches):
            yield pa.array(out, pa.int64())

    return run(text)


def count_report(docs: DataFrame, merges: Merges, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs; a null text is an empty one."""
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          n_tokens(docs.sparkSession, "text", merges).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
