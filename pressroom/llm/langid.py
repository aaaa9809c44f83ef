"""Language identification with a linear-chain conditional random field over words (operator 9).

A document's words (runs of letters, lower-cased) form a chain; each word has a hidden language.
Its features are the character n-grams of the word between boundary marks (so prefixes and
suffixes are n-grams of their own), the whole word, and its entry in a lexicon of frequent training
words. Feature weights and the language-to-language transitions are learned together by the CRF's
likelihood; forward-backward gives each word's language probabilities. A document's language is
the one with the largest mean probability over its words, the score is that mean.

Training reads at most ``per_lang`` labelled documents of each language (the ones with the smallest
hash of their values), cuts their lines into chains and splices chains of different languages, so
that the transitions see code-switching. The model is a few megabytes and is broadcast.
Prediction sees texts alone: the other columns stay in Spark. The words of some megabytes of text
become numbers of a word table at a time; chains of about the same length advance together, and
every chain is whole. The word table is bounded in words and characters and only saves time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain as flat_chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.names import unused
from pressroom.llm.sample import smallest

PER_LANG = 250
BITS = 17
GRAMS = 4
STEPS = 30
CHAIN = 64
#: Words whose probabilities are held together, words that wait as numbers, characters that are split at once.
WORDS_AT_ONCE = 150_000
WORDS_WAITING = 4_000_000
CHARS_AT_ONCE = 1 << 20
#: Words and characters of the word table, beyond which it is emptied.
MEMO, MEMO_CHARS = 200_000, 8 << 20
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+").findall


class Features:
    """Word -> hashed feature rows. ``lexicon``: word -> its language's number."""

    def __init__(self, lexicon: dict[str, int], langs: int, bits: int = BITS):
        self.lexicon, self.none, self.mask = lexicon, langs, (1 << bits) - 1
        self.size = (1 << bits) + langs + 1

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, start of each word's run)."""
        marked = "".join(f"\x02{w}\x03" for w in words)
        code = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(lens)
        left = np.repeat(ends, lens) - np.arange(len(code))         # characters to the end of the word
        word = np.repeat(np.arange(len(words)), lens)
        mul, salt = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
        feats, owners = [], []
        h = np.zeros(len(code), np.uint64)
        for n in range(1, GRAMS + 1):
            shifted = np.concatenate([code[n - 1:], np.zeros(n - 1, np.uint64)])
            h = (h ^ shifted) * mul + salt
            on = left >= n
            feats.append(self._slot(h[on]))
            owners.append(word[on])
        at = np.arange(len(code)) - (ends - lens)[word]
        power = np.cumprod(np.full(int(lens.max()), mul))
        feats.append(self._slot(np.add.reduceat((code + salt) * power[at], ends - lens)))
        owners.append(np.arange(len(words)))
        lex = np.fromiter((self.lexicon.get(w, self.none) for w in words), np.int64, len(words))
        feats.append(lex + self.mask + 1)
        owners.append(np.arange(len(words)))
        feat, owner = np.concatenate(feats), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return feat[order], np.searchsorted(owner[order], np.arange(len(words)))

    def _slot(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h >> np.uint64(32)) & np.uint64(self.mask)).astype(np.int64)


def posteriors(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once.

    ``scores``: one row of language scores per word, chain after chain. Returns the words' language
    probabilities and the expected transition counts.
    """
    k = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max())
    active = len(lengths) - np.searchsorted(lengths[order][::-1], np.arange(longest), side="right")
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(trans)
    alpha = np.empty_like(local)
    now = np.full((len(lengths), k), 1.0 / k)
    for t in range(longest):
        rows = starts[:active[t]] + t
        now = (now[:active[t]] @ step if t else now) * local[rows]
        now /= now.sum(axis=1, keepdims=True)
        alpha[rows] = now
    gamma = np.empty_like(local)
    pairs = np.zeros((k, k))
    back = np.zeros((0, k))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        if t + 1 < longest and active[t + 1]:
            m = active[t + 1]
            after = local[rows[:m] + 1] * back
            before = np.concatenate([after @ step.T, np.ones((n - m, k))])
            joint = alpha[rows[:m]].T @ (after / ((alpha[rows[:m]] @ step) * after).sum(axis=1, keepdims=True))
            pairs += joint * step
        else:
            before = np.ones((n, k))
        back = before / before.sum(axis=1, keepdims=True)
        g = alpha[rows] * back
        gamma[rows] = g / g.sum(axis=1, keepdims=True)
    return gamma, pairs


class Model:
    """Languages, feature weights and transitions."""

    def __init__(self, langs: list[str], features: Features, weights: np.ndarray, trans: np.ndarray):
        self.langs, self.features, self.weights, self.trans = langs, features, weights, trans
        self.memo: dict[str, int] = {}
        self.table = np.zeros((0, len(langs)), np.float32)
        self.chars = 0

    def __getstate__(self):
        return {**self.__dict__, "memo": {}, "table": self.table[:0], "chars": 0}

    def scores(self, words: list[str]) -> np.ndarray:
        feat, start = self.features.rows(words)
        return np.add.reduceat(self.weights[feat], start, axis=0)

    def _index(self, docs: list[list[str]]) -> None:
        """Take the documents' new words into the word table."""
        new = list(set(flat_chain.from_iterable(docs)).difference(self.memo))
        parts = [self.table]
        for i in range(0, len(new), 20_000):
            parts.append(self.scores(new[i:i + 20_000]).astype(np.float32))
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
        self.chars += sum(map(len, new))
        self.table = np.concatenate(parts)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each whole text; ``und`` and 0 without a letter or without a model."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and certainty: the mean over the words of the largest probability of each."""
        lang, score, sure = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        waiting: list[tuple[int, np.ndarray]] = []              # a text's place and the numbers of its words

        def decide() -> None:
            waiting.sort(key=lambda x: len(x[1]))
            at = 0
            while at < len(waiting):
                end, n = at + 1, len(waiting[at][1])
                while end < len(waiting) and n + len(waiting[end][1]) <= WORDS_AT_ONCE:
                    n += len(waiting[end][1])
                    end += 1
                own = [x for _, x in waiting[at:end]]
                lengths = np.fromiter(map(len, own), np.int64, len(own))
                gamma, _ = posteriors(self.table[np.concatenate(own)].astype(np.float64), lengths, self.trans)
                first = np.cumsum(lengths) - lengths
                mean = np.add.reduceat(gamma, first, axis=0) / lengths[:, None]
                best = mean.argmax(axis=1)
                for (i, _), b, m, c in zip(waiting[at:end], best, mean, np.add.reduceat(gamma.max(axis=1), first) / lengths):
                    lang[i], score[i], sure[i] = self.langs[b], min(1.0, float(m[b])), min(1.0, float(c))
                at = end
            waiting.clear()

        start = held = 0
        while start < len(texts) and self.langs:
            end, size = start, 0
            while end < len(texts) and size < CHARS_AT_ONCE:
                size += len(texts[end] or "")
                end += 1
            words = [[w for w in _WORD(t.lower()) if w.isalpha() or any(map(str.isalpha, w))] if t else [] for t in texts[start:end]]
            if len(self.memo) > MEMO or self.chars > MEMO_CHARS:
                decide()                                        # the numbers are of the table that goes
                held = 0
                self.memo, self.table, self.chars = {}, self.table[:0], 0
            self._index(words)
            for i, w in enumerate(words, start):
                if w:
                    waiting.append((i, np.fromiter(map(self.memo.__getitem__, w), np.int32, len(w))))
                    held += len(w)
            if held >= WORDS_WAITING:
                decide()
                held = 0
            start = end
        decide()
        return lang, score, sure


def fit(texts: list[str], labels: list[str], steps: int = STEPS, seed: int = 5) -> Model:
    """A model of labelled texts: likelihood ascent with per-weight step sizes and a quadratic penalty."""
    langs = sorted(set(labels))
    k = len(langs)
    chains: list[list[list[str]]] = [[] for _ in langs]
    counts = [Counter() for _ in langs]
    for text, label in zip(texts, labels):
        y = langs.index(label)
        words = [w for w in _WORD(text.lower()) if any(map(str.isalpha, w))]
        counts[y].update(words)
        chains[y] += [words[i:i + CHAIN] for i in range(0, len(words), CHAIN)]
    totals = [max(1, sum(c.values())) for c in counts]
    lexicon = {}
    for w in {w for c in counts for w, n in c.items() if n >= 3}:
        lexicon[w] = int(np.argmax([c[w] / t for c, t in zip(counts, totals)]))
    features = Features(lexicon, k)
    # every fourth chain is spliced to one of another language
    rng = np.random.default_rng(seed)
    pool = [(y, c) for y, own in enumerate(chains) for c in own]
    order = rng.permutation(len(pool))
    words, ys, lengths = [], [], []
    i = 0
    while i < len(pool):
        join = 2 if i % 4 == 0 and i + 1 < len(pool) else 1
        parts = [pool[j] for j in order[i:i + join]]
        if join == 2:
            parts = [(y, c[:max(1, len(c) // 2)]) for y, c in parts]
        for y, c in parts:
            words += c
            ys += [y] * len(c)
        lengths.append(sum(len(c) for _, c in parts))
        i += join
    weights, trans = np.zeros((features.size, k)), np.zeros((k, k))
    if not words:
        return Model(langs, features, weights.astype(np.float32), trans)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
    y, lengths = np.asarray(ys), np.asarray(lengths)
    feat, start = features.rows(list(vocab))
    owner = np.repeat(np.arange(len(vocab)), np.diff(np.append(start, len(feat))))
    by_feat = np.argsort(feat, kind="stable")
    used, cut = np.unique(feat[by_feat], return_index=True)
    owner = owner[by_feat]
    first = np.zeros(len(y), bool)
    first[np.cumsum(lengths) - lengths] = True
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:-1][~first[1:]], y[1:][~first[1:]]), 1)
    want = np.zeros((len(vocab), k))
    np.add.at(want, (at, y), 1)
    w_sq, t_sq = np.full((len(used), k), 1e-8), np.full((k, k), 1e-8)
    for _ in range(steps):
        scores = np.add.reduceat(weights[feat], start, axis=0)
        gamma, pairs = posteriors(scores[at], lengths, trans)
        got = np.stack([np.bincount(at, gamma[:, j], len(vocab)) for j in range(k)], axis=1)
        grad = np.add.reduceat((want - got)[owner], cut, axis=0) - 0.5 * weights[used]
        w_sq += grad * grad
        weights[used] += 0.1 * grad / np.sqrt(w_sq)
        grad = seen - pairs - 0.5 * trans
        t_sq += grad * grad
        trans += 0.2 * grad / np.sqrt(t_sq)
    return Model(langs, features, weights.astype(np.float32), trans)


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fits on at most ``per_lang`` documents of each label; those whose crc32(doc_id) mod 5 is 0 are held out."""
    rows = smallest(docs.filter(~_held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
                    .select("doc_id", "lang", "text"), per_lang, per="lang").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id, r.text))
    return fit([r.text for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score", sure: str = "certainty") -> DataFrame:
    """docs with the columns ``lang``, ``score`` and ``sure``, from the text alone; existing ones are replaced."""
    (judged,), names = unused(docs, "_judged"), [lang, score, sure]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double,sure:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            langs, scores, certain = shared.value.judge(b.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(certain, pa.float64())],
                                             names=["lang", "score", "sure"])

    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    return docs.withColumn(judged, judge("text")).select(
        *(F.col(f"`{c}`") for c in kept), *(F.col(f"{judged}.{f}").alias(n) for f, n in zip(("lang", "score", "sure"), names)))


def language_report(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score per document.

    A null text or one without letters is ``und`` with score 0, as is everything when no row has a
    label. A null doc_id is never learned from and counts as not held out. Repeated rows repeat.
    """
    model = train(docs, per_lang)
    return identify(docs.select("doc_id", "text", _held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, per_lang: int = PER_LANG, least: float = 0.5) -> DataFrame:
    """docs without those of no language: ``und``, or the words' languages are less certain than ``least``.

    The certainty is the mean over the words of each word's largest probability, so a document in
    several languages stays. Without a label to learn from nothing can be judged and all stay. Columns stay.
    """
    model = train(docs, per_lang)
    if not model.langs:
        return docs
    lang, score, sure = unused(docs, "_lang", "_score", "_sure")
    rows = identify(docs, model, lang, score, sure)
    return rows.filter((F.col(lang) != UNKNOWN) & (F.col(sure) >= least)).select(*docs.columns)
