"""Personal data by exact patterns and a character-level BiLSTM-CRF (operator 5).

Base spans (email, ip, card, phone) are exact: the leftmost non-overlapping matches of each kind's
pattern that pass the kind's check. The network adds spans that the patterns miss (other
separators, no plus sign, spelt-out signs). It is a bidirectional LSTM over characters with CRF
transitions between the tags O, B-kind and I-kind, trained in numpy.

Training data: windows around base spans and other digits of at most ``TRAIN_DOCS`` documents (the
ones with the smallest hash of each kind, found over all texts, and of those without a span), with the base spans as labels; for each base span also a rewritten
one (digits redrawn, separators changed), whose place is known. The model is some 50 KB and broadcast.

Every one of these kinds holds a digit, an at sign or a spelt-out one, so the network reads the zones
within ``CONTEXT`` characters of one (or of a spelt-out dot), over whole texts. A zone is cut in windows of ``WINDOW`` characters
that overlap by half; each window is decoded by forward-backward, the windows' tag probabilities
are averaged per character and one Viterbi pass over the whole zone gives its spans. An added span
keeps clear of base spans and of spans that failed their kind's check, and must itself pass the check.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 1500
TRAIN_WINDOWS = 3000
WINDOW = 64
CONTEXT = 32
EMBED, HIDDEN = 12, 20
BATCH, STEPS = 64, 400
CERTAIN = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
# The next three equal the plain patterns; the look-behind and the possessive repeats only spare
# starts inside a run of digits, which cannot match where the run's first digit did not.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
#: Where added spans can be: also at the words ``at`` and ``dot``, in brackets or not.
_SIGN = re.compile(r"[0-9@]|\b(?:at|dot)\b", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """The pattern's matches, found from their at signs: the local part is the run before the sign."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        start = at
        if m:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if m and start < at:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    return 16 <= len(d := _digits(s)) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) of the base spans in the order of KINDS, and the matches that failed their check."""
    if not _TRIGGER.search(text):
        return [], []
    good = [("email", s, e) for s, e in emails(text)]
    failed = []
    for kind, pattern, ok in (("ip", _IP, _ip_ok), ("card", _CARD, _card_ok), ("phone", _PHONE, _phone_ok)):
        for m in pattern.finditer(text):
            if ok(m[0]):
                good.append((kind, *m.span()))
            elif kind != "card" or len(_digits(m[0])) >= 13:
                failed.append(m.span())
    return good, failed


# ---- the network -------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)                                   # O, then B and I of each kind


def _codes(text: str) -> np.ndarray:
    """A small alphabet: printable ASCII, line breaks, other letters, the rest, and 0 for padding."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where((c >= 32) & (c < 127), c - 30, np.where(c == 10, 1, np.where(c >= 0xC0, 97, 98)))


ALPHABET = 99


def _lstm(x: np.ndarray, p: dict, d: str) -> tuple[np.ndarray, tuple]:
    """States of one direction, for x of shape (steps, windows, EMBED); the cache is for training."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    out, cache = np.empty((steps, n, HIDDEN), x.dtype), []
    pre = x @ p[d + "x"] + p[d + "b"]
    for t in range(steps):
        z = pre[t] + h @ p[d + "h"]
        gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, last = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        cache.append((i, f, o, g, before, tc, last))
    return out, (x, cache)


def _lstm_back(dout: np.ndarray, saved: tuple, p: dict, d: str, grads: dict) -> np.ndarray:
    x, cache = saved
    steps, n, _ = x.shape
    dz_all = np.empty((steps, n, 4 * HIDDEN), x.dtype)
    dh, dc = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, last = cache[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dz_all[t] = dz
        grads[d + "h"] += last.T @ dz
        dh, dc = dz @ p[d + "h"].T, dc * f
    grads[d + "x"] += np.tensordot(x, dz_all, ([0, 1], [0, 1]))
    grads[d + "b"] += dz_all.sum(axis=(0, 1))
    return dz_all @ p[d + "x"].T


def _marginals(e: np.ndarray, trans: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRF forward-backward. e: (steps, windows, TAGS), on: (steps, windows), False behind a window's end."""
    steps, n, k = e.shape
    local = np.exp(e - e.max(axis=2, keepdims=True))
    local[~on] = 1.0
    step, alpha = np.exp(trans), np.empty_like(local)
    now = local[0] / local[0].sum(axis=1, keepdims=True)
    alpha[0] = now
    for t in range(1, steps):
        nxt = (now @ step) * local[t]
        nxt /= nxt.sum(axis=1, keepdims=True)
        now = np.where(on[t][:, None], nxt, now)
        alpha[t] = now
    gamma, pairs = np.empty_like(local), np.zeros((k, k), e.dtype)
    back = np.ones((n, k), e.dtype)
    gamma[-1] = alpha[-1]
    for t in range(steps - 2, -1, -1):
        after = local[t + 1] * back
        got = after @ step.T
        joint = alpha[t][:, :, None] * step[None] * after[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += joint[on[t + 1]].sum(axis=0)
        got /= got.sum(axis=1, keepdims=True)
        back = np.where(on[t + 1][:, None], got, back)
        g = alpha[t] * back
        gamma[t] = g / g.sum(axis=1, keepdims=True)
    return gamma, pairs


def _new(rng: np.random.Generator) -> dict:
    p = {"emb": rng.normal(0, 0.3, (ALPHABET, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)),
         "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
    for d in "lr":
        p[d + "x"] = rng.normal(0, 0.25, (EMBED, 4 * HIDDEN))
        p[d + "h"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        p[d + "b"] = np.zeros(4 * HIDDEN)
        p[d + "b"][HIDDEN:2 * HIDDEN] = 1.0
    return {k: v.astype(np.float32) for k, v in p.items()}


def _emissions(codes: np.ndarray, p: dict) -> tuple[np.ndarray, tuple]:
    x = p["emb"][codes]                                     # codes: (steps, windows)
    left, a = _lstm(x, p, "l")
    right, b = _lstm(x[::-1], p, "r")
    both = np.concatenate([left, right[::-1]], axis=2)
    return both @ p["out"] + p["bias"], (both, a, b)


def fit(windows: list[tuple[str, list[tuple[str, int, int]]]], seed: int = 11) -> dict:
    """Parameters from (text of at most WINDOW characters, spans in it); Adam on the CRF likelihood."""
    rng = np.random.default_rng(seed)
    p = _new(rng)
    codes, tags = np.zeros((WINDOW, len(windows)), np.int64), np.zeros((WINDOW, len(windows)), np.int64)
    for w, (text, spans) in enumerate(windows):
        codes[:len(text), w] = _codes(text)
        for kind, s, e in spans:
            tags[max(s, 0):e, w] = 2 + 2 * KINDS.index(kind)
            if s >= 0:
                tags[s, w] -= 1
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order: list[int] = []
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = [*order, *rng.permutation(len(windows)).tolist()]
        pick, order = np.asarray(order[:BATCH]), order[BATCH:]
        x, y = codes[:, pick], tags[:, pick]
        on = x > 0
        e, (both, a, b) = _emissions(x, p)
        gamma, pairs = _marginals(e, p["trans"], on)
        de = gamma
        de[np.arange(WINDOW)[:, None], np.arange(len(pick))[None, :], y] -= 1
        de[~on] = 0
        de /= len(pick)
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        seen = np.zeros_like(p["trans"])
        both_on = on[1:]
        np.add.at(seen, (y[:-1][both_on], y[1:][both_on]), 1)
        grads["trans"] = (pairs - seen) / len(pick)
        grads["out"] = np.tensordot(both, de, ([0, 1], [0, 1]))
        grads["bias"] = de.sum(axis=(0, 1))
        dboth = de @ p["out"].T
        dx = _lstm_back(dboth[:, :, :HIDDEN], a, p, "l", grads)
        dx = dx + _lstm_back(dboth[::-1, :, HIDDEN:], b, p, "r", grads)[::-1]
        flat = np.zeros((x.size, ALPHABET), np.float32)
        flat[np.arange(x.size), x.ravel()] = 1
        grads["emb"] += flat.T @ dx.reshape(-1, EMBED)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            p[k] -= (0.01 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def _rewritten(text: str, span: tuple[str, int, int], rng: np.random.Generator) -> tuple[str, tuple[str, int, int]]:
    """The text with one span written another way, and the span's new place."""
    kind, s, e = span
    old = text[s:e]
    draw = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    if kind == "email":
        at = (" at ", "[at]", " [at] ", "(at)", "@")[rng.integers(5)]
        dot = (" dot ", "[dot]", ".", ".")[rng.integers(4)]
        local, _, domain = old.partition("@")
        local = local.replace(".", dot) if rng.random() < 0.5 else local
        new = local + at + domain.replace(".", dot)
    elif kind == "ip":
        new = ".".join(str(x) for x in rng.integers(0, 256, 4)) + (":" + draw(4) if rng.random() < 0.3 else "")
    elif kind == "card":
        d = draw(15)
        d = next(d + str(c) for c in range(10) if luhn(d + str(c)))
        sep = ("", " ", "-", ".", "/", "  ")[rng.integers(6)]
        new = sep.join(d[i:i + 4] for i in range(0, 16, 4))
    else:
        a, b, c = draw(3), draw(3), draw(4)
        new = (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{draw(1)} {a} {b} {c}", f"+{draw(1)} ({a}) {b}-{c}")[rng.integers(5)]
    return text[:s] + new + text[e:], (kind, s, s + len(new))


def training_windows(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows with a base span, rewritten spans, and windows around other digits, at signs and spelt-out signs."""
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    out = []

    def window(text: str, spans: list, s: int, e: int) -> None:
        lo = max(0, s - int(rng.integers(4, max(5, WINDOW - (e - s)))))
        cut = text[lo:lo + WINDOW]
        out.append((cut, [(k, a - lo, min(b - lo, len(cut))) for k, a, b in spans if b > lo and a < lo + len(cut)]))

    spans, _ = base_spans(text)
    for span in spans:
        window(text, spans, span[1], span[2])
        new, moved = _rewritten(text[:span[2] + WINDOW], span, rng)
        near = [x for x in spans if x[2] <= span[1] and x[2] > span[1] - WINDOW]
        window(new, [*near, moved], moved[1], moved[2])
    others = [m.start() for m in _SIGN.finditer(text) if all(not (s - 1 <= m.start() <= e) for _, s, e in spans)]
    for at in others[::max(1, len(others) // 3)][:3]:
        window(text, spans, at, at + 1)
    return out


class Finder:
    """Decodes texts with trained parameters."""

    def __init__(self, params: dict | None):
        self.p = params

    def zones(self, text: str) -> list[tuple[int, int]]:
        out: list[list[int]] = []
        for m in _SIGN.finditer(text):
            lo, hi = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
            if out and lo <= out[-1][1]:
                out[-1][1] = hi
            else:
                out.append([lo, hi])
        return [tuple(z) for z in out]

    def tag_probabilities(self, pieces: list[str]) -> list[np.ndarray]:
        """Per piece, (characters, TAGS): the mean of the overlapping windows' probabilities."""
        codes, where = [], []
        for i, piece in enumerate(pieces):
            c = _codes(piece)
            for lo in range(0, max(1, len(c) - WINDOW // 2), WINDOW // 2):
                w = c[lo:lo + WINDOW]
                codes.append(np.concatenate([w, np.zeros(WINDOW - len(w), np.int64)]))
                where.append((i, lo, len(w)))
        sums = [np.zeros((len(x), TAGS)) for x in pieces]
        times = [np.zeros((len(x), 1)) for x in pieces]
        for start in range(0, len(codes), 1024):
            x = np.stack(codes[start:start + 1024], axis=1)
            e, _ = _emissions(x, self.p)
            gamma, _ = _marginals(e, self.p["trans"], x > 0)
            for j, (i, lo, n) in enumerate(where[start:start + 1024]):
                sums[i][lo:lo + n] += gamma[:n, j]
                times[i][lo:lo + n] += 1
        return [s / t for s, t in zip(sums, times)]

    def viterbi(self, prob: np.ndarray) -> np.ndarray:
        """Best tag sequence of a whole zone under the averaged probabilities; I-kind follows B or I of its kind."""
        step = np.zeros((TAGS, TAGS))
        for k in range(len(KINDS)):
            step[:, 2 + 2 * k] = -np.inf
            step[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
        score = np.log(prob + 1e-9)
        score[0, 2::2] = -np.inf
        best, back = score[0], np.zeros(prob.shape, np.int64)
        for t in range(1, len(prob)):
            all_ = best[:, None] + step
            back[t] = all_.argmax(axis=0)
            best = all_.max(axis=0) + score[t]
        tags = np.zeros(len(prob), np.int64)
        tags[-1] = best.argmax()
        for t in range(len(prob) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags

    def find(self, texts: list[str]) -> list[tuple[list, list]]:
        """Per text: base spans, and added spans."""
        base = [base_spans(t) for t in texts]
        zones = [(i, lo, hi) for i, t in enumerate(texts) for lo, hi in self.zones(t)] if self.p else []
        added: list[list] = [[] for _ in texts]
        for at in range(0, len(zones), 2048):
            group = zones[at:at + 2048]
            for (i, lo, hi), prob in zip(group, self.tag_probabilities([texts[i][lo:hi] for i, lo, hi in group])):
                if (prob[:, 0] > 0.5).all():
                    continue
                added[i] += [(k, s + lo, e + lo) for k, s, e in self._spans(texts[i][lo:hi], prob)]
        out = []
        for (good, failed), more in zip(base, added):
            taken = [(s, e) for _, s, e in good] + failed
            out.append((good, [x for x in more if all(x[2] <= s or x[1] >= e for s, e in taken)]))
        return out

    def _spans(self, text: str, prob: np.ndarray) -> list[tuple[str, int, int]]:
        tags, out, i = self.viterbi(prob), [], 0
        while i < len(tags):
            if tags[i] == 0 or tags[i] % 2 == 0:
                i += 1
                continue
            kind, end = (int(tags[i]) - 1) // 2, i + 1
            while end < len(tags) and tags[end] == 2 + 2 * kind:
                end += 1
            sure = prob[i:end, [1 + 2 * kind, 2 + 2 * kind]].sum(axis=1).mean()
            if sure >= CERTAIN and _plausible(KINDS[kind], text[i:end]):
                out.append((KINDS[kind], i, end))
            i = end
        return out


def _plausible(kind: str, s: str) -> bool:
    d = _digits(s)
    if kind == "email":
        return bool(re.search(r"@|\bat\b", s, re.IGNORECASE)) and bool(re.search(r"\.|\bdot\b", s, re.IGNORECASE))
    if kind == "ip":
        m = re.match(r"[0-9]+(\.[0-9]+){3}(?![0-9.])", s)
        return bool(m) and _ip_ok(m[0])
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return _phone_ok(s) and not re.search(r"[A-Za-z]", s)


def _in_turn(tagged: DataFrame, n: int) -> list[int]:
    """At most ``n`` keys of (key, kinds): the kinds take turns, smallest key first; rows of no kind have every
    second turn. Empty where no row is of a kind."""
    held = [[r.key for r in tagged.filter(on).select("key").distinct().orderBy("key").limit(n).collect()]
            for on in (*(F.array_contains("kinds", k) for k in KINDS), F.size("kinds") == 0)]
    turns = sorted((i * (2 if k == len(KINDS) else 1), key) for k, keys in enumerate(held) for i, key in enumerate(keys))
    return list(dict.fromkeys(key for _, key in turns))[:n] if any(held[:-1]) else []


def train(docs: DataFrame, most_docs: int = TRAIN_DOCS, most_windows: int = TRAIN_WINDOWS) -> dict | None:
    """Parameters from at most ``most_docs`` texts, of every kind that any text holds; None without a base span.

    One pass over all texts finds their kinds. The windows are cut where the texts are; the driver
    gets hashes and the chosen windows only.
    """
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = [sorted({k for k, _, _ in base_spans(t)[0]}) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(kinds, pa.list_(pa.string()))], names=["key", "kinds"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, json.dumps(s), sorted({k for k, _, _ in s})) for t in b.column("text").to_pylist() for w, s in training_windows(t)]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "spans", "kinds"])

    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "personal")
    texts = docs.filter(F.col("text").rlike(r"(?i)[0-9@]|\b(?:at|dot)\b")).select(F.xxhash64("text").alias("key"), "text")
    chosen = (lambda keys: F.broadcast(spark.createDataFrame([(k,) for k in keys], "key long")))
    tagged = scratch.save(texts.mapInArrow(tag, "key long, kinds array<string>"))
    keys = _in_turn(tagged, most_docs)
    scratch.drop(tagged)
    if not keys:
        return None
    sample = texts.join(chosen(keys), "key", "left_semi").dropDuplicates(["key"]).select("text")
    windows = scratch.save(sample.mapInArrow(cut, "w string, spans string, kinds array<string>")
                           .withColumn("key", F.xxhash64("w", "spans")).dropDuplicates(["key"]))
    rows = windows.join(chosen(_in_turn(windows, most_windows)), "key", "left_semi").orderBy("w", "spans").collect()
    scratch.drop(windows)
    return fit([(r.w, [tuple(x) for x in json.loads(r.spans)]) for r in rows])


def personal_data(docs: DataFrame, most_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added.

    Spans are ``kind:start:end`` in code points, by kind and start. Null and empty texts have no
    spans; repeated rows repeat. Without a base span anywhere there is nothing to learn from and
    only base spans are given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Finder(train(docs, most_docs)))

    def joined(spans: list) -> str:
        order = sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))
        return ",".join(f"{k}:{s}:{e}" for k, s, e in order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shared.value.find([t or "" for t in b.column("text").to_pylist()])
            counts = [pa.array([sum(x[0] == k for x in base) for base, _ in found], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *counts, pa.array(digest, pa.string()),
                 pa.array([joined(base + more) for base, more in found], pa.string()),
                 pa.array([len(more) for _, more in found], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")
