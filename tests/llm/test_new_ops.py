"""Manifest, periodic runs and token counts on small tables with every awkward row, against brute force."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from pressroom.llm import merkle, runs, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, grp string, pos int, r int"


def make(spark, rows):
    """A documents table with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None or i == 3 else len(t), "x", "y", 7, 8)
                                  for i, t, lang, s in rows], SCHEMA)


def words(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    base = words(rng, 90)
    out = [(0, None, "en", "a"), (1, "", None, None), (2, " \t\r\n", "en", "a"), (3, "one", "en", "b"), (4, base, "en", "b"),
           (4, base, "en", "b"), (4, "another text of document four", "en", "b"), (None, base, "en", "a"), (None, None, None, None),
           (7, "a b " * 40 + "c c c c c c c", "fr", "c"), (8, words(rng, 30000, "ab"), "en", "b"), (9, "é" * 30000, "fr", "c"),
           (10, "\x1c\x85   　 x\x00y \U0001F600 \x1f", "", "c"), (11, "<|endoftext|> it's<|endoftext|><|endoftext|>", "de", "c"),
           (12, "na " * 5, "de", "c"), (13, "na " * 6, "de", "c"), (14, ("x y z " * 6 + "x q ") * 5 + "x", "de", "c")]
    for i in range(20, 130):
        n, tiny = rng.randint(1, 60), rng.choice(["ab", "abcdefgh"])
        out.append((i, "\n ".join(rng.choice(tiny) for _ in range(n)), rng.choice(["en", "en", "en", "fr", None, "é", "z"]), rng.choice("abc")))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows)


# ---- operator 11

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(fields):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_tree(nodes, fanout):
    """(root, siblings level by level of each node)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs_ = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for w, i in zip(ways, at):
            w.append((runs_[i // fanout][:i % fanout], runs_[i // fanout][i % fanout + 1:]))
        nodes, at = [h(*r) for r in runs_], [i // fanout for i in at]
    return (nodes[0] if nodes else None), ways


def plain_manifest(table, fanout):
    groups = {}
    for r in table:
        groups.setdefault(r["lang"], []).append((r, plain_leaf([r[f] for f in merkle.FIELDS])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        subs[g] = plain_tree([leaf for _, leaf in groups[g]], fanout)
    root, over = plain_tree([subs[g][0] for g in order], fanout)
    out = []
    for g, upper in zip(order, over):
        for (r, leaf), way in zip(groups[g], subs[g][1]):
            steps = way + upper
            bad = dict(r.asDict())
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and bad["n_chars"] is not None:
                bad["n_chars"] += 1
            node = plain_leaf([bad[f] for f in merkle.FIELDS])
            for left, right in steps:
                node = h(*left, node, *right)
            out.append((str(r["doc_id"]), leaf, subs[g][0], root, h(*(s for left, right in steps for s in left + right)),
                        node, node == root))
    return sorted(out)


COLUMNS = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(df):
    return sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in df.collect())


def test_manifest(docs):
    got = rows_of(merkle.manifest_report(docs))
    want = plain_manifest(docs.collect(), 2)
    assert got == want
    assert {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("shape,left", [(merkle.Shape(2, 1), 17), (merkle.Shape(2, 2), 65), (merkle.Shape(3, 2), None), (merkle.Shape(4, 1), 50)])
def test_manifest_in_many_passes(docs, rows, spark, shape, left):
    some = make(spark, rows[:left])
    got = merkle.manifest(some, "doc_id", "lang", merkle.FIELDS, shape=shape)
    got = got.withColumn("proof_sha256", merkle.proof_digest(got.proof)).withColumn("back", merkle.fold(got.leaf, got.proof))
    found = got.collect()
    want = plain_manifest(some.collect(), shape.fanout)
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in found) == [w[:5] for w in want]
    assert all(r.back == r.root for r in found)
    by_lang = {}
    for r in found:
        by_lang.setdefault(r.lang, []).append(r.pos)
    assert all(sorted(p) == list(range(len(p))) for p in by_lang.values())


def test_manifest_of_few_rows(spark, rows):
    assert merkle.manifest_report(make(spark, rows).limit(0)).count() == 0
    for k in (1, 2, 3):
        one = make(spark, rows[:k])
        assert rows_of(merkle.manifest_report(one)) == plain_manifest(one.collect(), 2)
    same = make(spark, [(5, "t", "en", "a")] * 9)
    assert rows_of(merkle.manifest_report(same)) == plain_manifest(same.collect(), 2)


def test_manifest_deals_a_hot_group(docs):
    """No window holds a whole group: they are keyed by partition or block too."""
    plan = merkle.manifest_report(docs)._jdf.queryExecution().executedPlan().toString()
    keys = {m for m in re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan)}
    assert keys and all("blk" in k for k in keys)


# ---- operator 12

def plain_runs(w, least=6, exponent=4):
    n, out = len(w), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(least, exponent * q) and not any(
                    all(w[x] == w[x + d] for x in range(start, start + length - d)) for d in range(1, q) if q % d == 0):
                out.add((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_planted(i, w):
    if i is None or not w:
        return w
    crc = zlib.crc32(str(i).encode())
    if crc % 10:
        return w
    g, n = crc // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]


def plain_report(i, text):
    w = plain_planted(i, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain_runs(w) if len(w) < 5000 else None
    if found is None:
        return None
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(found), *best, math.floor(1000 * best[1] / best[2]) if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


def test_run_report(spark, rows):
    more = [(i, t, None, None) for i, (_, t, _, _) in zip(range(1000, 1400), rows[9:] * 4) if len(t or "") < 5000]
    planted = make(spark, rows + more)
    got = planted.select("doc_id", "text").collect()
    want = sorted(((str(i), *x) for i, t in got if (x := plain_report(i, t)) is not None), key=str)
    report = runs.run_report(planted.filter("text is null or length(text) < 5000 or text like 'é%'"))
    found = sorted(((str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
                    for r in report.collect()), key=str)
    assert found == want
    assert sum(f[1] for f in found) > 50
    assert runs.run_report(planted.limit(0)).count() == 0


def test_runs_of_random_words():
    rng = random.Random(2)
    for k in range(250):
        n = rng.randint(0, 90)
        w = [rng.choice("ab" if k % 2 else "abcd") for _ in range(n)]
        if n > 8:                                            # periodic stretches of every length
            a, p = rng.randrange(n), rng.randint(1, 12)
            w = w[:a] + [w[a + (x - a) % min(p, n - a)] for x in range(a, n)]
        least, exponent = rng.choice([(6, 4), (1, 3), (9, 5)])
        ids = np.array([ord(x) for x in w], np.int64)
        found = runs._by_start_and_period(runs.find_runs(ids, np.full(n, n), least, exponent))
        assert [tuple(r) for r in found.tolist()] == plain_runs(w, least, exponent), w


def test_runs_never_cross_texts():
    got = list(runs.collapse(["a a a", "a a a", "a a a a a a", None, "", "a a a"]))
    assert [own.tolist() for own, _ in got] == [[], [], [[0, 6, 1]], [], [], []]
    assert [left for _, left in got] == ["a a a", "a a a", "a", "", "", "a a a"]
    (own, left), = runs.collapse(["x " * 200_000])           # one very long run
    assert own.tolist() == [[0, 200_000, 1]] and left == "x"


def test_runs_need_three_periods():
    with pytest.raises(ValueError):
        runs.periodic("text", exponent=2)


# ---- operator 13

@pytest.fixture(scope="module")
def merges():
    import public_tokenizers as P
    return tokens.Merges.load(P.path("byte_bpe_50k.json"), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_token_counts(spark, docs, rows, merges, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_report(docs, merges, 512).collect())
    sizes = [(str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in rows]
    assert got == sorted((i, b, n, n > 512) for i, b, n in sizes)
    assert tokens.count_report(docs.limit(0), merges, 512).count() == 0


def test_token_counts_of_every_character(merges, library):
    """Each code point between letters, digits and spaces: the library's pattern has the same classes."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c} 1{c}" for c in chars]
    got = next(merges.counts(iter([texts])))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_token_counts_with_a_small_memo(merges, library, monkeypatch):
    rng = random.Random(3)
    texts = [words(rng, 60, "abcdefgh é'<|>\n") + "<|endoftext|>" for _ in range(60)]
    monkeypatch.setattr(tokens, "MEMO_BYTES", 4000)
    assert [n for group in merges.counts([t] for t in texts) for n in group] == [
        len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_unknown_tokenizer_settings_are_refused(merges):
    spec = {"model": {"type": "Unigram"}, "pre_tokenizer": None, "normalizer": None, "added_tokens": []}
    with pytest.raises(ValueError):
        tokens.Merges(spec, "x")


# ---- operator 3: what its buckets hand on

def plain_removed(texts, window=100):
    first, out = {}, {}
    for i, t in texts:
        for p in range(len(t) - window + 1):
            first.setdefault(t[p:p + window], (i, p))
    for i, t in texts:
        gone = set()
        for p in range(len(t) - window + 1):
            if first[t[p:p + window]] != (i, p):
                gone.update(range(p, p + window))
        out[i] = len(gone)
    return out


def removed(df):
    return {r.doc_id: r.n_removed for r in df.collect()}


def test_repeats_do_not_depend_on_slices_or_batches(spark, monkeypatch):
    from pressroom.llm import suffix
    rng = random.Random(6)
    passage = [words(rng, 60) for _ in range(4)]
    texts = [(i, (words(rng, rng.randint(0, 80)) + rng.choice(passage) + words(rng, rng.randint(0, 80)) + rng.choice(passage)).encode())
             for i in range(40)]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in texts], "doc_id long, text string").repartition(3)
    want = plain_removed(texts)
    assert sum(want.values()) > 5000 and removed(suffix.without_repeats(docs)) == want
    monkeypatch.setattr(suffix, "BUFFER", 150)               # each window lies in one slice
    for _, t in texts[:5]:
        cut = [(at + k, x[k:k + 100]) for at, x in suffix._slices(t) for k in range(len(x) - 99)]
        assert cut == [(k, t[k:k + 100]) for k in range(len(t) - 99)]


def test_a_passage_across_slices_of_a_long_text(spark):
    from pressroom.llm import suffix
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefghijklmnop", k=2 * suffix.BUFFER + 5000))
    at = suffix.BUFFER
    docs = spark.createDataFrame([(1, long), (2, "x" + long[at - 300:at + 333] + "y"), (3, long[2 * at - 50:2 * at + 150])], "doc_id long, text string")
    assert removed(suffix.without_repeats(docs)) == {1: 0, 2: 633, 3: 200}


def test_a_common_anchor_costs_two_entries_a_batch(spark):
    from pressroom.llm import suffix
    rng = random.Random(7)
    phrase = words(rng, 30)[:84]
    texts = [(i, (words(rng, 40) + phrase + words(rng, 40)).encode()) for i in range(400)]
    raw = b"".join(t for _, t in texts)
    ends = np.cumsum([len(t) for _, t in texts])
    doc, l, r, gram, chunk = suffix.anchors(np.frombuffer(raw, np.uint8), ends - [len(t) for _, t in texts], ends)
    places = np.empty(len(l), suffix._PLACE)
    places["did"], places["th"], places["l"], places["r"] = doc, 0, l, r
    keys, where, _ = suffix.suffix_array(suffix._keys(gram, chunk), places)
    few, _, opened = suffix.without_common_anchors(keys, where)
    per_anchor = np.unique(np.frombuffer(few.tobytes(), ">u8")[::2], return_counts=True)[1]
    assert per_anchor.max() == 2 and len(opened) > 300 and len(few) + len(opened) == len(keys)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in texts], "doc_id long, text string").repartition(3)
    assert removed(suffix.without_repeats(docs)) == plain_removed(texts)
