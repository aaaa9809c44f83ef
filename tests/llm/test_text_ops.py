"""Text operators on small tables with every awkward row, against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pressroom.llm import bpe, langid, linededup, mixing, pii, simhash, suffix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, _key string, removed int"


def make(spark, rows):
    """A documents table with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", "y", 7) for i, t, lang, s in rows], SCHEMA)


def words(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = words(rng, 120)
    out = [(0, None, "en", "a"), (1, "", None, None), (2, " \t\r\n", "en", "a"), (3, "one", "en", "b"),
           (4, base, "en", "b"), (5, base, "en", "b"), (6, base + " tail", "en", None), (7, base.upper(), "fr", "c"),
           (8, words(rng, 30000), "en", "b"), (9, "é" * 300, "fr", "c"), (10, "\x00" * 150 + "\U0001F600 z", None, "c"),
           (None, base, "en", "a"), (4, base, "en", "b"), (4, "another text of document four", "en", "b"),
           (11, "mail bob.x@mail.example.com, 10.0.0.256, 10.1.2.3 x +1 (555) 123-4567 y 4111 1111 1111 1111", "en", "a")]
    lines = [words(rng, 9) for _ in range(40)]
    for i in range(20, 60):
        own = rng.choices(lines, k=3) + [words(rng, 8) for _ in range(3)]
        own[0] = own[0][:5] + rng.choice("xyz") + own[0][6:]
        rng.shuffle(own)
        out.append((i, "\n".join(own), rng.choice(["en", "fr"]), rng.choice("abc")))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows)


def test_simhash(spark, rows, docs):
    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = np.array([fp(t) for _, t, _, _ in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    ids = [r[0] for r in rows]
    group = [set(np.nonzero(x)[0]) for x in near]
    for _ in rows:
        group = [set().union(*(group[j] for j in g)) for g in group]
    want = sorted((str(i), f"{int(f):016x}", min(ids[j] for j in g if ids[j] is not None)) for i, f, g in zip(ids, fps, group))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect())
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert left.count(None) == 1 and sorted(x for x in left if x is not None) == sorted({w[2] for w in want})
    assert simhash.simhash_groups(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def test_simhash_pairs_are_complete():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base ^ np.uint64(1 << int(k)) ^ np.uint64(1 << int(j)) for k, j in rng.integers(0, 64, (8, 2))]))
    i, j = simhash.block_links(x, None, 4, simhash._references(16))
    want = {(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if int(x[a] ^ x[b]).bit_count() <= 4}
    assert set(zip(i.tolist(), j.tolist())) == want
    i, j = simhash.block_links(x[:100], x[100:], 4, simhash._references(16))
    assert set(zip(i.tolist(), (j + 100).tolist())) == {(a, b) for a, b in want if a < 100 <= b}


def test_simhash_hot_bucket_blocks(spark, tmp_dir):
    """A key with more rows than a block is cut in block pairs and loses no link."""
    from pressroom.llm.scratch import Scratch
    x = [(1 << 40) + (a << 20) for a in range(300)]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in x], "fp long"), 4, Scratch(spark, "t"), block=16)
    root = {v: v for v in x}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v
    for r in links.collect():
        assert int(r.a ^ r.b).bit_count() <= 24
        root[max(top(r.a), top(r.b))] = min(top(r.a), top(r.b))
    assert len({top(v) for v in x}) == 1


def test_suffix(spark, rows, docs):
    keyed = {(-1 << 63 if i is None else i, t or "") for i, t, _, _ in rows}
    th = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in keyed], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    first, want = {}, {}
    for i, t in sorted(keyed, key=lambda x: (x[0], th[x[1]])):
        b = t.encode()
        for p in range(len(b) - 99):
            first[b[p:p + 100]] = min(first.get(b[p:p + 100], (i, th[t], p)), (i, th[t], p))
    for i, t in keyed:
        b = t.encode()
        gone = np.zeros(len(b) + 2, int)
        for p in range(len(b) - 99):
            if first[b[p:p + 100]] < (i, th[t], p):
                gone[p + 1:p + 101] = 1
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        want[(i, t)] = (len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest())
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.without_repeats(docs).collect())
    assert got == sorted((str(i), *want[(-1 << 63 if i is None else i, t or "")]) for i, t, _, _ in rows)
    assert sum(x[2] for x in got) > 1000
    assert suffix.without_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_suffix_keeps_one_copy_of_a_repeated_row(spark, parts):
    """A row given twice, its text in no earlier document, loses nothing, in whatever partitions its copies lie."""
    rng = random.Random(12)
    text, near = words(rng, 80), words(rng, 60)
    rows = [(5, text, "en", "a")] * 3 + [(6, near + " x" + text[:50], "en", "a")] * 2 + [(9, text, "en", "b"), (8, near + " y", "en", "b")] * 2
    got = suffix.without_repeats(make(spark, rows).repartition(parts)).collect()
    assert sorted({(r.doc_id, r.n_removed) for r in got}) == [
        (5, 0), (6, 0), (8, len(near) + 1), (9, len(text))] and len(got) == len(rows)


def test_suffix_levels_merge():
    """Many batches through the levels give what one sort gives, and the family stays logarithmic."""
    rng = np.random.default_rng(3)
    family, every, settled = suffix.Levels(), [], []
    for b in range(40):
        keys = suffix._keys(rng.integers(1, 400, 50, dtype=np.uint64), np.zeros(50, np.uint64))
        places = np.zeros(50, suffix._PLACE)
        places["did"], places["l"] = rng.integers(0, 30, 50), rng.permutation(5000)[:50] + b
        every.append((keys, places))
        k, p, again = suffix.suffix_array(keys, places)
        settled.append(again)
        family.add(k, p)
    keys, places, repeats = suffix.suffix_array(*(np.concatenate(x) for x in zip(*every)))
    got, where = family.all()
    assert (got == keys).all() and (where == places).all()
    as_set = (lambda a: sorted({tuple(x) for x in a.tolist()}))
    assert as_set(np.concatenate([family.repeated(), *settled])) == as_set(repeats)
    assert len(family.levels) <= 8


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_join(spark, threshold):
    from pressroom.llm.scratch import Scratch
    rng = random.Random(threshold)
    lines = {words(rng, 5, "abcé") for _ in range(25)}
    for a in sorted(lines):
        for _ in range(6):
            b = list(a)
            for _ in range(rng.randint(1, threshold + 1)):
                i = rng.randrange(len(b))
                b[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
            lines.add("".join(b))
    lines = sorted(x for x in lines if x)
    table = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("h1", F.xxhash64("line"))
    text = {r.h1: r.line for r in table.collect()}
    got = {(text[r.a], text[r.b]) for r in linededup.line_links(table, Scratch(spark, "t"), threshold, 8).collect()}
    assert got == {(a, b) for a in lines for b in lines if a != b and min(len(a), len(b)) >= 8 and lev(a, b) <= threshold}


def test_pairs_within_the_threshold_keep_their_pieces(spark):
    """The piece filter loses no pair: lines of 20 to 400 characters and copies with three edits or fewer."""
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcdé ñ") for _ in range(rng.randint(20, 400)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(b))
            b[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "ü"])
        pairs.append((a, "".join(b)))
    table = spark.createDataFrame(pairs, "x string, y string")
    near = table.select(linededup.pieces_near(F.col("x"), F.col("y"), 3).alias("xy"), linededup.pieces_near(F.col("y"), F.col("x"), 3).alias("yx"))
    assert near.filter("not xy or not yx").count() == 0
    far = spark.createDataFrame([("a b c d e f g h i j k l m n o p " * 3, "z y x w v u t s r q p o n m l k " * 3)], "x string, y string")
    assert far.filter(linededup.pieces_near(F.col("x"), F.col("y"), 3)).count() == 0


def test_template_lines_meet_their_own_kind_only(spark):
    """A thousand lines of one template that differ in a long word link with nothing; two near ones among them do."""
    rng = random.Random(7)
    lines = ["the same opening of every line here " + "".join(rng.choice("abcdefghij") for _ in range(24)) + " and the same end of it too" for _ in range(1000)]
    lines.append(lines[500].replace("opening", "openings"))
    docs = make(spark, [(i, t, "en", "a") for i, t in enumerate(lines)])
    assert [r.doc_id for r in linededup.line_report(docs).filter("n_removed > 0").collect()] == [1000]


def test_crowded_segments_pair_few_lines(spark):
    """Lines of one template, each with four letters put in elsewhere: far fewer than all pairs reach the verification,
    and copies one to three edits away from a line are all linked with it."""
    from pressroom.llm.scratch import Scratch
    rng = random.Random(12)
    base = words(rng, 100, "abcdefghé")[:300]
    lines = []
    for _ in range(300):
        at = rng.randrange(300)
        lines.append(base[:at] + "mpul" + base[at:])
    planted = set()
    for i in range(0, 300, 10):
        at, x = rng.randrange(280), lines[i]
        lines.append([x[:at] + "Q" + x[at + 1:], x[:at] + x[at + 2:], x[:at] + "QQé" + x[at:]][i // 10 % 3])
        planted |= {(x, lines[-1]), (lines[-1], x)}

    class Counting(Scratch):
        most = 0

        def save(self, df, free=False):
            out = super().save(df, free)
            if df.columns == ["a", "b"]:
                self.most = max(self.most, out.count())
            return out

    scratch = Counting(spark, "t")
    table = spark.createDataFrame([(x,) for x in sorted(set(lines))], "line string").withColumn("h1", F.xxhash64("line"))
    text = {r.h1: r.line for r in table.collect()}
    got = {(text[r.a], text[r.b]) for r in linededup.line_links(table, scratch, 3, 20).collect()}
    assert planted <= got and all(lev(a, b) <= 3 for a, b in got)
    assert scratch.most < 330 * 329 / 2 / 5


def test_line_dedup(spark, rows, docs):
    th = {r.t: r.h for r in docs.select(F.col("text").alias("t"), F.xxhash64("text").alias("h")).collect()}
    low = -(1 << 70)
    occ = sorted({(low if i is None else i, th[t], p, x.strip(" \t\r"), t) for i, t, _, _ in rows if t is not None
                  for p, x in enumerate(t.split("\n")) if x.strip(" \t\r")}, key=lambda o: o[:3])
    first = {}
    for i, h, p, x, _ in occ:
        first.setdefault(x, (i, h, p))
    long = [x for x in first if 20 <= len(x) <= 500]
    early = dict(first)
    for a in long:
        for b in long:
            if a != b and abs(len(a) - len(b)) <= 1 and lev(a, b) <= 1:
                early[a] = min(early[a], first[b])
    gone = {}
    for i, h, p, x, t in occ:
        if (i, h, p) > early[x]:
            gone.setdefault((i, t), []).append(p)
    want = sorted((str(i), ",".join(map(str, gone.get((low if i is None else i, t), [])))) for i, t, _, _ in rows)
    got = linededup.line_report(docs).collect()
    assert sorted((str(r.doc_id), r.removed) for r in got) == want and any(r.n_removed for r in got)
    kept = linededup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    left = {(r.doc_id, r.text) for r in kept.collect()}
    for i, t, _, _ in rows:
        cut = gone.get((low if i is None else i, t), [])
        text = t if not cut else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in cut)
        assert ((i, text) in left) == (not cut or bool(text.strip(" \t\r\n")))
    assert linededup.line_report(docs.limit(0)).count() == 0 and linededup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_lines_up_to_three_edits_go(spark):
    """The query's and the stage's own threshold: lines two and three edits from an earlier one go, four stay."""
    import corpus_pipeline
    line = "the quick brown fox jumps over the lazy dog"
    near = [line, line.replace("quick", "quack").replace("lazy", "lzy"), line.replace("fox", "fix").replace("dog", "dig") + "s",
            line.replace("quick", "qXXXXk")]
    docs = make(spark, [(i, t, "en", "a") for i, t in enumerate(near)])
    assert [r.n_removed for r in linededup.line_report(docs).orderBy("doc_id").collect()] == [0, 1, 1, 0]
    assert {r.doc_id for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == {0, 3}


def test_mixing(spark, rows, docs):
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, total = {}, set(order), 1.5 * sum(size.values())
    while True:
        share = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * share > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left.remove(s)
    target |= {s: weight[s] * share for s in left}
    source = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): s for i, t, _, s in rows}
    taken = dict.fromkeys(order, 0)
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 * (1 + target[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        taken[s] += r.taken
    for s in order:
        big = max((k[1] for k, v in source.items() if v == s), default=0)
        assert abs(taken[s] - target[s]) <= max(1, min(big, 0.6 * target[s]))
    again = mixing.mix_report(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_report(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_mixing_comes_near_many_sources(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(int(rng.paretovariate(1.2) * 20))), "en", f"s{i % 7}") for i in range(700)]
    got = mixing.mix_report(make(spark, rows)).collect()
    by = {}
    for r in got:
        t = by.setdefault(f"s{r.doc_id % 7}", [r.target, 0])
        t[1] += r.taken
    assert all(abs(a / b - 1) < 0.02 for b, a in by.values())
    rates = {round(r.rate, 6) for r in got}
    assert len(rates) > 20 and all(0 <= x <= 2 for x in rates)       # tilted by size, not one rate a source


def test_bpe(spark, rows, docs):
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks={b: i for i, b in enumerate(ranks)}, special_tokens={})
    want = []
    for i, t, _, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, ranks, P.PATTERN).collect()]
    assert sorted(got) == sorted(want)
    coded = bpe.encode(docs, ranks, P.PATTERN)
    assert coded.columns == [*docs.columns, "ids"] and coded.filter("size(ids) = 0").count() == 2
    assert bpe.round_trip(docs.limit(0), ranks, P.PATTERN).count() == 0
    codec = bpe.Codec(ranks, P.PATTERN)
    odd = ["a" + chr(c) + chr(c) + "b 1" + chr(c) for c in [*range(0, 0xD800, 7), *range(0xE000, 0x11000, 5)]] + ["x" * 5000, "'s 'll"]
    assert list(codec.encode(odd)) == [enc.encode_ordinary(x) for x in odd]
    assert codec.hash.find([b"", b"the", b"\xff\xfe\xfd"])[0] == -1 and sorted(codec.hash.at.tolist()) == list(range(len(ranks)))


def test_language(spark):
    from pressroom.llm.queries import op9_language
    got = op9_language(spark, "/root/testdata/sf0.001")
    lang = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").filter("held_out").selectExpr("avg(cast(lang = lang_pred as double)) a", "count(*) n").first()
    assert held.n >= 30 and held.a >= 0.95
    assert got.filter("score < 0 or score > 1").count() == 0


def test_language_awkward_rows(spark, docs):
    got = {r.doc_id: r for r in langid.language_report(docs).collect()}
    assert {got[i].lang_pred for i in (0, 1, 2)} == {"und"} and got[0].score == 0
    assert got[3].lang_pred in ("en", "fr")
    assert {r.lang_pred for r in langid.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    clash = docs.withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit("p"))
    kept = langid.keep_identified(clash)
    assert kept.columns == clash.columns and {(r.score, r.lang_pred) for r in kept.collect()} == {("s", "p")}
    assert kept.filter("doc_id in (0, 1, 2)").count() == 0
    assert langid.language_report(docs.limit(0)).count() == 0


def test_language_keeps_mixed_documents_and_unlabelled_tables(spark):
    """A document in three languages, each word of which is identified, stays; so does a table without labels."""
    rng = random.Random(3)
    sets = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst"}
    rows = [(100 * n + i, words(rng, 40, a), lang, "s") for n, (lang, a) in enumerate(sets.items(), 1) for i in range(25)]
    mixed = " ".join(words(rng, k, a) for k, a in ((40, "abcde"), (30, "fghij"), (30, "klmno")))
    table = make(spark, [*rows, (1, mixed, None, "s"), (2, "12 34", None, "s")])
    model = langid.train(table)
    assert model.predict([mixed])[1][0] < 0.5
    left = {r.doc_id for r in langid.keep_identified(table).collect()}
    assert left == {1, *(r[0] for r in rows)}
    unlabelled = table.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(unlabelled).count() == len(rows) + 2


def test_forward_backward():
    """Marginals equal the sum over all label sequences."""
    from itertools import product
    rng = np.random.default_rng(2)
    scores, trans, lengths = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), np.array([5, 3])
    gamma, pairs = langid.posteriors(scores, lengths, trans)
    at, total = 0, np.zeros((3, 3))
    for n in lengths:
        p, z, pp = np.zeros((n, 3)), 0, np.zeros((3, 3))
        for ys in product(range(3), repeat=int(n)):
            w = np.exp(sum(scores[at + t, y] for t, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:])))
            z += w
            for t, y in enumerate(ys):
                p[t, y] += w
            for a, b in zip(ys, ys[1:]):
                pp[a, b] += w
        assert np.allclose(gamma[at:at + n], p / z)
        total += pp / z
        at += n
    assert np.allclose(pairs, total)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = (lambda s: re.sub("[^0-9]", "", s))
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def test_personal_data(spark, rows, docs):
    got = pii.personal_data(docs).collect()
    assert len(got) == len(rows)
    text = {(i, hashlib.sha256((t or "").encode()).hexdigest()): t for i, t, _, _ in rows}
    want = sorted((str(i), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in plain_spans(t or "")).encode()).hexdigest())
                  for i, t in {(i, t) for (i, _), t in text.items()} for r in rows if (r[0], r[1]) == (i, t))
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    r = next(r for r in got if r.doc_id == 11)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1) and set(r.spans.split(",")) >= {
        f"{k}:{s}:{e}" for k, s, e in plain_spans(rows[14][1])}
    assert pii.personal_data(docs.limit(0)).count() == 0
    assert pii.personal_data(docs.filter("doc_id < 5")).agg(F.sum("n_added")).first()[0] == 0


def test_base_spans_of_noise():
    rng = random.Random(5)
    for _ in range(4000):
        t = "".join(rng.choices("ab1290.+-@ ()4.. -1", k=rng.randint(0, 60)))
        assert pii.base_spans(t)[0] == plain_spans(t)
    assert pii.base_spans("1" * 200_000 + "@" * 1000 + "a" * 200_000)[0] == []       # linear on long runs


def test_network_learns_and_adds():
    rng = random.Random(6)

    def sentence():
        a, b, c = (rng.randint(100, 999), rng.randint(100, 999), rng.randint(1000, 9999))
        return f"{words(rng, 6)} +1 ({a}) {b}-{c} {words(rng, 6)} user.{a}@mail{b % 9}.example.com {words(rng, 4)}"
    finder = pii.Finder(pii.fit([w for _ in range(300) for w in pii.training_windows(sentence())]))
    texts = [f"{words(rng, 5)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)} {words(rng, 5)}" for _ in range(40)]
    found = [more for _, more in finder.find(texts)]
    assert sum(any(k == "phone" for k, _, _ in m) for m in found) >= 20
    assert all(not more for _, more in finder.find([words(rng, 50) for _ in range(40)]))


def test_spelt_out_signs_are_read():
    """E-mails without a digit or an at sign are decoded; added phones have the kind's own bounds."""
    assert pii.Finder(None).zones("jane dot doe at example dot com") == [(0, 31)]
    rng = random.Random(9)
    name = (lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 6))))
    text = (lambda: f"{words(rng, 6)} {name()}.{name()}@{name()}.example.com {words(rng, 6)}")
    finder = pii.Finder(pii.fit([w for _ in range(400) for w in pii.training_windows(text())]))
    texts = [f"{words(rng, 8)} {name()} dot {name()} at {name()} dot example dot com {words(rng, 8)}" for _ in range(40)]
    assert sum(any(k == "email" for k, _, _ in more) for _, more in finder.find(texts)) >= 20
    assert [pii._plausible("phone", x) for x in ("555-1234", "555-12345", "5551-23456", "55512345", "5" * 16)] == [False, True, True, True, False]


def test_every_kind_is_learned_however_rare(spark, monkeypatch):
    """Four texts with a span among 2,000 with numbers: all kinds are in a sample of 20 texts, with negatives."""
    rng = random.Random(10)
    rows = [(i, f"{words(rng, 5)} {i} {words(rng, 5)}", "en", "a") for i in range(2000)]
    rare = ["mail bob@mail.example.com", "host 10.1.2.3 up", "card 4111 1111 1111 1111", "call +1 (555) 123-4567"]
    docs = make(spark, [*rows, *((3000 + i, t, "en", "a") for i, t in enumerate(rare * 30))])
    monkeypatch.setattr(pii, "fit", lambda windows: windows)
    windows = pii.train(docs, 20, 30)
    assert {k for _, spans in windows for k, _, _ in spans} == set(pii.KINDS)
    assert any(not spans for _, spans in windows) and len(windows) <= 30
    assert pii.train(docs.filter("doc_id < 2000"), 20, 30) is None
