"""The pipeline against a plain version of its stages, and the entry module without the subpackage."""
import hashlib
import os
import re
import shutil
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from pressroom.llm import langid, linededup, mixing, simhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def edits(a, b, most):
    """Edit distance of two strings, or more than ``most``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        if min(new) > most:
            return most + 1
        row = new
    return row[-1]


def plain_links(lines, most):
    """Lines at most ``most`` edits apart, among all pairs; letter counts (at most 2 * most apart) spare the distances."""
    count = np.zeros((len(lines), 256), np.int16)
    for k, x in enumerate(lines):
        np.add.at(count[k], [ord(c) % 256 for c in x], 1)
    size = np.array([len(x) for x in lines])
    out = {}
    for k, x in enumerate(lines):
        near = np.nonzero(np.abs(size[k + 1:] - size[k]) <= most)[0] + k + 1
        near = near[np.abs(count[near] - count[k]).sum(axis=1) <= 2 * most]
        for j in near:
            if edits(x, lines[j], most) <= most:
                out.setdefault(x, []).append(lines[j])
                out.setdefault(lines[j], []).append(x)
    return out


def test_links_at_the_threshold_against_brute_force(spark):
    """op7_lines' own threshold, on lines with zero to five random edits, templates and ties in length."""
    import random
    from pressroom.llm.scratch import Scratch
    rng = random.Random(12)
    base = ["".join(rng.choices("abcdef ", k=rng.randint(20, 70))) for _ in range(60)]
    base += [f"the number of this line is {k} and that is all" for k in range(40)]
    lines = set(base)
    for x in base * 6:
        y = list(x)
        for _ in range(rng.randint(1, 5)):
            p = rng.randrange(len(y))
            y[p:p + 1] = rng.choice([[], [y[p], rng.choice("abcx")], [rng.choice("abcx")]])
        if len(y) >= 20:
            lines.add("".join(y))
    lines = sorted(lines)
    frame = spark.createDataFrame([(x,) for x in lines], "line string").select(F.xxhash64("line").alias("h1"), "line")
    text = {r.h1: r.line for r in frame.collect()}
    found = linededup.line_links(frame, Scratch(spark, "t"), linededup.THRESHOLD, linededup.MIN_CHARS)
    got = {(text[r.a], text[r.b]) for r in found.collect()}
    want = {(x, y) for x, ys in plain_links(lines, linededup.THRESHOLD).items() for y in ys}
    assert linededup.THRESHOLD == 3 and len(want) > 500 and got == want


def test_stages_against_plain_versions(spark, tmp_dir):
    import public_tokenizers as P
    import tiktoken
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # 1: the same model, applied text by text
    model = langid.train(docs)
    kept = {}
    for i, r in rows.items():
        (lang,), _, (sure,) = model.judge([r.text])
        if lang != "und" and sure >= 0.5:
            kept[i] = r.text
    one = corpus_pipeline.language_id(spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id: r.text for r in one.collect()} == kept
    # 2: earlier lines, exact or at most three edits away
    first, gone = {}, {}
    lines = [(i, p, x.strip(" \t\r")) for i in sorted(kept) for p, x in enumerate(kept[i].split("\n")) if x.strip(" \t\r")]
    for i, p, x in lines:
        first.setdefault(x, (i, p))
    links = plain_links([x for x in first if len(x) >= 20], 3)
    early = {x: min([at, *(first[y] for y in links.get(x, ()))]) for x, at in first.items()}
    for i, p, x in lines:
        if (i, p) > early[x]:
            gone.setdefault(i, set()).add(p)
    two = {}
    for i, t in kept.items():
        text = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get(i, ()))
        if i not in gone or text.strip(" \t\r\n"):
            two[i] = text
    second = corpus_pipeline.line_dedup(spark, one, SF)
    assert {r.doc_id: r.text for r in second.collect()} == two and second.columns == docs.columns
    # 3: the smallest doc_id of each group
    ids = sorted(two)
    fps = np.array([simhash.fingerprint(two[i], 4) for i in ids], np.uint64)
    near, low = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, np.array(ids)
    while True:
        new = np.array([low[x].min() for x in near])
        if (new == low).all():
            break
        low = new
    three = {i: two[i] for i, g in zip(ids, low) if i == g}
    third = corpus_pipeline.simhash_dedup(spark, second, SF)
    assert {r.doc_id: r.text for r in third.collect()} == three and third.columns == docs.columns
    # 4: as often as the mix says
    times = {r.doc_id: r.copies for r in mixing.mix_report(third).collect()}
    fourth = corpus_pipeline.source_mix(spark, third, SF)
    assert fourth.columns == docs.columns
    assert {r.doc_id: r.n for r in fourth.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {
        i: n for i, n in times.items() if n}
    # 5, and run() as a whole
    enc = tiktoken.get_encoding if False else tiktoken.Encoding("t", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        b: i for i, b in enumerate(__import__("pressroom.llm.bpe", fromlist=["x"]).load_ranks(P.path(corpus_pipeline.VOCABULARY)))})
    want = []
    for i, n in times.items():
        coded = enc.encode_ordinary(three[i])
        want += [(i, len(coded), hashlib.sha256(",".join(map(str, coded)).encode()).hexdigest())] * n
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in got.collect()) == sorted(want)
    assert re.fullmatch("[a-z_]+", corpus_pipeline.STAGES[0][0]) and len(corpus_pipeline.STAGES) == 5


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_line_dedup_keeps_documents_without_lines(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "\n \n"), (4, "a line that all have\nx"), (5, "a line that all have\n\n")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.drop_repeated_lines(docs).collect()}
    assert got == {1: None, 2: "", 3: "\n \n", 4: "a line that all have\nx"}


def test_entry_without_the_subpackage(tmp_dir):
    for name in ("pressroom", "__spark_entry__.py"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", f"{tmp_dir}/{name}", **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if copy is shutil.copytree else {}))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": tmp_dir})
    assert out.returncode == 0 and out.stdout.split()[1:] == ["False", "False"], out.stderr
