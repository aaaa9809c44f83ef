"""Author queries over the whole sf0.001 documents table vs a plain-Python brute force."""
import re

import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from test_authors import ref_cut_one, ref_okd, ref_strict, ref_strip_one

from pressroom.functions import authors as A


def _initcap(s):
    return " ".join(w[:1].title() + w[1:].lower() for w in s.split(" "))     # Spark initcap


def candidates(text):
    return [_initcap(piece).replace(" Y ", " y ") for piece in re.split(r"\. |\n", text or "")]


def ref_strip50_one(a):
    a = a.strip()
    for p in A.STRIP_PATTERNS:
        a = re.sub(p, " ", a)
    a = " ".join(a.split())
    return a if 3 <= len(a) <= 50 else None


ONE = {
    "strict": lambda c: (ref_strict([c]) or [None])[0],
    "cut": lambda c: ref_cut_one(c) or None,
    "okd": lambda c: (ref_okd([c]) or [None])[0] if c else None,
    "strip50": lambda c: ref_strip50_one(c) if c else None,
}


def expected(text, rule):
    seen, out = set(), []
    for c in candidates(text):
        v = ONE[rule](c) if c else None
        if v and v.lower() not in seen:
            seen.add(v.lower())
            out.append(v)
    return "|".join(out)


@pytest.mark.parametrize("rule", ["strict", "cut", "okd", "strip50"])
def test_author_query_vs_brute_force(spark, rule):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    want = {int(r.doc_id): expected(r.text, rule) for r in docs.itertuples()}
    got = {r.doc_id: r.authors for r in E.queries()[f"authors_{rule}"](spark, SF_SMALL).collect()}
    assert set(got) == set(want)
    bad = [(k, got[k], want[k]) for k in want if got[k] != want[k]]
    assert not bad, bad[:3]


def test_strip_query_vs_brute_force(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r.authors for r in E.queries()["authors_strip"](spark, SF_SMALL).collect()}
    for r in docs.itertuples():
        seen, out = set(), []
        for c in candidates(r.text):
            if not c:
                continue
            subs = re.split(r"[,;]|\s+y\s+", c) if ("," in c or " y " in c) else [c]
            for s in subs:
                v = ref_strip_one(s)
                if v and v.lower() not in seen:
                    seen.add(v.lower())
                    out.append(v)
        assert got[int(r.doc_id)] == ("|".join(out) or "20minutos"), r.doc_id
