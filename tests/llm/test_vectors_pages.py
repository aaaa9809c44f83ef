"""Vector and page operators on small tables, against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.llm import embed, hamming, htmltext

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, n int"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        base = rng.normal(size=16)
        for k in range(rng.integers(2, 20)):
            rows.append((base + rng.normal(size=16) * rng.choice([0, 0.02, 0.06, 0.3])).astype(np.float32).tolist())
    rows += [r for r in rows[:5]] + [[0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, None, [], [1e-30] * 16,
                                     [1e30] * 16, [1.0] * 8, [2.0] * 8, [None] + [1.0] * 15]
    out = [(i * 3, v, int(rng.integers(0, 2)), "x", 1) for i, v in enumerate(rows)]
    out += [(10_000, rows[0], None, "x", 1), (10_001, rows[0], None, "x", 1), (0, rows[0], out[0][2], "x", 1),
            (None, rows[0], out[0][2], "x", 1)]
    return out


def test_embeddings(spark, vectors):
    def fine(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(vectors)
    link = np.zeros((n, n), bool)
    for a, (_, v, la, _, _) in enumerate(vectors):
        for b, (_, w, lb, _, _) in enumerate(vectors):
            if a != b and fine(v, la) and fine(w, lb) and la == lb and len(v) == len(w):
                x, y = np.float32(v).astype(float), np.float32(w).astype(float)
                link[a, b] = (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= 0.98
    group = [{i} | set(np.nonzero(link[i])[0]) for i in range(n)]
    for _ in range(n):
        new = [set().union(*(group[j] for j in g)) for g in group]
        if new == group:
            break
        group = new
    ids = [r[0] for r in vectors]
    low = [min((ids[j] for j in g if ids[j] is not None), default=None) for g in group]
    want = sorted((str(i), int(k), str(c), i == c) for i, k, c in zip(ids, link.sum(axis=1), low))
    table = spark.createDataFrame(vectors, SCHEMA)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embed.near_vectors(table).collect())
    assert got == want and sum(w[1] for w in want) > 100
    assert embed.near_vectors(table.limit(0)).count() == 0


def test_interval_join_is_complete():
    rng = np.random.default_rng(7)
    x = np.repeat(rng.normal(size=(30, 8)), 10, axis=0) + rng.normal(size=(300, 8)) * 0.05
    u = embed._units(x)
    eps = float(np.sqrt(2 - 2 * 0.98)) + 1e-9
    at = u @ embed._axes(u.T @ u)
    order = np.lexsort(np.floor(at / eps).T[::-1])
    u, at = u[order], at[order]
    i, j = embed.interval_links(u, u, at, at, 0.98, eps, same=True)
    a, b = np.nonzero(np.triu(u @ u.T >= 0.98, 1))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist()))
    i, j = embed.interval_links(u[:120], u[120:], at[:120], at[120:], 0.98, eps, same=False)
    assert set(zip(i.tolist(), (j + 120).tolist())) == {(p, q) for p, q in zip(a.tolist(), b.tolist()) if p < 120 <= q}


def test_blocks_of_a_hot_label(spark, monkeypatch):
    """A label with many blocks: every link is found across blocks."""
    monkeypatch.setattr(embed, "BLOCK", 16)
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(6) + rng.normal(size=6) * 0.12).astype(np.float32).tolist(), 1, "", 0) for i in range(150)]
    u = embed._units(np.array([r[1] for r in rows], np.float32))
    want = (u @ u.T >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(150)] == want.tolist()


@pytest.mark.parametrize("k", [1, 7])
def test_top_k(spark, vectors, k):
    rng = np.random.default_rng(1)
    codes = [int(x) for x in rng.integers(-(1 << 63), 1 << 62, 150)]
    codes += [codes[0] ^ (1 << b) for b in range(0, 60, 7)] + [codes[1]] * 30
    rows = [(i, c) for i, c in enumerate(codes)] + [(None, 5), (900, None), (3, codes[3])]
    table = spark.createDataFrame(rows, "id long, code long")
    asked = spark.createDataFrame([(i, codes[i]) for i in range(0, 180, 9)] + [(0, codes[0]), (77, None)], "query_id long, code long")
    want = set()
    for q in range(0, 180, 9):
        near = sorted(((int(c ^ codes[q]) & (1 << 64) - 1).bit_count(), i) for i, c in enumerate(codes))[:k]
        want |= {(q, r, i, d) for r, (d, i) in enumerate(near, 1)}
    got = {(r.query_id, r["rank"], r.id, r.distance) for r in hamming.top_k(table, asked, k).collect()}
    assert got == want
    few = hamming.top_k(table.limit(2), asked, k)
    assert few.groupBy("query_id").count().agg(F.max("count")).first()[0] == min(k, 2)
    assert hamming.top_k(table.limit(0), asked, k).count() == 0 and hamming.top_k(table, asked.limit(0), k).count() == 0


def test_sign_code(spark):
    rows = [(1, [1.0, -1.0, 0.0, 2.0]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0, 1.0, 1.0]), (5, [None, 1.0, 1.0, 1.0])]
    got = {r.i: r.c for r in spark.createDataFrame(rows, "i int, v array<float>").select("i", hamming.sign_code("v", 4).alias("c")).collect()}
    assert got == {1: 9, 2: None, 3: None, 4: None, 5: None}


PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><!-- ad -->"
     "<div class=\"ad\">Buy now</div><article><h1>Head &amp; more</h1><p>First  <b>bold</b>\n text.<br>Next<p>Second &eacute;&#8217;s"
     "<script>var a='<p>no</p>';</script></article><footer>&copy; me</footer></body></html>",
     "Head & more\n\nFirst bold text. Next\n\nSecond é’s"),
    ("<header><h1>Site</h1></header><div><p>" + "long text " * 20 + "</p><p>and " + "more " * 30 + "</p></div>"
     "<aside><p>" + "side " * 40 + "</p></aside><section id='comments'><p>" + "reader " * 40 + "</p></section>"
     "<form><label>Name</label></form>", ("long text " * 20).strip() + "\n\n" + ("and " + "more " * 30).strip()),
    ("<article><p>short</p></article>", "short"),
    ("<main><p>in main</p><article class='comment'><p>a reader</p></article></main>", "in main"),
    ("just text, no markup", "just text, no markup"),
    ("", ""), (None, ""), ("<p>unclosed <b>tag <", "unclosed tag <"), ("<!-- never closed <p>x</p>", ""), ("<script>var x", ""),
]


_LONG = ("long text " * 20).strip()
#: Wrappers whose names hold a part's word, elements left open, closing blocks behind many tags, menus inside an article.
STRUCTURES = [
    (f"<nav>Menu</nav><div class='content has-sidebar'><p>{_LONG}</p><p>End.</p></div>", f"{_LONG}\n\nEnd."),
    (f"<div class='elementor-widget elementor-widget-text'><p>{_LONG}</p></div><div class='widget widget_text'>{_LONG}</div>", _LONG),
    (f"<article><h1>Head</h1><section class='search-results'><p>{_LONG}</p></section><div class='search-form'>Find</div></article>",
     f"Head\n\n{_LONG}"),
    (f"<article><p>One<p class='notice'>We use cookies<p>{_LONG}<ul><li class='ad'>Buy<li>item</ul></article><p>after</p>",
     f"One\n\n{_LONG}\n\nitem"),
    (f"<article><p>{_LONG}</p><p class='notice'>Note</article><p>after</p>", _LONG),
    (f"<article><p>{_LONG}</p><div class='notice'>Open<div>deep</div></article><footer>f</footer>", _LONG),
    (f"<div><div><div><p>{_LONG}</p></div></div></div><div><div><p>short end.</p></div></div>", f"{_LONG}\n\nshort end."),
    (f"<div><p>{_LONG}</p>" + "<p><a href='/x'>Read this too</a></p>" * 3 + "</div><div>Imprint</div>", _LONG),
    (f"<article><p>{_LONG}</p>" + "<p><a href='/x'>Read this too</a></p>" * 3 + "<p>short end.</p></article>", f"{_LONG}\n\nshort end."),
    (f"<article><p>{_LONG}</p><p><a href='/x'>A source</a></p></article>", f"{_LONG}\n\nA source"),
    (f"<article><p>{_LONG}</p></article><section id='comments'><article><p>{_LONG}</p></article></section>", _LONG),
    (f"<ul class='menu'><li>Home<article><p>{_LONG}</p></article>", _LONG),
    ("<article><ul><li><a href='/a'>a</a><li><a href='/b'>b</a><li><a href='/c'>c</a></ul></article>", "a\n\nb\n\nc"),
]


@pytest.mark.parametrize("i", range(len(STRUCTURES)))
def test_main_text_structures(i):
    page, want = STRUCTURES[i]
    assert htmltext.main_text(page) == want


def test_main_text(spark):
    rows = [(i, f"u{i}", h, "old", 5) for i, (h, _) in enumerate(PAGES)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.extract(table).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i] == (want, len(want)), i
    assert htmltext.extract(table.limit(0)).count() == 0
    huge = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    assert htmltext.main_text(huge) == "\n\n".join(["word"] * 20_000)
    assert htmltext.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_main_text_of_the_table(spark):
    """Every page of the test table: the article's own blocks, found here by its plain structure."""
    import html
    import re
    from pressroom.llm.queries import op8_main_text
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = op8_main_text(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x)).split())
                  for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(x for x in blocks if x)
