"""Main text of web pages by line-block distribution (operator 8).

Markup is stripped to lines: one per block element with text, in page order. Elements that are not
the article (menus, page headers and footers, sidebars, forms, notices, adverts, reader comments)
give no lines, lines of mostly links weigh nothing. The text lengths are summed over sliding windows
of ``WINDOW`` lines; text surges where a window's sum passes ``SURGE`` and dives where it falls to
zero, that is, at ``WINDOW`` or more lines of links. The lines between a surge and the next dive are
the main text. Where a surge lies in an ``article`` or ``main`` element, the text is that element's
lines but for its dives, and spans outside such elements are dropped; without any surge the element,
or else the heaviest run of lines, is taken, so that short articles are whole too.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
SURGE = 80

# Element names of HTML.
_BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section
summary table tbody td tfoot th thead title tr ul""".split())
_RAW = r"script|style|noscript|template|textarea|iframe|svg|select|object|noframes|title"
_NOT_TEXT = frozenset("nav footer aside form button menu dialog head fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Names (class, id, role) of a part which isn't the article. A name that says what its element has
#: or lacks (has-sidebar, no-ads, content-sidebar-wrap) is not such a part's, nor one whose last words
#: only place it in a page builder (elementor-widget) or name its results (search-results).
_PARTS = re.compile(r"""(?!(?:has|have|with|without|no|hide|show|content-sidebar)[_-])(?:.*[_-])?(?:ads?|adv|advert\w*|adsense
|sponsor\w*|promo\w*|banner|menu\w*|nav|navbar|navigation|breadcrumbs?|sidebar\w*|side-bar|cookies?\w*|consent|gdpr|notice\w*
|alert|newsletter|subscri\w+|signup|login|popup|modal|overlay|comments?|commentlist|respond|replies|disqus\w*|footer\w*|masthead
|site-header|page-header|topbar|share|sharing|social\w*|related\w*|recommend\w*|complementary|contentinfo)(?:[_-].*)?\Z
|widgets?(?:[_-].*)?\Z|(?:site-|header-|nav-)?search(?:[_-]?(?:form|box|bar|field|widget))?\Z""", re.I | re.X)
#: What closes an element that was left open: the next of its kind, or the end of its parent.
_NEXT = {"p": _BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_LISTS = frozenset("ul ol dl dir".split())
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</(?P=raw)\s*>|\Z)
|<(?P<end>/)?(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*)>|<[!?][^>]*>|<(?:/?[a-z!?])[^>]*\Z""", re.I | re.S | re.X)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _not_article(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _NOT_TEXT or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    return any(_PARTS.match(name) for found in _NAMED.findall(attrs) for name in " ".join(found).split())


def _left_open(skip: str, tag: str, end: bool, lists: int, articles: int, in_article: bool) -> bool:
    """Whether this tag closes the skipped element without being its end tag; ``lists`` and ``articles`` count such
    elements open inside it."""
    if tag == skip and end:
        return False
    if end and tag in ("article", "main"):
        return in_article and not articles
    if skip not in _NEXT or lists:
        return False
    return tag in (_BLOCKS if skip == "p" else _LISTS) if end else tag in _NEXT[skip]


class _Lines:
    """The page's lines: text, characters in links, and the number of the article element around it."""

    def __init__(self, page: str):
        self.text: list[str] = []
        self.links: list[int] = []
        self.article: list[int] = []
        part, linked, link, skip, depth, articles, inside = [], 0, 0, "", 0, 0, []
        lists = held = 0                                    # open inside the skipped element

        def close() -> None:
            nonlocal linked
            line = " ".join(entities.unescape("".join(part)).split())
            if line:
                self.text.append(line)
                self.links.append(linked)
                self.article.append(inside[-1] if inside else 0)
            part.clear()
            linked = 0

        at = 0
        for m in _TOKEN.finditer(page):
            if not skip and m.start() > at:
                piece = page[at:m.start()]
                part.append(piece)
                linked += len(piece) if link else 0
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            end = bool(m["end"])
            if skip:
                over = _left_open(skip, tag, end, lists, held, bool(inside))
                if not over:
                    step = -1 if end else 1
                    if tag == skip:
                        depth += step
                    elif tag in ("article", "main"):
                        if not end and not articles and not _not_article(tag, m["attrs"], False):
                            over = True                     # left open before the first article
                        else:
                            held += step
                    lists += step if tag in _LISTS else 0
                if depth and not over:
                    continue
                skip = ""
                close()
                if not over:
                    continue
            if tag == "a":
                link = not end
            elif tag == "br" and not end:
                part.append(" ")
            if tag in _BLOCKS:
                close()
            if not end and tag not in _VOID and _not_article(tag, m["attrs"], bool(inside)):
                close()
                skip, depth, lists, held = tag, 1, 0, 0
            elif tag in ("article", "main"):
                if not end:
                    articles += 1
                    inside.append(articles)
                elif inside:
                    inside.pop()
        if not skip:
            part.append(page[at:])
        close()


def main_text(page: str | None) -> str:
    lines = _Lines(page or "")
    n = len(lines.text)
    if not n:
        return ""
    size = np.fromiter(map(len, lines.text), np.int64, n)
    weight = np.where(2 * np.asarray(lines.links) > size, 0, size)
    article = np.asarray(lines.article)
    edges = np.nonzero(np.diff(np.concatenate([[0], weight == 0, [0]])))[0].reshape(-1, 2)
    dives = [(s, e) for s, e in edges.tolist() if e - s >= WINDOW]
    dived = np.zeros(n, bool)
    for s, e in dives:
        dived[s:e] = True
    runs = [(a, b) for a, b in zip([0] + [e for _, e in dives], [s for s, _ in dives] + [n]) if a < b]
    keep = np.zeros(n, bool)
    for a, b in runs:
        sums = np.convolve(weight[a:b], np.ones(WINDOW, np.int64))[WINDOW - 1:]     # window i: lines i .. i + WINDOW - 1
        surge = np.nonzero(sums > SURGE)[0]
        if len(surge):
            keep[a + surge[0]:a + 1 + np.nonzero(weight[a:b])[0][-1]] = True
    own = set(article[keep & (weight > 0)].tolist()) - {0} or set(article.tolist()) - {0}
    if own:
        inside = np.isin(article, list(own))
        keep = inside & ~dived if (inside & ~dived).any() else inside
    elif not keep.any() and weight.any():
        a, b = max(runs, key=lambda r: weight[r[0]:r[1]].sum())
        keep[a:b] = True
    return "\n\n".join(t for t, k in zip(lines.text, keep) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without the html column, with text and n_chars (code points).

    A null or empty page, or one without text, gives an empty text. Other columns are kept as they
    are (existing ``text`` and ``n_chars`` are replaced); repeated rows repeat.
    """
    from pyspark.sql import functions as F

    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(html)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=[*kept, "text", "n_chars"])

    schema = pages.select(*kept).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    return pages.select(*kept, html).mapInArrow(run, schema)
