"""HTML/JSON extraction from a page column as Column expressions (HTM1, HTM2, HTM5,
HTM7, HTM9-HTM11, PRJ11).

Markup in real pages is malformed, so XPath is not an option (it fails the job);
flat markup is read with regular expressions, which stay inside codegen.  Rules
that need the element tree (sibling and ancestor selectors) are left out.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PY_WHITESPACE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Named entities decoded by ``unescape`` ('&amp;' is applied last
# so that '&amp;lt;' becomes '&lt;', as a single left-to-right pass would).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


# The other named references, from the standard library's table (ASCII-named ones end in ';').
_NAMED = {f"&{k}": v for k, v in html5.items() if k.endswith(";")}
_REFERENCE = "&(?:#[0-9]{1,8}|#[xX][0-9A-Fa-f]{1,7}|[A-Za-z][A-Za-z0-9]*);"


def _referenced(ref: Column) -> Column:
    """The character of one reference; unknown names stay as they are."""
    body = F.regexp_extract(ref, "^&#[xX]?([0-9A-Fa-f]+);$", 1)
    code = F.when(ref.rlike("^&#[xX]"), F.conv(body, 16, 10)).otherwise(body).cast("int")
    fine = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    return F.when(ref.startswith("&#"), char).otherwise(F.coalesce(F.element_at(names, ref), ref))


def unescape(c) -> Column:
    col = _c(c)
    for k, v in ENTITIES[:-1]:
        col = F.replace(col, F.lit(k), F.lit(v))
    refs = F.array_distinct(F.filter(F.regexp_extract_all(col, F.lit(_REFERENCE), 0), lambda r: r != "&amp;"))
    # '&amp;' comes last, and '&amp;eacute;' holds no '&eacute;', so nothing is decoded twice
    rest = F.aggregate(refs, col, lambda text, r: F.replace(text, r, _referenced(r)))
    # every reference starts with '&'
    return F.when(_c(c).contains("&"), F.replace(rest, F.lit("&amp;"), F.lit("&"))).otherwise(_c(c))


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), "<[^>]*>", "")


def tag_text(c) -> Column:
    """get_text(): tags removed, entities decoded, whitespace collapsed, trimmed."""
    return F.trim(F.regexp_replace(unescape(strip_tags(c)), PY_WHITESPACE + "+", " "))


def first_tag_inner(html, tag: str, attr_pattern: str = "") -> Column:
    """Inner markup of the first ``<tag ...attr_pattern...>...</tag>``; '' when absent."""
    pat = f"(?is)<{tag}\\b[^>]*{attr_pattern}[^>]*>(.*?)</{tag}>" if attr_pattern \
        else f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>"
    return F.regexp_extract(_c(html), pat, 1)


# Ordered title selectors (class of an h1, then any h1), per site rule.
TITLE_H1_CLASSES = ["ue-c-article__headline", "ue-c-article__title", "article-header-title"]
OKDIARIO_H1_CLASSES = ["title", "entry-title", "article-title"]


def page_title(html, rule: str = "el_mundo") -> Column:
    """HTM1: the page title by ordered h1 selectors.

    el_mundo  first selector whose text is non-empty: h1 with a known class,
              h1[itemprop=headline], any h1
    okdiario  the first selector that finds an element (its text may be empty): h1.title,
              h1.entry-title, h1.article-title, any h1
    """
    if rule == "okdiario":
        pats = [f'(?is)<h1\\b[^>]*class="[^"]*\\b{k}\\b[^"]*"[^>]*>' for k in OKDIARIO_H1_CLASSES]
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for k, p in zip(OKDIARIO_H1_CLASSES, pats):
            out = out.when(_c(html).rlike(p), tag_text(first_tag_inner(html, "h1", f'class="[^"]*\\b{k}\\b[^"]*"')))
        return out.when(_c(html).rlike("(?is)<h1\\b"), tag_text(first_tag_inner(html, "h1")))
    cands = [first_tag_inner(html, "h1", f'class="[^"]*\\b{k}\\b[^"]*"') for k in TITLE_H1_CLASSES]
    cands.append(first_tag_inner(html, "h1", 'itemprop="headline"'))
    cands.append(first_tag_inner(html, "h1"))
    texts = [F.nullif(tag_text(x), F.lit("")) for x in cands]
    return F.coalesce(*texts)


def head_title(html) -> Column:
    """Text of ``<title>``; null when absent or empty."""
    return F.nullif(tag_text(first_tag_inner(html, "title")), F.lit(""))


_META = "(?is)<meta\\b[^>]*>"
_META_KEY = "(?is)\\b(?:name|property|itemprop)\\s*=\\s*[\"']([^\"']*)[\"']"
_META_VAL = "(?is)\\bcontent\\s*=\\s*[\"']([^\"']*)[\"']"


def meta_map(html) -> Column:
    """HTM2: ``<meta name|property=... content=...>`` as a map (attribute order free, first wins)."""
    tags = F.regexp_extract_all(_c(html), F.lit(_META), 0)
    found = F.transform(tags, lambda t: F.struct(F.lower(F.regexp_extract(t, _META_KEY, 1)).alias("k"),
                                                 F.regexp_extract(t, _META_VAL, 1).alias("v")))
    # the value is extracted once, however often ``unescape`` names it
    entries = F.transform(found, lambda e: F.struct(e["k"].alias("k"), unescape(e["v"]).alias("v")))
    good = F.filter(entries, lambda e: (e["k"] != "") & (e["v"] != ""))
    # first occurrence of a key wins; folded with ``aggregate`` so the tag list is computed once
    # (an outer array referenced inside a lambda would be re-evaluated for every element)
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(good, empty, lambda acc, e: F.when(F.map_contains_key(acc, e["k"]), acc)
                       .otherwise(F.map_concat(acc, F.create_map(e["k"], e["v"]))))


def meta_json(html) -> Column:
    """HTM2: the meta map as a JSON object keyed by the full tag name ('og:title').

    The reference nests these on ':' ({"og": {"title": ...}}); here the payload stays
    flat and a dotted path 'og.title' is read as the key 'og:title' (see the hourly job).
    """
    m = meta_map(html)
    return F.to_json(m)


def meta_get(html_or_map, key: str, is_map: bool = False) -> Column:
    m = _c(html_or_map) if is_map else meta_map(html_or_map)
    return F.element_at(m, F.lit(key.lower()))


# Meta tags searched for an author, in order (AUT10).
AUTHOR_META = ["author", "article:author", "sailthru.author", "dc.creator",
               "dcterms.creator", "parsely-author", "twitter:creator"]
BYLINE_META = ["og:byline", "byline", "article:byline"]


def meta_authors(html_or_map, is_map: bool = False) -> Column:
    """Author candidates from meta tags (non-blank values of AUTHOR_META, in order)."""
    m = _c(html_or_map) if is_map else meta_map(html_or_map)
    vals = F.array(*[F.element_at(m, F.lit(k)) for k in AUTHOR_META])
    return F.filter(vals, lambda v: v.isNotNull() & (F.trim(v) != ""))


def meta_byline(html_or_map, is_map: bool = False) -> Column:
    m = _c(html_or_map) if is_map else meta_map(html_or_map)
    return F.coalesce(*[F.element_at(m, F.lit(k)) for k in BYLINE_META])


def meta_author_single(html_or_map, is_map: bool = False) -> Column:
    """HTM11: the single ``author`` meta as a one-item list; empty list when absent."""
    m = _c(html_or_map) if is_map else meta_map(html_or_map)
    a = F.element_at(m, F.lit("author"))
    return F.when(a.isNotNull() & (F.trim(a) != ""), F.array(a)).otherwise(F.array().cast("array<string>"))


_LD = "(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"


def jsonld_blocks(html) -> Column:
    """HTM5: JSON-LD script bodies, parsed as VARIANT (unparseable blocks -> null, dropped)."""
    blocks = F.regexp_extract_all(_c(html), F.lit(_LD), 1)
    parsed = F.transform(blocks, lambda b: F.try_parse_json(b))
    return F.filter(parsed, lambda v: v.isNotNull())


def _ld_items(html) -> Column:
    """Every object of every block; a top-level array contributes its items."""
    blocks = jsonld_blocks(html)
    per = F.transform(blocks, lambda v: F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"), F.array(v)))
    return F.flatten(per)


def _author_names(v: Column) -> Column:
    """author as list of objects/strings, a single object, or a string -> list of names."""
    as_list = F.try_variant_get(v, "$.author", "array<variant>")
    one = F.array(F.try_variant_get(v, "$.author", "variant"))
    items = F.coalesce(as_list, one)
    names = F.transform(items, lambda a: F.coalesce(
        F.try_variant_get(a, "$.name", "string"),
        F.when(F.schema_of_variant(a) == "STRING", F.try_variant_get(a, "$", "string"))))
    return F.filter(names, lambda x: x.isNotNull() & (F.trim(x) != ""))


def _first_item(v: Column) -> Column:
    """A block's object: item 0 when the block is a list, else the block itself."""
    return F.coalesce(F.try_variant_get(v, "$[0]", "variant"), v)


def jsonld_authors(html, every_item: bool = True) -> Column:
    """HTM5 authors: every item of every block (El País), or item 0 of each block, appended
    across blocks (Infobae / Vozpópuli)."""
    if every_item:
        return F.flatten(F.transform(_ld_items(html), _author_names))
    return F.flatten(F.transform(jsonld_blocks(html), lambda b: _author_names(_first_item(b))))


def jsonld_field_last(html, path: str) -> Column:
    """HTM5 scalar fields of the Infobae / Vozpópuli rule: item 0 of each block, the last
    block that has the field wins."""
    vals = F.transform(jsonld_blocks(html), lambda b: F.try_variant_get(_first_item(b), path, "string"))
    return F.try_element_at(F.filter(vals, lambda x: x.isNotNull()), F.lit(-1))


def jsonld_field(html, path: str) -> Column:
    """First non-null string at ``path`` ('$.headline', '$.datePublished', ...) over all items."""
    vals = F.transform(_ld_items(html), lambda v: F.try_variant_get(v, path, "string"))
    return F.get(F.filter(vals, lambda x: x.isNotNull()), 0)


def _unquoted(v: Column) -> Column:
    """An attribute's value without its quotes."""
    return F.regexp_replace(v, "^([\"'])(.*)\\1$", "$2")


def time_datetime(html, meta: Column | None = None) -> Column:
    """HTM7: ``<time datetime=...>`` (itemprop=datePublished first), else the published meta.
    Pass an already computed ``meta_map`` column as ``meta`` to avoid parsing the tags again."""
    value = "datetime\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"
    own = "itemprop\\s*=\\s*[\"']?datePublished\\b"
    dp = _unquoted(F.regexp_extract(_c(html), f"(?is)<time\\b(?=[^>]*{own})[^>]*?\\b{value}", 1))
    anyt = _unquoted(F.regexp_extract(_c(html), f"(?is)<time\\b[^>]*?\\b{value}", 1))
    m = meta if meta is not None else meta_map(html)
    return F.coalesce(F.nullif(dp, F.lit("")), F.nullif(anyt, F.lit("")),
                      F.element_at(m, F.lit("article:published_time")),
                      F.element_at(m, F.lit("pubdate")))


# Classes whose element holds an author name, per site rule, in the reference's order. Left out, as
# flat markup can't tell them: selectors of an element inside another, beside another, of a part of
# a class name, and of an element name with a class besides ``rel`` and ``itemprop`` of an author.
AUTHOR_CLASSES = {
    "el_pais": ["a_hi", "a_ti", "autor-nombre", "author", "author-name", "author_link", "byline", "byline__name",
                "c-byline__author", "entry-author", "firma", "firma-autor", "firma_apellidos", "firma_nombre",
                "firmas_articulo", "firma_autor", "g-author", "nombre_autor", "signature", "vcard"],
    "okdiario": ["author-name", "author", "entry-author", "article-author", "byline", "autor", "firma", "signature"],
    "el_mundo": ["ue-c-article__byline-name", "author-name"],
}
# Words that no author element's text holds, per site rule.
AUTHOR_TEXT_STOP = {
    "el_pais": ["redacción", "redaccion", "elpais.com", "comentar", "comentarios", "seguir"],
    "okdiario": ["por", "publicado", "actualizado", "compartir", "redacción", "equipo", "staff", "redaccion"],
    "el_mundo": [],
}


def _author_text(t: Column, rule: str) -> Column:
    """The name in an author element's text, or null where the text isn't one."""
    clean = F.length(t) > 0
    if AUTHOR_TEXT_STOP[rule]:
        clean = clean & ~F.lower(t).rlike("|".join(w.replace(".", "\\.") for w in AUTHOR_TEXT_STOP[rule]))
    if rule == "el_pais":
        name = F.trim(F.regexp_replace(t, "^[bB]y\\s+", ""))
        return F.when(clean & (F.length(t) <= 100) & (F.length(name) > 1), name)
    if rule == "okdiario":
        name = F.trim(F.regexp_replace(t, "\\s*[|@].*$", ""))
        return F.when(clean & (F.length(t) > 3) & (F.length(name) > 3), name)
    return F.when(clean & (F.length(t) < 100), t)


def flat_authors(html, rule: str = "el_pais") -> Column:
    """HTM3/HTM6 (flat form): distinct texts of elements with ``rel=author``, ``itemprop=author``
    or one of the rule's author classes, in document order, without those that the rule's length and
    stop words refuse. An element inside such an element belongs to its text; sibling and ancestor
    selectors are not read."""
    classes = "|".join(sorted(AUTHOR_CLASSES[rule], key=len, reverse=True))
    mark = (f"(?:(?:rel|itemprop)\\s*=\\s*[\"']?author\\b"
            f"|class\\s*=\\s*(?:\"(?:[^\"]*\\s)?(?:{classes})(?:\\s[^\"]*)?\"|'(?:[^']*\\s)?(?:{classes})(?:\\s[^']*)?'"
            f"|(?:{classes})(?=[\\s>])))")
    whole = f"(?is)<(a|span|div|p|address|li|strong)\\b(?=[^>]*\\b{mark})[^>]*>(.*?)</\\1>"
    texts = F.transform(F.transform(F.regexp_extract_all(_c(html), F.lit(whole), 2), tag_text), lambda t: _author_text(t, rule))
    return F.array_distinct(F.filter(texts, lambda t: t.isNotNull()))


def breadcrumb_second(html) -> Column:
    """HTM9: text of the second ``<li>`` of an ``<ol class="breadcrumb">``."""
    ol = first_tag_inner(html, "ol", 'class="[^"]*\\bbreadcrumb\\b[^"]*"')
    items = F.regexp_extract_all(ol, F.lit("(?is)<li\\b[^>]*>(.*?)</li>"), 1)
    return F.nullif(tag_text(F.get(items, 1)), F.lit(""))


_HREF = "(?is)<a\\b[^>]*?\\bhref\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"


def links(html) -> Column:
    """HTM10: every ``<a href=...>`` value, however quoted, in document order."""
    return F.transform(F.regexp_extract_all(_c(html), F.lit(_HREF), 1), _unquoted)


def paywall_flag(html) -> Column:
    """PRJ11: 'LOCKED' when the page declares isAccessibleForFree false, else 'FREE'."""
    return F.when(F.coalesce(_c(html).contains('isAccessibleForFree": false'), F.lit(False)),
                  F.lit("LOCKED")).otherwise(F.lit("FREE"))


def article_paragraphs(html) -> Column:
    """HTM8: texts of ``<p>`` elements inside the ``<article>`` elements, without those in
    navigation, asides, headers and footers.

    A ``<p>`` ends at ``</p>``, at the next ``<p>`` or at the end of the article,
    as an HTML parser closes an unclosed paragraph.
    """
    body = F.regexp_replace(_c(html), "(?is)<(nav|aside|footer|header)\\b[^>]*>.*?</\\1>", "")
    arts = F.regexp_extract_all(body, F.lit("(?is)<article\\b[^>]*>(.*?)</article>"), 1)
    pieces = F.flatten(F.transform(arts, lambda a: F.slice(F.split(a, "(?i)<p\\b[^>]*>"), 2, 1 << 30)))
    return F.transform(pieces, lambda p: tag_text(F.split(p, "(?i)</p>", 2).getItem(0)))


def main_text(html, min_chars: int = 30) -> Column:
    """HTM8 + FLT16 (regex form): paragraphs longer than ``min_chars`` joined by a space."""
    ps = F.filter(article_paragraphs(html), lambda p: F.length(p) > min_chars)
    return F.array_join(ps, " ")
