"""URL scalar functions (STR5-STR7, URL1-URL7, SNK5) as Column expressions.

All rules work on ``split`` arrays with higher-order functions; no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capitalize, py_title, slug_title

# Path pieces ignored by the base section rule.
SECTION_STOP_WORDS = ["www", "http", "https", "com", "es", "noticias",
                      "actualidad", "ultimas-noticias", "articulo", "noticia"]

# Section code -> display name for the mapped rule (14 entries).
SECTION_NAMES = {
    "espana": "España",
    "internacional": "Internacional",
    "economia": "Economía",
    "tecnologia": "Tecnología",
    "ciencia": "Ciencia",
    "cultura": "Cultura",
    "deportes": "Deportes",
    "television": "Televisión",
    "gente": "Gente",
    "salud": "Salud",
    "viajes": "Viajes",
    "motor": "Motor",
    "moda": "Moda",
    "gastro": "Gastronomía",
}

# First pieces skipped by the 'capitalized' rule and the
# 'breadcrumb' rule, and breadcrumb labels that do not count as a section.
CAPITALIZED_SKIP = ["es", "america", "america-latina"]
BREADCRUMB_SKIP_PIECES = ["noticias", "actualidad", "ultima-hora"]
BREADCRUMB_SKIP_LABELS = ["inicio", "portada"]

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_url(c) -> Column:
    """STR5: cut at '#', then at '?', trim."""
    return F.trim(F.substring_index(F.substring_index(_c(c), "#", 1), "?", 1))


def domain(c) -> Column:
    """STR6: host part (netloc) of an absolute URL, else the first piece."""
    col = _c(c)
    with_scheme = F.regexp_extract(col, _SCHEME + "([^/?#]*)", 1)
    bare = F.regexp_extract(col, "^([^/?#]*)", 1)
    return F.when(col.rlike(_SCHEME), with_scheme).otherwise(bare)


def strip_scheme_host(c) -> Column:
    """Host of a scheme-stripped URL: removes 'https://' / 'http://' then takes piece 0."""
    col = F.replace(F.replace(_c(c), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.split(col, "/", 2).getItem(0)


def url_path(c) -> Column:
    """Path component as ``urllib.parse.urlparse`` returns it (no query/fragment)."""
    col = _c(c)
    with_scheme = F.regexp_extract(col, _SCHEME + "[^/?#]*([^?#]*)", 1)
    net_only = F.regexp_extract(col, "^//[^/?#]*([^?#]*)", 1)
    bare = F.regexp_extract(col, "^([^?#]*)", 1)
    return (F.when(col.rlike(_SCHEME), with_scheme)
            .when(col.startswith("//"), net_only)
            .otherwise(bare))


def path_pieces(c) -> Column:
    """Non-empty pieces of the URL path, in order."""
    return F.filter(F.split(url_path(c), "/"), lambda p: p != "")


def absolute_url(base, href) -> Column:
    """STR7: resolve an href against the page/site URL as ``urljoin`` does for the usual forms:
    absolute, scheme-relative ('//'), root-relative ('/') and relative (replaces the last path
    segment of the base; dot segments are not collapsed)."""
    b, h = _c(base), _c(href)
    scheme = F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_nq = F.substring_index(F.substring_index(b, "#", 1), "?", 1)
    directory = F.when(base_nq.rlike(_SCHEME + "[^/]*/"), F.regexp_replace(base_nq, "[^/]*$", "")) \
        .otherwise(F.concat(base_nq, F.lit("/")))
    return (F.when(h.rlike("^https?://"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(root, h))
            .otherwise(F.concat(directory, h)))


def is_article_link(c, marker: str = "/noticias/", suffix: str = ".html") -> Column:
    """FLT14: link contains the article marker and ends with the suffix."""
    col = _c(c)
    return col.contains(marker) & col.endswith(suffix)


def sections_base(url) -> Column:
    """URL1: struct(section, subsection) by the generic rule."""
    stop = F.array(*[F.lit(w) for w in SECTION_STOP_WORDS])
    pieces = F.filter(
        F.split(url_path(url), "/"),
        lambda p: (F.trim(p) != "")
        & ~F.array_contains(stop, p)
        & ~F.regexp_replace(p, "-", "").rlike("^\\p{Nd}+$")
        & (F.length(p) > 2),
    )
    first = F.coalesce(F.get(pieces, 0), F.lit("general"))
    second = F.coalesce(F.get(pieces, 1), F.lit(""))
    return F.struct(F.trim(slug_title(first)).alias("section"),
                    F.trim(slug_title(second)).alias("subsection"))


def sections_nodate(url) -> Column:
    """URL2: pieces after the host (query kept), pieces starting '20' dropped."""
    col = F.replace(F.replace(_c(url), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    has_path = col.contains("/")
    rest = F.split(col, "/", 2).getItem(1)
    pieces = F.filter(F.split(rest, "/"), lambda p: (p != "") & ~p.startswith("20"))
    section = F.when(has_path, slug_title(F.coalesce(F.get(pieces, 0), F.lit("")))).otherwise(F.lit(""))
    sub = F.when(has_path, slug_title(F.coalesce(F.get(pieces, 1), F.lit("")))).otherwise(F.lit(""))
    return F.struct(section.alias("section"), sub.alias("subsection"))


def section_first(url) -> Column:
    """URL3: first path piece, raw; '' when there is none."""
    return F.coalesce(F.get(path_pieces(url), 0), F.lit(""))


def section_name(code) -> Column:
    """JON8: display name from the fixed map, else ``capitalize``."""
    m = F.create_map(*[x for k, v in SECTION_NAMES.items() for x in (F.lit(k), F.lit(v))])
    col = _c(code)
    return F.coalesce(F.element_at(m, col), capitalize(col))


def sections_mapped(url) -> Column:
    """URL4: mapped section and year-aware subsection."""
    p = path_pieces(url)
    n = F.size(p)
    p1 = F.get(p, 1)
    year_second = (n > 2) & p1.rlike("^\\p{Nd}+$") & (F.length(p1) == 4)
    section = F.when(n > 1, section_name(F.get(p, 0))).otherwise(F.lit(""))
    sub = (F.when(n <= 1, F.lit(""))
           .when(year_second, F.when(n > 3, section_name(F.get(p, 2))).otherwise(F.lit("")))
           .otherwise(section_name(p1)))
    return F.struct(section.alias("section"), sub.alias("subsection"))


def section_capitalized(url, breadcrumb=None) -> Column:
    """URL5: first piece capitalised unless a skipped prefix; then breadcrumb; then 'General'."""
    first = F.split(F.regexp_replace(url_path(url), "^/+|/+$", ""), "/").getItem(0)
    skip = F.array(*[F.lit(w) for w in CAPITALIZED_SKIP])
    crumb = F.lit(None).cast("string") if breadcrumb is None else _c(breadcrumb)
    return (F.when(~F.array_contains(skip, first), capitalize(first))
            .otherwise(F.coalesce(crumb, F.lit("General"))))


def section_breadcrumb(url, breadcrumb=None) -> Column:
    """URL6: breadcrumb label unless generic; else first piece unless generic; else 'General'."""
    crumb = F.lit(None).cast("string") if breadcrumb is None else _c(breadcrumb)
    labels = F.array(*[F.lit(w) for w in BREADCRUMB_SKIP_LABELS])
    pieces = F.array(*[F.lit(w) for w in BREADCRUMB_SKIP_PIECES])
    first = F.split(F.regexp_replace(url_path(url), "^/+|/+$", ""), "/").getItem(0)
    crumb_ok = crumb.isNotNull() & (crumb != "") & ~F.array_contains(labels, F.lower(crumb))
    first_ok = (first != "") & ~F.array_contains(pieces, F.lower(first))
    return (F.when(crumb_ok, crumb)
            .when(first_ok, capitalize(first))
            .otherwise(F.lit("General")))


def section_or_tag(section, categories) -> Column:
    """URL7: feed category (first tag, trimmed) when the URL gave no section."""
    s = _c(section)
    tag = F.trim(F.get(_c(categories), 0))
    return F.when((s.isNull()) | (s == ""), F.coalesce(tag, F.lit(""))).otherwise(s)


def source_key(name) -> Column:
    """SNK5/STR10: lower-case name, every non-alphanumeric character -> '_'."""
    return F.regexp_replace(F.lower(_c(name)), "[^\\p{L}\\p{N}]", "_")


def title_from_slug(url) -> Column:
    """PRJ1 title: last piece of the '/'-trimmed URL, '-'-split, title-cased, space-joined."""
    parts = F.split(F.regexp_replace(_c(url), "^/+|/+$", ""), "/")
    last = F.element_at(parts, -1)
    words = F.filter(F.split(last, "-"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: py_title(w)), " ")
