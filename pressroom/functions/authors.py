"""Author-list cleaning (AUT1-AUT11, AGG4) as higher-order array expressions.

Each rule maps ``array<string> -> array<string>`` with ``transform``/``filter``
and ``rlike``/``regexp_replace``; no Python UDF.  Java regex is ASCII by
default, so every pattern runs with ``(?U)`` (Unicode classes and case), which
matches how Python's ``re`` treats ``str`` patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PY_WHITESPACE, capitalize, py_title


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the characters of PY_WHITESPACE, for trimming without a regex.
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _py_strip(x: Column) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(x, F.lit(_BLANKS))


# White space other than one blank between words: all that collapsing has to change.
_NOT_ONE_BLANK = f" *{PY_WHITESPACE.replace(' ', '', 1)}{PY_WHITESPACE}*|  +"


def _py_collapse(x: Column) -> Column:
    """``' '.join(s.split())``."""
    return _py_strip(F.regexp_replace(x, _NOT_ONE_BLANK, " "))


def _spaces(x: Column) -> Column:
    """The number of single spaces (words less one, in a collapsed text)."""
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _cap_words(x: Column) -> Column:
    """``' '.join(w.capitalize() for w in s.split())`` of a collapsed text."""
    return F.array_join(F.transform(F.split(x, " "), capitalize), " ")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ci_distinct(arr) -> Column:
    """AGG4: case-insensitive distinct, first spelling and order kept.

    The list is sorted by lower-cased name and place, the first of each name stays, and the
    names go back to their places: n log n in the list's length, in its row."""
    keyed = F.transform(_c(arr), lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x")))

    def firsts(s):
        before = F.concat(F.slice(F.transform(s, lambda _: F.lit(None).cast("string")), 1, 1),
                          F.slice(F.transform(s, lambda e: e.k), F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))))
        new = F.zip_with(s, before, lambda e, k: F.when((e.i == s.getItem(0).i) | ~e.k.eqNullSafe(k), F.struct(e.i.alias("i"), e.x.alias("x"))))
        return F.filter(new, lambda e: e.isNotNull())
    return F.transform(F.array_sort(_let(F.array_sort(keyed), firsts)), lambda e: e.x)


def _nonblank(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull() & (x != ""))


def _staged(names: Column, *stages) -> Column:
    """Each stage applied to every name of a list. A stage's result is computed once per name, however
    often the next stage names it; null is a rejected name and stays one."""
    for stage in stages:
        names = F.transform(names, stage)
    return names


# ----------------------------------------------------------------- AUT1 strict
# Exclusion patterns of the strict rule (matched case-insensitively).
STRICT_EXCLUDE = [
    r'\bpor\b', r'\bde\b', r'\bla\b', r'\bel\b', r'\by\b', r'\bpara\b', r'\bcon\b',
    r'\bactualizado\b', r'\bpublicado\b', r'\bcompartir\b', r'\btwitter\b', r'\bfacebook\b',
    r'\binstagram\b', r'\bwhatsapp\b', r'\btelegram\b', r'\bemail\b', r'\bcorreo\b',
    r'\bcontacto\b', r'\bweb\b', r'\bpágina\b', r'\bpagina\b', r'\bpágina web\b',
    r'\bseguir\b', r'\bseguir leyendo\b', r'\bnoticias relacionadas\b',
    r'\bmas en\b', r'\bmás en\b', r'\bver más\b', r'\bver mas\b', r'\bseguir leyendo\b',
    r'\bcomentarios\b', r'\bcomentar\b', r'\bcomenta\b', r'\bcomentario\b',
    r'\bmin\b', r'\bde lectura\b', r'\blectura\b', r'\bminuto\b', r'\bminutos\b',
    r'\b\d+\s*[a-z]*\s*de\s*lectura\b',
    r'\b\d+\s*[a-z]*\s*min\b',
    r'\b\d+/\d+/\d+\b',
    r'\b\d+:\d+\b',
    r'\b\d+\s*[a-z]*\s*comentarios?\b',
    r'^[^a-záéíóúüñ\s]+$',
    r'^[\W_]+$',
    r'^[0-9\s]+$',
    r'\b(redacci[óo]n|redaccion)\b',
    r'\b(equipo|staff|editorial|edici[óo]n|nota de prensa|comunicado|agencias?|ef[ei]?)\b',
    r'\b(por\s+)?(el|la|los|las)\s+',
    r'\b(por|de|en|a|con|para|porque|según)\b',
    r'\b(por|de|en|a|con|para|porque|según)\s+',
    r'\s+(por|de|en|a|con|para|porque|según)\b',
    r'\b(por|de|en|a|con|para|porque|según)\s+',
    r'\b(redacci[óo]n|redaccion|equipo|staff|editorial|edici[óo]n|nota de prensa|comunicado|agencias?|ef[ei]?)\b',
    r'\b(redacci[óo]n|redaccion|equipo|staff|editorial|edici[óo]n|nota de prensa|comunicado|agencias?|ef[ei]?)\s+[a-z]+',
    r'\b(redacci[óo]n|redaccion|equipo|staff|editorial|edici[óo]n|nota de prensa|comunicado|agencias?|ef[ei]?)\s+[a-z]+\s+[a-z]+',
    r'\b(redacci[óo]n|redaccion|equipo|staff|editorial|edici[óo]n|nota de prensa|comunicado|agencias?|ef[ei]?)\s+[a-z]+\s+[a-z]+\s+[a-z]+',
]
# Name shapes of the strict rule (case-sensitive; one must match).
STRICT_INCLUDE = [
    r'^[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+(?:\s+[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+){1,3}$',
    r'^[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+(?:\s+[a-záéíóúüñ]+)*\s+[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+$',
    r'^[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+(?:\s+[A-ZÁÉÍÓÚÜÑ][a-záéíóúüñ]+){1,2}(?:\s+[A-ZÁÉÍÓÚÜÑ]\.?)?$',
]
STRICT_MAX_LEN = 50

_EXCLUDE_RE = "(?iU)" + "|".join(f"(?:{p})" for p in STRICT_EXCLUDE)
_INCLUDE_RE = "(?U)" + "|".join(f"(?:{p})" for p in STRICT_INCLUDE)


def _strict_stages(max_len: int = STRICT_MAX_LEN) -> list:
    """AUT1 on one name. The anchored name shapes go first: they refuse most names at the first word."""
    return [_py_strip,
            lambda y: F.when((F.length(y) <= max_len) & y.rlike(_INCLUDE_RE) & ~y.rlike(_EXCLUDE_RE),
                             F.btrim(F.regexp_replace(y, PY_WHITESPACE + "+", " "), F.lit(" ,.-_|"))),
            lambda z: F.when((F.length(z) >= 3) & (_spaces(z) >= 1), z)]


def clean_strict(arr, max_len: int = STRICT_MAX_LEN) -> Column:
    """AUT1: length cap, exclusions, name shapes, edge clean-up, >=3 chars and >=2 words, ci-distinct."""
    return _cleaned(_c(arr), _strict_stages(max_len))


def _cleaned(arr: Column, stages) -> Column:
    return ci_distinct(F.filter(_staged(_nonblank(arr), *stages), lambda x: x.isNotNull()))


# ----------------------------------------------------------------- AUT2/AUT3 strip
# Phrases removed (replaced by a space) by the 20minutos rules, in order.
STRIP_PATTERNS = [
    r'(?i)redactor[\w\s]*',
    r'(?i)periodista[\w\s]*',
    r'(?i)en \w+',
    r'(?i)en linkedin',
    r'(?i)en x',
    r'(?i)en twitter',
    r'(?i)ver sus artículos',
    r'(?i)líder en los diarios más leídos',
    r'(?i)consulta las últimas noticias',
    r'(?i)diario gratuito',
    r'(?i)referencia en españa',
    r'\s+',
    r'[\.,;]$',
]


_PHRASES = [p for p in STRIP_PATTERNS if p.startswith("(?i)")]
_ANY_PHRASE = "(?iU)" + "|".join(p.removeprefix("(?i)") for p in _PHRASES)


def _strip_phrases(x: Column) -> Column:
    """The phrases replaced by a space, one after the other; a text that holds none is left alone."""
    y = x
    for p in _PHRASES:
        y = F.regexp_replace(y, "(?iU)" + p.removeprefix("(?i)"), " ")
    return F.when(x.rlike(_ANY_PHRASE), y).otherwise(x)


#: AUT2 on one name: phrases out, non-word characters out, <=5 words, >=3 chars, capitalised. The
#: last two fixed patterns (white space, a final mark) are part of "non-word to one space".
_STRIP_STAGES = [
    _py_strip, _strip_phrases,
    lambda y: F.btrim(F.regexp_replace(y, "(?U)[^\\wáéíóúÁÉÍÓÚñÑ-]+", " "), F.lit(" ")),
    lambda y: F.when((F.length(y) >= 3) & (_spaces(y) <= 4), _cap_words(y)),
    lambda z: F.when(F.length(z) > 2, z)]

#: AUT3 on one name: phrases out, a final mark out, collapsed, kept when 3..50 characters.
_STRIP50_STAGES = [
    _py_strip, _strip_phrases, lambda y: F.regexp_replace(y, _NOT_ONE_BLANK, " "),
    lambda y: _py_collapse(F.regexp_replace(y, "[\\.,;]$", " ")),
    lambda y: F.when(F.length(y).between(3, 50), y)]


def split_authors(c) -> Column:
    """AUT7: a byline split on ',' ';' and ' y ' when it holds ',' or ' y '; else one item."""
    s = _c(c)
    multi = s.contains(",") | s.contains(" y ")
    return F.when(s.isNull(), F.array().cast("array<string>")) \
        .when(multi, F.split(s, "[,;]|(?U)\\s+y\\s+")).otherwise(F.array(s))


def or_default(out: Column, default: str | None) -> Column:
    if default is None:
        return out
    return _let(out, lambda a: F.when(F.size(a) > 0, a).otherwise(F.array(F.lit(default))))


def clean_strip(arr, default: str | None = "20minutos") -> Column:
    """AUT2 + AUT7 over a list: split multi-name values, clean each, ci-distinct, default."""
    parts = F.flatten(F.transform(_nonblank(_c(arr)), split_authors))
    return or_default(_cleaned(parts, _STRIP_STAGES), default)


def clean_strip50(arr) -> Column:
    """AUT3 over a list."""
    return _cleaned(_c(arr), _STRIP50_STAGES)


# ----------------------------------------------------------------- AUT4 cut
# The El País clean-up pattern and rejected names.
CUT_NOISE = (r'\b(por|by|de|en|at|ver perfil|ver bi[oó]graf[ií]a|@[^\s]+|'
             r'\d+\s*(?:min|hora|d[ií]a|semanas?|mes|años?)\s*(?:de lectura)?\s*|\s*\|\s*[^|]*$)')
CUT_REJECT = ['redacción', 'redaccion', 'elpais', 'el país', '']


#: AUT4 on one name: cut at comma/newline, drop noise words, special characters; capitalised.
_CUT_STAGES = [
    lambda x: F.regexp_replace(F.regexp_replace(x, "(?dU)\\s*[,\\n].*$", ""), _NOT_ONE_BLANK, " "),
    lambda y: F.regexp_replace(F.regexp_replace(y, "(?iU)" + CUT_NOISE, ""), "(?U)[^\\w\\sáéíóúÁÉÍÓÚñÑ-]", ""),
    lambda y: F.btrim(y, F.lit(" -")),
    lambda y: F.when((F.length(y) >= 2) & ~F.lower(y).isin(*CUT_REJECT), _py_collapse(y)),
    _cap_words]


def clean_cut(arr, default: str | None = "Unknown") -> Column:
    return or_default(_cleaned(_c(arr), _CUT_STAGES), default)


# ----------------------------------------------------------------- AUT5 okd
# OKDiario clean-up patterns, function words and staff words.
OKD_DATE = r'\d{1,2}[\/\.]\d{1,2}[\/\.]\d{2,4}'
OKD_TIME = r'\d{1,2}[h:]\d{2}'
OKD_WORDS = (r'\b(?:por|de|la|el|los|las|en|a|y|e|o|u|del|al|un|una|unos|unas|es|son|para|con|'
             r'porque|según)\b')
OKD_STAFF = ['redacción', 'redaccion', 'equipo', 'staff', 'okdiario']


#: AUT5 on one name: dates, times and function words out; no staff, not only symbols, four characters or more.
_OKD_STAGES = [
    lambda x: F.regexp_replace(x, "[\\n\\t•·]", " "),
    lambda y: F.when(y.rlike("[0-9]"), F.regexp_replace(F.regexp_replace(_py_strip(y), OKD_DATE, ""), OKD_TIME, "")).otherwise(_py_strip(y)),
    lambda y: _py_collapse(F.regexp_replace(y, "(?iU)" + OKD_WORDS, "")),
    lambda y: F.when((F.length(y) > 3) & ~F.lower(y).rlike("|".join(OKD_STAFF)) & ~y.rlike("(?U)^[\\W\\d_]+$"), y)]


def clean_okd(arr) -> Column:
    """AUT5 over a list, ci-distinct."""
    return _cleaned(_c(arr), _OKD_STAGES)


# ----------------------------------------------------------------- AUT6 stoplist
def clean_stoplist(arr, stop: list[str], default: str, strip_por: bool = False) -> Column:
    """AUT6: drop names in a per-site stop list (case-insensitive); default when none remain."""
    a = _nonblank(_c(arr))
    if strip_por:
        a = F.transform(a, lambda x: F.regexp_replace(_py_collapse(x), "(?iU)^por\\s+", ""))
    else:
        a = F.transform(a, _py_strip)
    a = F.filter(a, lambda x: (x != "") & ~F.lower(x).isin(*stop))
    return or_default(a, default)


# Per-site stop lists and defaults of the stoplist rule.
STOPLISTS = {
    "infobae": (['redacción', 'redaccion', 'infobae'], 'Redacción Infobae', False),
    "voz_populi": (['redacción', 'redaccion', 'vozpópuli', 'vozpopuli'], 'Redacción Vozpópuli', True),
}


# ----------------------------------------------------------------- AUT8-AUT11
def name_from_email(c) -> Column:
    """AUT8: local part of an e-mail, dots to spaces, title-cased."""
    return py_title(F.replace(F.substring_index(_c(c), "@", 1), F.lit("."), F.lit(" ")))


def meta_author_value(c) -> Column:
    """AUT9: strip a leading URL prefix and a leading '@'."""
    x = F.trim(_c(c))
    return F.regexp_replace(F.regexp_replace(x, "^https?://[^/]+/", ""), "^@", "")


BYLINE_RE = r'(?:^|\s)[Pp]or\s+([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)+)'


def byline_names(c) -> Column:
    """AUT11: 'Por Nombre Apellido' in a byline text -> the name (kept when >3 chars)."""
    m = F.regexp_extract(_c(c), "(?U)" + BYLINE_RE, 1)
    m = _py_strip(m)
    return F.when(F.length(m) > 3, F.array(m)).otherwise(F.array().cast("array<string>"))


ONE_NAME = {"strict": _strict_stages(), "strip": _STRIP_STAGES, "strip50": _STRIP50_STAGES, "cut": _CUT_STAGES, "okd": _OKD_STAGES}


def clean_name(x, rule: str) -> Column:
    """A rule on one name: the cleaned name, or null when the name is rejected."""
    return F.get(_staged(F.array(_c(x)), *ONE_NAME[rule]), F.lit(0))


def clean_name_cut(x) -> Column:
    """AUT4 on one name; '' for a rejected name (as the reference does)."""
    return F.coalesce(clean_name(x, "cut"), F.lit(""))


def clean_each(arr, rule: str) -> Column:
    """A rule on every name of a list, rejected names dropped, repeats kept."""
    return F.filter(_staged(_nonblank(_c(arr)), *ONE_NAME[rule]), lambda x: x.isNotNull())


def clean_rows(df, key: str, pos: str, name: str, rule: str = "strict"):
    """Row-wise form of a rule for names spread over many rows: one (key, pos, name) row per candidate.

    Names are cleaned in their rows; the case-insensitive first-kept distinct is an aggregation
    (partial, map-side) and the list is rebuilt in ``pos`` order per key. Returns (key, authors array) for
    keys with at least one accepted name.
    """
    parts = split_authors(F.col(name)) if rule == "strip" else F.array(name)
    cleaned = df.filter(F.col(name) != "").select(key, pos, F.posexplode(_staged(parts, *ONE_NAME[rule])).alias("_s", "_a"))
    cleaned = cleaned.filter(F.col("_a").isNotNull()).withColumn("_p", F.struct(F.col(pos).alias("p"), F.col("_s").alias("s")))
    firsts = cleaned.groupBy(key, F.lower("_a").alias("_k")).agg(F.min(F.struct("_p", "_a")).alias("_f"))
    return firsts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("_f")), lambda s: s["_a"]).alias("authors"))


def clean_authors(arr, rule: str = "strict", site: str | None = None) -> Column:
    """Dispatch on the per-site author rule name."""
    if rule == "strict":
        return clean_strict(arr)
    if rule == "strip":
        return clean_strip(arr, default=None)      # defaults belong to the caller (AUT10)
    if rule == "strip50":
        return clean_strip50(arr)
    if rule == "cut":
        return clean_cut(arr, default=None)
    if rule == "okd":
        return clean_okd(arr)
    if rule == "stoplist":
        stop, default, por = STOPLISTS[site or "infobae"]
        return clean_stoplist(arr, stop, default, por)
    raise ValueError(f"unknown author rule {rule!r}")


def author_precedence(extracted, meta, byline, rule: str = "strict", default: str = "Redacción") -> Column:
    """AUT10: cleaned extracted authors, else cleaned meta authors, else cleaned byline, else default."""
    empty = F.array().cast("array<string>")

    def cl(a):
        c = clean_authors(F.coalesce(_c(a), empty), rule)
        return _let(c, lambda a: F.when(F.size(a) > 0, a))
    byl = F.when(_c(byline).isNotNull(), F.array(_c(byline)))
    return F.coalesce(cl(extracted), cl(meta), cl(byl), F.array(F.lit(default)))
