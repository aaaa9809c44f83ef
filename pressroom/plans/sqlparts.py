"""DuckDB SQL fragments for the oracle side of the driver check.

These are the SQL statements of the same rules the Column expressions in
``pressroom.functions`` implement; they exist only to express the oracle
queries in ``oracle.py`` readably.
"""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE
from ..functions.urls import SECTION_NAMES, SECTION_STOP_WORDS

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def title(e: str) -> str:
    """Python str.title(): upper after a non-letter, lower otherwise."""
    chars = f"string_split(lower({e}), '')"
    return (f"array_to_string(list_transform({chars}, lambda ch, i: CASE WHEN i = 1 "
            f"OR NOT regexp_matches({chars}[i - 1], '^\\p{{L}}$') THEN upper(ch) ELSE ch END), '')")


def slug_title(e: str) -> str:
    return title(f"replace({e}, '-', ' ')")


def capitalize(e: str) -> str:
    return f"(upper(substr({e}, 1, 1)) || lower(substr({e}, 2)))"


def url_path(u: str) -> str:
    return (f"(CASE WHEN regexp_matches({u}, '{SCHEME}') "
            f"THEN regexp_extract({u}, '{SCHEME}[^/?#]*([^?#]*)', 1) "
            f"WHEN starts_with({u}, '//') THEN regexp_extract({u}, '^//[^/?#]*([^?#]*)', 1) "
            f"ELSE regexp_extract({u}, '^([^?#]*)', 1) END)")


def path_pieces(u: str) -> str:
    return f"list_filter(string_split({url_path(u)}, '/'), lambda p: p <> '')"


def domain(u: str) -> str:
    return (f"(CASE WHEN regexp_matches({u}, '{SCHEME}') "
            f"THEN regexp_extract({u}, '{SCHEME}([^/?#]*)', 1) "
            f"ELSE regexp_extract({u}, '^([^/?#]*)', 1) END)")


def canonical(u: str) -> str:
    return f"trim(split_part(split_part({u}, '#', 1), '?', 1))"


def sections_base(u: str) -> tuple[str, str]:
    stop = "[" + ", ".join(q(w) for w in SECTION_STOP_WORDS) + "]"
    pieces = (f"list_filter(string_split({url_path(u)}, '/'), lambda p: trim(p) <> '' "
              f"AND NOT list_contains({stop}, p) "
              f"AND NOT regexp_matches(replace(p, '-', ''), '^\\p{{Nd}}+$') AND length(p) > 2)")
    sec = "trim(" + slug_title(f"coalesce(({pieces})[1], 'general')") + ")"
    sub = "trim(" + slug_title(f"coalesce(({pieces})[2], '')") + ")"
    return sec, sub


def section_name(e: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in SECTION_NAMES.items())
    return f"(CASE {e} {cases} ELSE {capitalize(e)} END)"


def clean_ws(e: str) -> str:
    return f"trim(regexp_replace({e}, '{PY_WHITESPACE}+', ' ', 'g'))"


ENTITY_SQL = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
              ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def unescape(e: str) -> str:
    for k, v in ENTITY_SQL:
        e = f"replace({e}, {q(k)}, {q(v)})"
    return e


def tag_text(e: str) -> str:
    return clean_ws(unescape(f"regexp_replace({e}, '<[^>]*>', '', 'g')"))


def to_rome(ts: str) -> str:
    return f"timezone('Europe/Rome', ({ts}) AT TIME ZONE 'UTC')"


def fmt_ts(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
