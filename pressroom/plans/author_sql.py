"""The author queries in DuckDB SQL.

RE2 knows word characters and boundaries of ASCII only, so both are spelt out: a word character
is ``[\\p{L}\\p{N}_]``, a boundary before or after a word is the start, the end or another character.
Where text is removed at boundaries, words are marked first (start \\x01, end \\x02) or taken apart.
"""

from __future__ import annotations

from ..functions import authors as A
from ..functions.text import PY_WHITESPACE
from .sqlparts import q

W, NOT_W, S = "[\\p{L}\\p{N}_]", "[^\\p{L}\\p{N}_]", PY_WHITESPACE
_KEPT_MARKS = "áéíóúÁÉÍÓÚñÑ-"


def _first_upper(w: str) -> str:
    return f"(CASE substr({w}, 1, 1) WHEN 'ß' THEN 'Ss' ELSE upper(substr({w}, 1, 1)) END || lower(substr({w}, 2)))"


def _sub(e: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(by)}, 'g')"


def _strip(e: str) -> str:
    return _sub(e, f"^{S}+|{S}+$")


def _collapse(e: str) -> str:
    return f"trim({_sub(e, S + '+', ' ')})"


def _classes(pattern: str) -> str:
    """Python classes of a fixed pattern spelt out, boundaries as neighbours (for matching only)."""
    out = pattern.replace("[\\W_]", "[^\\p{L}\\p{N}]").replace("[\\w\\s]", f"(?:{W}|{S})")
    out = out.replace("a-záéíóúüñ\\s]", "a-záéíóúüñ" + S[1:]).replace("[0-9\\s]", "[0-9" + S[1:])
    if out.startswith("\\b"):
        out = f"(?:^|{NOT_W})" + out[2:]
    return out.replace("\\b", f"(?:$|{NOT_W})").replace("\\s", S).replace("\\d", "\\p{Nd}").replace("\\w", W)


def _words(e: str) -> str:
    return f"(length({e}) - length(replace({e}, ' ', '')) + 1)"


def _cap(e: str) -> str:
    return f"array_to_string(list_transform(string_split({e}, ' '), lambda w: {_first_upper('w')}), ' ')"


def _phrases(e: str) -> str:
    for p in A.STRIP_PATTERNS:
        if p.startswith("(?i)"):
            e = _sub(e, "(?i)" + _classes(p.removeprefix("(?i)")), " ")
    return e


def _steps(rule: str) -> tuple[list[str], str]:
    """Expressions of one name x, each of the one before, and the condition that the last one is kept."""
    if rule == "strict":
        keep = (f"length(s0) BETWEEN 1 AND {A.STRICT_MAX_LEN} AND regexp_matches(s0, {q('|'.join('(?:' + _classes(p) + ')' for p in A.STRICT_INCLUDE))}) "
                f"AND NOT regexp_matches(s0, {q('(?i)' + '|'.join('(?:' + _classes(p) + ')' for p in A.STRICT_EXCLUDE))}) "
                f"AND length(s1) >= 3 AND {_words('s1')} >= 2")
        return [_strip("x"), f"trim({_collapse('s0')}, ' ,.-_|')"], keep
    if rule == "strip":
        return ([_phrases(_strip("x")), f"trim({_sub('s0', f'[^\\p{{L}}\\p{{N}}_{_KEPT_MARKS}]+', ' ')})", _cap("s1")],
                f"length(s1) >= 3 AND {_words('s1')} <= 5 AND length(s2) > 2")
    if rule == "strip50":
        return ([_phrases(_strip("x")), _collapse(_sub(_sub("s0", S + "+", " "), "[\\.,;]$", " "))], "length(s1) BETWEEN 3 AND 50")
    if rule == "cut":
        unit = "(?:min|hora|d[ií]a|semanas?|mes|años?)"
        noise = ("(?i)\\x01(?:por|by|de|en|at|ver\\x02 \\x01perfil|ver\\x02 \\x01bi[oó]graf[ií]a|"
                 f"\\p{{Nd}}+(?:\\x02 \\x01)?{unit}(?:(?:\\x02 \\x01)?de\\x02 \\x01lectura)?(?:\\x02 )?)"
                 "|\\x02@[^ \\x02]+(?:\\x02[^ \\x02]+)*|\\x02 ?\\| ?[^|]*$")
        marked = _sub("s0", f"({W}+)", "\x01\\1\x02")
        return ([_sub(_sub("x", f"{S}*[,\\n].*$"), S + "+", " "),
                 f"trim({_sub(_sub(marked, noise), f'[^\\p{{L}}\\p{{N}}_ {_KEPT_MARKS}]')}, ' -')", _cap(_collapse("s1"))],
                f"length(s1) >= 2 AND lower(s1) NOT IN ({', '.join(map(q, A.CUT_REJECT))})")
    if rule == "okd":
        words = A.OKD_WORDS.removeprefix("\\b(?:").removesuffix(")\\b").split("|")
        dated = _sub(_sub(_strip(_sub("x", "[\\n\\t•·]", " ")), A.OKD_DATE), A.OKD_TIME)
        parts = f"regexp_extract_all(s0, {q(f'{W}+|{NOT_W}+')})"
        return ([dated, _collapse(f"array_to_string(list_filter({parts}, lambda w: lower(w) NOT IN ({', '.join(map(q, words))})), '')")],
                f"length(s1) > 3 AND NOT regexp_matches(lower(s1), {q('|'.join(A.OKD_STAFF))}) AND NOT regexp_matches(s1, {q(f'^(?:{NOT_W}|[_\\p{{Nd}}])+$')})")
    raise ValueError(rule)


def author_sql(rule: str) -> str:
    steps, keep = _steps(rule)
    title = f"array_to_string(list_transform(string_split(p, ' '), lambda w: {_first_upper('w')}), ' ')"
    # AUT7: a byline of several names is taken apart first
    parts = f"CASE WHEN contains(x, ',') OR contains(x, ' y ') THEN string_split_regex(x, {q(f'[,;]|{S}+y{S}+')}) ELSE [x] END" if rule == "strip" else "[x]"
    ctes = [f"t0 AS (SELECT doc_id, i, j, {steps[0]} AS s0 FROM names)"]
    for k, e in enumerate(steps[1:], 1):
        ctes.append(f"t{k} AS (SELECT *, {e} AS s{k} FROM t{k - 1})")
    last = len(steps) - 1
    default = "'20minutos'" if rule == "strip" else "''"
    return f"""
        WITH pieces AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i
                        FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\. |\\n') AS ps FROM documents)),
        named AS (SELECT doc_id, i, replace({title}, ' Y ', ' y ') AS x FROM pieces),
        names AS (SELECT doc_id, i, unnest(xs) AS x, generate_subscripts(xs, 1) AS j FROM (SELECT doc_id, i, {parts} AS xs FROM named WHERE x <> '')),
        {", ".join(ctes)},
        firsts AS (SELECT doc_id, i, j, s{last} AS a FROM t{last} WHERE {keep}
                   QUALIFY row_number() OVER (PARTITION BY doc_id, lower(s{last}) ORDER BY i, j) = 1),
        lists AS (SELECT doc_id, string_agg(a, '|' ORDER BY i, j) AS authors, count(*) AS n FROM firsts GROUP BY doc_id)
        SELECT d.doc_id, coalesce(authors, {default}) AS authors, coalesce(n, {1 if rule == "strip" else 0})::BIGINT AS n_authors
        FROM documents AS d LEFT JOIN lists ON d.doc_id = lists.doc_id"""


AUTHOR_ORACLE = {f"authors_{rule}": author_sql(rule) for rule in A.ONE_NAME}
