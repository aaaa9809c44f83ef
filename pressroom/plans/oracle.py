"""DuckDB statements equivalent to the catalog queries (driver correctness gate).

Same names, same output columns, same fixed parameters as ``catalog.py``.
"""

from __future__ import annotations

from ..functions.html import TITLE_H1_CLASSES
from ..functions.text import CONTROL_CHARS, WS_AFTER_CONTROL
from ..operators.recency import hour_bounds
from ..sources.feeds import COMMON_SITEMAP_PATHS
from ..operators.records import WEEKDAY_IT
from ..schemas import EXPORT_COLUMNS
from ..sinks.writers import SEMICOLON_COLUMNS
from . import catalog as C
from .sqlparts import (canonical, capitalize, clean_ws, domain, fmt_ts, q, section_name, sections_base,
                       slug_title, tag_text, title, to_rome, unescape, url_path)

AS_OF = f"TIMESTAMP {q(C.AS_OF)}"


def _page_title(h: str) -> str:
    cands = [f"regexp_extract({h}, '(?is)<h1\\b[^>]*class=\"[^\"]*\\b{k}\\b[^\"]*\"[^>]*>(.*?)</h1>', 1)"
             for k in TITLE_H1_CLASSES]
    cands.append(f"regexp_extract({h}, '(?is)<h1\\b[^>]*itemprop=\"headline\"[^>]*>(.*?)</h1>', 1)")
    cands.append(f"regexp_extract({h}, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")
    return "coalesce(" + ", ".join(f"nullif({tag_text(c)}, '')" for c in cands) + ")"


_SEC, _SUB = sections_base("url")

SITE_DIGEST = f"""
WITH recs AS (
  SELECT page_id, {canonical('url')} AS url, {domain('url')} AS domain,
         coalesce({clean_ws(_page_title('html'))}, '') AS title,
         {_SEC} AS section, {_SUB} AS subsection
  FROM pages),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM recs) WHERE rn = 1),
capped AS (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS rank FROM firsts)
SELECT title, url, {q(C.AS_OF)} AS publish_date, 'Redacción' AS authors, domain AS source, domain,
       '' AS summary, section, subsection, page_id, rank
FROM capped WHERE rank <= {C.DOMAIN_CAP}
"""

CANONICAL_FIRST_SEEN = f"""
WITH p AS (SELECT page_id, {canonical('url')} AS canonical_url FROM pages)
SELECT canonical_url, min(page_id) AS page_id, count(*) AS n_versions FROM p GROUP BY canonical_url
"""

URL_SECTIONS_BASE = f"SELECT page_id, {_SEC} AS section, {_SUB} AS subsection FROM pages"

_ND_REST = "split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 2)"
_ND_HAS = "contains(replace(replace(url, 'https://', ''), 'http://', ''), '/')"
_ND_PIECES = (f"list_filter(string_split(substr(replace(replace(url, 'https://', ''), 'http://', ''), "
              f"strpos(replace(replace(url, 'https://', ''), 'http://', ''), '/') + 1), '/'), "
              f"lambda p: p <> '' AND NOT starts_with(p, '20'))")
URL_SECTIONS_NODATE = f"""
SELECT page_id,
  CASE WHEN {_ND_HAS} THEN {slug_title(f"coalesce(({_ND_PIECES})[1], '')")} ELSE '' END AS section,
  CASE WHEN {_ND_HAS} THEN {slug_title(f"coalesce(({_ND_PIECES})[2], '')")} ELSE '' END AS subsection
FROM pages
"""

_PIECES = f"list_filter(string_split({url_path('url')}, '/'), lambda p: p <> '')"
URL_SECTIONS_FIRST = f"SELECT page_id, coalesce(({_PIECES})[1], '') AS section FROM pages"

URL_SECTIONS_MAPPED = f"""
WITH p AS (SELECT page_id, {_PIECES} AS pc FROM pages)
SELECT page_id,
  CASE WHEN len(pc) > 1 THEN {section_name('pc[1]')} ELSE '' END AS section,
  CASE WHEN len(pc) <= 1 THEN ''
       WHEN len(pc) > 2 AND regexp_matches(pc[2], '^\\p{{Nd}}+$') AND length(pc[2]) = 4
         THEN CASE WHEN len(pc) > 3 THEN {section_name('pc[3]')} ELSE '' END
       ELSE {section_name('pc[2]')} END AS subsection
FROM p
"""

_PARTS = "string_split(regexp_replace(url, '^/+|/+$', '', 'g'), '/')"
RECORD_FROM_URL = f"""
WITH p AS (SELECT page_id, url, {_PARTS} AS parts FROM pages)
SELECT page_id,
  array_to_string(list_transform(list_filter(string_split(parts[-1], '-'), lambda w: w <> ''),
                                 lambda w: {title('w')}), ' ') AS title,
  {q(C.AS_OF)} AS publish_date, '' AS authors, 'pages' AS source,
  split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 1) AS domain,
  '' AS summary,
  CASE WHEN len(parts) > 1 THEN {slug_title('parts[-2]')} ELSE '' END AS section,
  CASE WHEN len(parts) > 2 THEN {slug_title('parts[-3]')} ELSE '' END AS subsection
FROM p
"""

PAGE_TITLES = f"""
SELECT page_id, coalesce({clean_ws(tag_text("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)"))}, '') AS title
FROM pages
"""

_HREF = "(?is)<a\\b[^>]*?\\bhref\\s*=\\s*\"([^\"]*)\""
PAGE_LINKS = f"""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, {q(_HREF)}, 1) AS hrefs FROM pages),
x AS (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM l)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
  CASE WHEN regexp_matches(href, '^https?://') THEN href
       WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
       WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
       WHEN regexp_matches(split_part(split_part(url, '#', 1), '?', 1), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/')
         THEN regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '[^/]*$', '') || href
       ELSE split_part(split_part(url, '#', 1), '?', 1) || '/' || href END AS absolute_url,
  (contains(href, '/noticias/') AND ends_with(href, '.html')) AS is_article,
  (contains(href, '/') AND ends_with(href, '.html')) AS is_html
FROM x
"""

_ART = "regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1)"
_PS = (f"list_transform((string_split_regex({_ART}, '(?i)<p\\b[^>]*>'))[2:], "
       f"lambda p: {tag_text(chr(40) + 'string_split_regex(p, ' + q('(?i)</p>') + '))[1]')})")
PAGE_PARAGRAPHS = f"""
WITH p AS (SELECT page_id, list_filter({_PS}, lambda t: length(t) > 30) AS ps FROM pages)
SELECT page_id, CAST(len(ps) AS BIGINT) AS n_paragraphs, array_to_string(ps, ' ') AS text FROM p
"""

PAGE_FLAG = """
SELECT page_id, CASE WHEN coalesce(contains(html, 'isAccessibleForFree": false'), false)
                     THEN 'LOCKED' ELSE 'FREE' END AS access FROM pages
"""

CLEAN_TEXT = f"""
SELECT doc_id, coalesce({clean_ws('text')}, '') AS clean,
       replace(coalesce({clean_ws('text')}, ''), '"', '""') AS flat FROM documents
"""

NORMALIZE_TEXT = f"""
SELECT doc_id, coalesce(trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text),
    {q(CONTROL_CHARS)}, '', 'g'), '\\r\\n?', chr(10), 'g'), {q(WS_AFTER_CONTROL + '+')}, ' ', 'g')), '')
    AS normalized FROM documents
"""


def _report(cond: str) -> str:
    return f"""
SELECT event_type, count(*) AS n_found, count(*) FILTER (WHERE {cond}) AS n_recent,
       count(*) FILTER (WHERE NOT ({cond})) AS n_skipped
FROM events GROUP BY event_type
"""


_AS_OF_DATE = f"DATE {q(C.AS_OF[:10])}"
RECENT = {
    "recent_midnight": _report(f"ts >= date_trunc('day', {AS_OF}) - INTERVAL {C.DAYS} DAY"),
    "recent_age": _report(f"ts >= {AS_OF} - INTERVAL {C.DAYS} DAY"),
    "recent_calendar": _report(f"({_AS_OF_DATE} - CAST(ts AS DATE)) <= {C.DAYS}"),
    "recent_days_floor": _report(f"floor((epoch_us({AS_OF}) - epoch_us(ts)) / 86400000000.0) <= {C.DAYS}"),
    "recent_age_or_now": _report(f"coalesce(ts, {AS_OF}) >= {AS_OF} - INTERVAL {C.DAYS} DAY"),
}

RECENT_TODAY = f"SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = {_AS_OF_DATE}"


def _parts(ts: str) -> str:
    r = to_rome(ts)
    return (f"strftime({r}, '%Y') AS year, strftime({r}, '%m') AS month, "
            f"strftime({r}, '%d') AS day, strftime({r}, '%H') AS hour")


_HW_LO, _HW_HI = hour_bounds(C.HOUR_AS_OF, C.HOUR_DELAY)
HOUR_WINDOW = f"""
WITH e AS (SELECT event_id, {_parts('ts')} FROM events)
SELECT * FROM e WHERE TRY_CAST(year || month || day || hour AS INTEGER) BETWEEN {_HW_LO} AND {_HW_HI}
"""

_IT = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in WEEKDAY_IT.items())
WEEKDAY_PARTS = f"""
SELECT o_orderkey, dayname(o_orderdate) AS day_of_week,
       coalesce(dayofweek(o_orderdate) IN (0, 6), false) AS is_weekend,
       CASE dayname(o_orderdate) {_IT} ELSE 'Invalid day' END AS day_of_week_it
FROM orders
"""

LATEST_PER_KEY = f"""
SELECT user_id, event_id, event_type, {fmt_ts('ts')} AS ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""

_M_LO, _M_HI = hour_bounds(C.MERGE_SPLIT, C.MERGE_DELAY)
_OG = "'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR)"
MERGE_PUBLISHED = f"""
WITH old AS (
  SELECT {_OG} AS og_url, date_trunc('hour', ts) AS m, {q(C.MERGE_AUDIT_OLD)} AS audit_time, event_id, value
  FROM events WHERE ts < TIMESTAMP {q(C.MERGE_SPLIT)}),
old_w AS (
  SELECT * FROM old WHERE TRY_CAST(strftime({to_rome('m')}, '%Y%m%d%H') AS INTEGER) BETWEEN {_M_LO} AND {_M_HI}),
new AS (
  SELECT {_OG} AS og_url, date_trunc('hour', ts) AS m, {q(C.MERGE_AUDIT_NEW)} AS audit_time, event_id, value
  FROM events WHERE ts >= TIMESTAMP {q(C.MERGE_NEW_FROM)}),
u AS (SELECT * FROM old_w UNION ALL SELECT * FROM new)
SELECT og_url, {fmt_ts('m')} AS modified_time, audit_time, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY m, og_url ORDER BY audit_time DESC, event_id DESC) AS rn FROM u)
WHERE rn = 1
"""

MERGE_CURATED = f"""
WITH old AS (SELECT {_OG} AS link, {_parts('ts')} FROM events WHERE ts < TIMESTAMP {q(C.MERGE_SPLIT)}),
old_w AS (SELECT * FROM old WHERE TRY_CAST(year || month || day || hour AS INTEGER) BETWEEN {_M_LO} AND {_M_HI}),
new AS (SELECT {_OG} AS link, {_parts('ts')} FROM events WHERE ts >= TIMESTAMP {q(C.MERGE_NEW_FROM)})
SELECT DISTINCT * FROM (SELECT * FROM old_w UNION ALL SELECT * FROM new)
"""

CAP_PER_SOURCE = f"""
SELECT doc_id, source, rank FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents)
WHERE rank <= {C.SOURCE_CAP}
"""

_LANG = "CASE lang " + " ".join(f"WHEN {q(x)} THEN {i}" for i, x in enumerate(C.LANG_ORDER)) + \
        f" ELSE {len(C.LANG_ORDER)} END"
QUOTA = f"""
SELECT doc_id, source, lang, rank FROM (
  SELECT doc_id, source, lang,
         row_number() OVER (PARTITION BY source ORDER BY {_LANG}, doc_id) AS rank
  FROM documents WHERE n_chars >= 200)
WHERE rank <= {C.QUOTA}
"""

TOP_UP = f"""
WITH prim AS (SELECT doc_id, source FROM documents
              WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
extra AS (SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM prim)),
u AS (SELECT *, 0 AS tier FROM prim UNION ALL SELECT *, 1 AS tier FROM extra)
SELECT doc_id, source FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY tier, doc_id) AS rn FROM u)
WHERE rn <= {C.TOP_UP}
"""

ANTI = """
SELECT d.doc_id, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

OVERLAY_ALL = """
SELECT d.doc_id, d.source,
  CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE -1 END AS quality,
  CASE WHEN l.doc_id IS NOT NULL THEN nullif(l.toxic, 0) ELSE -1 END AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

OVERLAY_NONNULL = """
SELECT d.doc_id, d.source, coalesce(l.quality, -1) AS quality, coalesce(nullif(l.toxic, 0), -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

FILL_MISSING = """
WITH lft AS (SELECT doc_id, source, CASE WHEN n_chars < 500 THEN '' ELSE lang END AS lang_hint FROM documents)
SELECT lft.doc_id, lft.source,
  CASE WHEN lft.lang_hint IS NULL OR lft.lang_hint = '' THEN 'q' || CAST(l.quality AS VARCHAR)
       ELSE lft.lang_hint END AS lang_hint
FROM lft LEFT JOIN labels l ON lft.doc_id = l.doc_id
"""

SECTION_LOOKUP = f"""
SELECT n_nationkey, n_name, r_name, {section_name('lower(r_name)')} AS region_display,
       {section_name('lower(n_name)')} AS nation_display
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

META_PATHS = """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k.x') AS k_x,
       json_extract_string(props, '$.missing.path') AS missing_path
FROM events
"""

RUN_REPORT = f"""
WITH p AS (SELECT {domain('url')} AS domain FROM pages)
SELECT domain, count(*) AS n_found, least(count(*), {C.DOMAIN_CAP}) AS n_exported,
       least(count(*), {C.DOMAIN_CAP}) > 0 AS ok
FROM p GROUP BY domain
"""

RSS_ROUND_TRIP = f"""
SELECT event_id, event_type,
  CAST(row_number() OVER (PARTITION BY event_type, floor(event_id / {C.RSS_CHUNK}) ORDER BY event_id) - 1 AS BIGINT)
    AS item_ord,
  event_type || ' & user ' || CAST(user_id AS VARCHAR) AS title,
  'https://news.example/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.html' AS link,
  {fmt_ts('ts')} AS published
FROM events
"""

_LASTMOD = "(TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id))"
SITEMAP_ROUND_TRIP = f"""
SELECT {domain('url')} AS domain,
  CAST(row_number() OVER (PARTITION BY {domain('url')}, floor(page_id / {C.SITEMAP_CHUNK}) ORDER BY page_id) - 1
       AS BIGINT) AS item_ord,
  trim(url) AS loc, {fmt_ts(_LASTMOD)} AS lastmod,
  coalesce({clean_ws(_page_title('html'))}, '') AS news_title,
  {_LASTMOD} >= {AS_OF} - INTERVAL {C.DAYS} DAY AS recent
FROM pages
"""

def _normalized(e: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize({e}), {q(CONTROL_CHARS)}, '', 'g'), '\\r\\n?', chr(10), 'g'), "
            f"{q(WS_AFTER_CONTROL + '+')}, ' ', 'g'))")


def _export_sql(columns, **how) -> str:
    """The export records in SQL: ``how`` gives a column's expression over the plain value {0}."""
    plain = {
        "title": "'\"Doc\" ^ ' || doc_id || ', ' || lang", "url": "'https://docs.example/' || source || '/' || doc_id",
        "publish_date": f"CASE WHEN doc_id % 2 = 0 THEN {q(C.AS_OF)} END",
        "authors": "CASE WHEN doc_id % 3 <> 0 THEN source || ', Autor ' || lang END", "source": "source",
        "domain": "'docs.example'", "summary": "text", "text": "text", "section": "lang", "subsection": "''"}
    cols = ", ".join(f"coalesce({how.get(c, '{0}').replace('{0}', '(' + plain[c] + ')')}, '') AS {c}" for c in columns)
    return (f"SELECT {cols}, regexp_replace(lower(source), '[^\\p{{L}}\\p{{N}}]', '_', 'g') AS source_key, {q(C.AS_OF[:10])} AS dt "
            "FROM documents")


_RUN_ISO = q(C.AS_OF.replace(" ", "T") + "+00:00")
_TIDY = {c: _normalized("{0}") for c in ("title", "url", "publish_date", "source", "domain", "summary", "section", "subsection")}
_FLAT = {c: f"replace(replace({clean_ws('{0}')}, '\"', '\"\"'), '^', ' ')" for c in ("title", "url", "publish_date", "summary", "source")}
CSV_ROUND_TRIP = _export_sql(EXPORT_COLUMNS)
CSV_BOM = _export_sql(EXPORT_COLUMNS, authors="coalesce({0}, 'Redacción')", publish_date=f"coalesce({{0}}, {_RUN_ISO})")
CSV_APPEND = _export_sql(EXPORT_COLUMNS, **_TIDY)
CSV_SEMICOLON = _export_sql(SEMICOLON_COLUMNS, authors="CASE WHEN doc_id % 3 <> 0 THEN source || '; ; Autor ' || lang END",
                            **{c: clean_ws("{0}") for c in SEMICOLON_COLUMNS if c != "authors"})
CSV_FLAT = _export_sql(["title", "url", "publish_date", "authors", "summary", "source"],
                       authors="CASE WHEN doc_id % 3 <> 0 THEN source || ', , Autor ' || lang END", **_FLAT)

STREAM_DEDUPE = f"""
SELECT DISTINCT {_OG} AS link, {fmt_ts("date_trunc('hour', ts)")} AS hour FROM events
WHERE NOT (ts < TIMESTAMP {q(C.STREAM_CUTS[0])} AND event_id % 13 = 0)
"""

STREAM_HOURLY = f"""
SELECT {fmt_ts("date_trunc('hour', ts)")} AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL
"""

_ENTRIES = f"""
SELECT {_OG} AS url, dayofmonth(ts) AS feed_ord, event_id AS item_ord, 'ev ' || CAST(event_id AS VARCHAR) AS title,
       {fmt_ts('ts')} AS publish_date, event_type AS summary, value FROM events
"""
_SLUG = (f"array_to_string(list_transform(list_filter(string_split("
         f"(string_split(regexp_replace(url, '^/+|/+$', '', 'g'), '/'))[-1], '-'), lambda w: w <> ''), "
         f"lambda w: {title('w')}), ' ')")
FEED_ENRICH = f"""
WITH e AS ({_ENTRIES}),
u AS (SELECT DISTINCT url FROM e WHERE value > 50),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY feed_ord, item_ord) AS rn FROM e) WHERE rn = 1)
SELECT u.url, CASE WHEN f.url IS NOT NULL THEN f.title ELSE {_SLUG.replace('url', 'u.url')} END AS title,
       CASE WHEN f.url IS NOT NULL THEN f.publish_date ELSE {q(C.AS_OF)} END AS publish_date,
       CASE WHEN f.url IS NOT NULL THEN f.summary ELSE '' END AS summary
FROM u LEFT JOIN f ON u.url = f.url
"""

FIRST_DISTINCT_USERS = f"""
WITH f AS (SELECT * FROM (SELECT event_type, user_id, ts, event_id,
             row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1)
SELECT event_type, user_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM f) WHERE r <= {C.FIRST_USERS}
"""

DOC_SNIPPETS = f"""
SELECT doc_id,
  coalesce(nullif(coalesce({clean_ws("substr(coalesce(text, ''), 1, 200) || '...'")}, ''), ''), 'Sin resumen disponible')
    AS summary,
  CASE WHEN text IS NOT NULL AND text <> '' THEN substr(text, 1, 500) || '...' ELSE '' END AS snippet
FROM documents
"""

ISO_DATES = f"""
SELECT event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') <> '000000' THEN '.' || strftime(ts, '%f') ELSE '' END
    || '+00:00' AS iso,
  strftime(TIMESTAMP {q(C.AS_OF)}, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS props_date,
  {fmt_ts('ts')} AS strict_z, {q(C.AS_OF)} AS strict_z_default
FROM events
"""

DISTINCT_SOURCES = "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL"

_META_KEY = "(?is)\\b(?:name|property|itemprop)\\s*=\\s*[\"']([^\"']*)[\"']"
_META_VAL = "(?is)\\bcontent\\s*=\\s*[\"']([^\"']*)[\"']"


def _meta(h: str, key: str) -> str:
    entries = (f"list_transform(regexp_extract_all({h}, '(?is)<meta\\b[^>]*>'), lambda t: "
               f"{{'k': lower(regexp_extract(t, {q(_META_KEY)}, 1)), 'v': {unescape('regexp_extract(t, ' + q(_META_VAL) + ', 1)')}}})")
    return f"(list_filter({entries}, lambda e: e.k = {q(key)} AND e.v <> ''))[1].v"


def _jsonld_field(h: str, path: str) -> str:
    blocks = f"list_filter(regexp_extract_all({h}, '(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>', 1), lambda b: json_valid(b))"
    items = (f"flatten(list_transform({blocks}, lambda b: CASE WHEN json_type(CAST(b AS JSON)) = 'ARRAY' "
             f"THEN CAST(json_extract(b, '$[*]') AS JSON[]) ELSE [CAST(b AS JSON)] END))")
    return f"(list_filter(list_transform({items}, lambda i: json_extract_string(i, {q(path)})), lambda x: x IS NOT NULL))[1]"


def _parse_any(s: str) -> str:
    t = f"trim({s})"
    return (f"(CASE WHEN regexp_matches({t}, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') "
            f"THEN timezone('UTC', TRY_CAST({t} AS TIMESTAMPTZ)) ELSE TRY_CAST({t} AS TIMESTAMP) END)")


def _iso(ts: str) -> str:
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({ts}, '%f') <> '000000' "
            f"THEN '.' || strftime({ts}, '%f') ELSE '' END || '+00:00')")


_TIME_DP = "nullif(regexp_extract(html, '(?is)<time\\b[^>]*itemprop=\"datePublished\"[^>]*datetime=\"([^\"]*)\"', 1), '')"
_TIME_ANY = "nullif(regexp_extract(html, '(?is)<time\\b[^>]*datetime=\"([^\"]*)\"', 1), '')"
_DATE_TXT = (f"coalesce({_TIME_DP}, {_TIME_ANY}, {_meta('html', 'article:published_time')}, {_meta('html', 'pubdate')}, "
             f"{_jsonld_field('html', '$.datePublished')})")
_TITLE_TAG = "regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)"
_HEAD_TITLE = f"nullif({tag_text(_TITLE_TAG)}, '')"
ASSEMBLED_PAGES = f"""
WITH p AS (
  SELECT page_id, url, html,
    coalesce({_page_title('html')}, {_HEAD_TITLE}, nullif({_meta('html', 'og:title')}, '')) AS t,
    array_to_string(list_filter({_PS}, lambda x: length(x) > 30), ' ') AS text,
    {_DATE_TXT} AS date_txt,
    nullif({_meta('html', 'description')}, '') AS descr
  FROM pages)
SELECT page_id,
  coalesce(nullif(coalesce({clean_ws('t')}, ''), ''), 'Sin título') AS title,
  coalesce({_iso(_parse_any('date_txt'))}, {q(C.AS_OF.replace(' ', 'T') + '+00:00')}) AS publish_date,
  '' AS source, {domain('url')} AS domain,
  coalesce(nullif(coalesce({clean_ws("coalesce(descr, substr(text, 1, 200) || '...')")}, ''), ''),
           'Sin resumen disponible') AS summary,
  {_SEC} AS section, {_SUB} AS subsection, CAST(length(text) AS BIGINT) AS text_chars
FROM p
"""

RSS_FILE_SCAN = f"""
SELECT event_id, event_type || ' & user ' || CAST(user_id AS VARCHAR) AS title,
  'https://news.example/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.html' AS link,
  {fmt_ts('ts')} AS published
FROM events
"""

SITEMAP_FILE_SCAN = f"""
SELECT trim(url) AS loc, {fmt_ts(_LASTMOD)} AS lastmod, CASE WHEN page_id % 4 <> 0 THEN 'T & <b> ' || url END AS news_title,
       CASE WHEN page_id % 4 <> 0 THEN strftime({_LASTMOD}, '%Y-%m-%d') END AS news_day, CASE WHEN page_id % 4 <> 0 THEN 'es' END AS news_language
FROM pages
"""

_EMAIL_NAME = title("replace(role || '.conv' || CAST(conv_id AS VARCHAR), '.', ' ')")
ATOM_ROUND_TRIP = f"""
SELECT conv_id,
  CAST(row_number() OVER (PARTITION BY conv_id, floor(turn / {C.ATOM_CHUNK}) ORDER BY turn) - 1 AS BIGINT) AS item_ord,
  CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS guid,
  role || ' turn ' || CAST(turn AS VARCHAR) AS title,
  'https://chat.example/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS link,
  {_EMAIL_NAME} AS authors,
  {fmt_ts("TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id) + to_minutes(turn)")} AS published
FROM conversations
"""

_DOM = domain('url')
_KIND = "CASE WHEN starts_with(domain, 'blog.') THEN 'google-news-' ELSE 'sitemap-' END"
SITEMAP_INDEX_EXPAND = f"""
WITH p AS (SELECT page_id, url, {_DOM} AS domain, CAST(floor(page_id / {C.SITEMAP_CHUNK}) AS BIGINT) AS chunk FROM pages),
c AS (SELECT DISTINCT domain, chunk FROM p),
c2 AS (SELECT domain, chunk, CAST(floor(chunk / {C.INDEX_FANOUT}) AS BIGINT) AS ichunk,
         'https://' || domain || '/' || {_KIND} || CAST(chunk AS VARCHAR) || '.xml' AS child_url,
         CAST(row_number() OVER (PARTITION BY domain, floor(chunk / {C.INDEX_FANOUT})
              ORDER BY CASE WHEN starts_with(domain, 'blog.') THEN -chunk ELSE chunk END) - 1 AS BIGINT) AS child_ord
       FROM c),
e AS (SELECT domain, chunk, trim(url) AS loc,
        CAST(row_number() OVER (PARTITION BY domain, chunk ORDER BY page_id) - 1 AS BIGINT) AS item_ord FROM p)
SELECT c2.domain, 'https://' || c2.domain || '/index-' || CAST(c2.ichunk AS VARCHAR) || '.xml' AS index_url,
       c2.child_ord, c2.child_url, e.item_ord, e.loc
FROM c2 JOIN e ON e.domain = c2.domain AND e.chunk = c2.chunk
WHERE c2.child_ord < {C.INDEX_CHILDREN}
"""

_COMMON = "[" + ", ".join(q(x) for x in COMMON_SITEMAP_PATHS) + "]"
ROBOTS_CANDIDATES = f"""
WITH d AS (SELECT DISTINCT {_DOM} AS site FROM pages)
SELECT site, 'https://' || site || unnest({_COMMON}) AS sitemap_url FROM d
UNION
SELECT {_DOM} AS site, 'https://' || {_DOM} || '/sitemap-' || CAST(page_id AS VARCHAR) || '.xml' AS sitemap_url FROM pages
"""

_H_LO, _H_HI = hour_bounds(C.MERGE_SPLIT, C.MERGE_DELAY)
HOURS_ROUND_TRIP = f"""
WITH b1 AS (SELECT event_id, 'b1' AS batch, {_parts('ts')} FROM events WHERE ts < TIMESTAMP {q(C.MERGE_SPLIT)}),
b2 AS (SELECT event_id, 'b2' AS batch, {_parts('ts')} FROM events WHERE ts >= TIMESTAMP {q(C.MERGE_NEW_FROM)}),
h2 AS (SELECT DISTINCT year, month, day, hour FROM b2),
f AS (SELECT * FROM b2 UNION ALL
      SELECT b1.* FROM b1 WHERE NOT EXISTS (SELECT 1 FROM h2 WHERE h2.year = b1.year AND h2.month = b1.month
                                            AND h2.day = b1.day AND h2.hour = b1.hour))
SELECT * FROM f WHERE TRY_CAST(year || month || day || hour AS INTEGER) BETWEEN {_H_LO} AND {_H_HI}
"""

PAGE_ATTACH = f"""
WITH u AS (SELECT DISTINCT {canonical('url')} AS url FROM pages)
SELECT u.url, p.url IS NOT NULL AS has_page, CAST(length(p.html) AS BIGINT) AS html_chars
FROM u LEFT JOIN (SELECT url, html FROM pages) p ON u.url = p.url
"""

_OL = "regexp_extract(html, '(?is)<ol\\b[^>]*class=\"[^\"]*\\bbreadcrumb\\b[^\"]*\"[^>]*>(.*?)</ol>', 1)"
_CRUMB = f"nullif({tag_text('(regexp_extract_all(' + _OL + ', ' + q('(?is)<li\\b[^>]*>(.*?)</li>') + ', 1))[2]')}, '')"
_FIRST = f"split_part(regexp_replace({url_path('url')}, '^/+|/+$', '', 'g'), '/', 1)"
URL_SECTIONS_CAPITALIZED = f"""
WITH p AS (SELECT page_id, {_FIRST} AS first, {_CRUMB} AS crumb FROM pages)
SELECT page_id, CASE WHEN first NOT IN ('es', 'america', 'america-latina') THEN {capitalize('first')}
                     ELSE coalesce(crumb, 'General') END AS section FROM p
"""
URL_SECTIONS_BREADCRUMB = f"""
WITH p AS (SELECT page_id, {_FIRST} AS first, {_CRUMB} AS crumb FROM pages)
SELECT page_id, CASE WHEN crumb IS NOT NULL AND crumb <> '' AND lower(crumb) NOT IN ('inicio', 'portada') THEN crumb
                     WHEN first <> '' AND lower(first) NOT IN ('noticias', 'actualidad', 'ultima-hora')
                       THEN {capitalize('first')}
                     ELSE 'General' END AS section FROM p
"""

_RUN_END = f"date_trunc('hour', {AS_OF})"
RUN_HOURS = f"""
WITH h AS (SELECT unnest(generate_series({_RUN_END} - INTERVAL {C.HOUR_DELAY} HOUR, {_RUN_END} - INTERVAL 1 HOUR,
                                         INTERVAL 1 HOUR)) AS h),
c AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1)
SELECT {fmt_ts('h.h')} AS hour, coalesce(c.n, 0) AS n FROM h LEFT JOIN c ON h.h = c.h
"""

_EP_PIECES = (f"list_filter(string_split(substr(replace(replace(url, 'https://', ''), 'http://', ''), "
              f"strpos(replace(replace(url, 'https://', ''), 'http://', ''), '/') + 1), '/'), "
              f"lambda p: p <> '' AND NOT starts_with(p, '20'))")
EL_PAIS_FEED_EXPORT = f"""
WITH e AS (
  SELECT *, date_trunc('second', ts) AS t,
    'https://news.example/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.html' AS url,
    row_number() OVER (PARTITION BY event_type, floor(event_id / {C.RSS_CHUNK}) ORDER BY event_id) - 1 AS item_ord
  FROM events)
SELECT url, event_type || ' & user ' || CAST(user_id AS VARCHAR) AS title,
  strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS publish_date, 'Unknown' AS authors,
  'El País' AS source, 'elpais.com' AS domain, '' AS summary,
  {slug_title(f"coalesce(({_EP_PIECES})[1], '')")} AS section,
  {slug_title(f"coalesce(({_EP_PIECES})[2], '')")} AS subsection
FROM e
WHERE t >= {AS_OF} - INTERVAL {C.DAYS} DAY
  AND floor((epoch_us({AS_OF}) - epoch_us(t)) / 86400000000.0) <= {C.DAYS}
"""

STREAM_UPSERT = f"""
SELECT og_url, {fmt_ts('m')} AS modified_time, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY og_url, m ORDER BY audit DESC, event_id DESC, value DESC) AS rn
  FROM (SELECT {_OG} AS og_url, date_trunc('day', ts) AS m, event_id, value, 0 AS audit FROM events
        UNION ALL SELECT {_OG}, date_trunc('day', ts), event_id, value + 1, 1 FROM events WHERE event_id % 5 = 0)) WHERE rn = 1
"""

SELECT_SOURCES = """
WITH sites AS (SELECT DISTINCT source AS name FROM documents WHERE lang IN ('es', 'fr')),
wanted AS (SELECT DISTINCT upper(source) AS name FROM documents WHERE lang = 'de')
SELECT name, 'found' AS status FROM sites s
WHERE EXISTS (SELECT 1 FROM wanted w WHERE lower(w.name) = lower(s.name))
UNION ALL
SELECT name, 'unknown' AS status FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE lower(s.name) = lower(w.name))
"""

PAGE_CATEGORIES = """
SELECT page_id,
  CASE WHEN contains(url, 'https://video.') THEN 'video'
       WHEN (string_split(url, '/'))[4] = 'pwa' THEN (string_split(url, '/'))[5]
       ELSE (string_split(url, '/'))[4] END AS category,
  'Undefined' AS edition
FROM pages
"""

_EFF = "CASE WHEN event_type = 'purchase' THEN date_trunc('second', ts) + INTERVAL 1 HOUR ELSE date_trunc('second', ts) END"
EVENT_TIME_PARTS = f"""
SELECT event_id, strftime({to_rome(_EFF)}, '%Y') AS year, strftime({to_rome(_EFF)}, '%m') AS month,
  strftime({to_rome(_EFF)}, '%d') AS day, strftime({to_rome(_EFF)}, '%H') AS hour,
  strftime({to_rome(_EFF)}, '%Y%m') AS ym
FROM events
"""

ORACLE = {
    "site_digest": SITE_DIGEST,
    "canonical_first_seen": CANONICAL_FIRST_SEEN,
    "url_sections_base": URL_SECTIONS_BASE,
    "url_sections_nodate": URL_SECTIONS_NODATE,
    "url_sections_first": URL_SECTIONS_FIRST,
    "url_sections_mapped": URL_SECTIONS_MAPPED,
    "record_from_url": RECORD_FROM_URL,
    "page_titles": PAGE_TITLES,
    "page_links": PAGE_LINKS,
    "page_paragraphs": PAGE_PARAGRAPHS,
    "page_flag": PAGE_FLAG,
    "clean_text": CLEAN_TEXT,
    "normalize_text": NORMALIZE_TEXT,
    **RECENT,
    "recent_today": RECENT_TODAY,
    "hour_window": HOUR_WINDOW,
    "weekday_parts": WEEKDAY_PARTS,
    "latest_per_key": LATEST_PER_KEY,
    "merge_published": MERGE_PUBLISHED,
    "merge_curated": MERGE_CURATED,
    "cap_per_source": CAP_PER_SOURCE,
    "quota": QUOTA,
    "top_up": TOP_UP,
    "anti": ANTI,
    "overlay_all": OVERLAY_ALL,
    "overlay_nonnull": OVERLAY_NONNULL,
    "fill_missing": FILL_MISSING,
    "section_lookup": SECTION_LOOKUP,
    "meta_paths": META_PATHS,
    "run_report": RUN_REPORT,
    "rss_round_trip": RSS_ROUND_TRIP,
    "sitemap_round_trip": SITEMAP_ROUND_TRIP,
    "csv_round_trip": CSV_ROUND_TRIP,
    "stream_dedupe": STREAM_DEDUPE,
    "csv_bom": CSV_BOM,
    "csv_append": CSV_APPEND,
    "csv_semicolon": CSV_SEMICOLON,
    "csv_flat": CSV_FLAT,
    "stream_hourly": STREAM_HOURLY,
    "feed_enrich": FEED_ENRICH,
    "first_distinct_users": FIRST_DISTINCT_USERS,
    "doc_snippets": DOC_SNIPPETS,
    "iso_dates": ISO_DATES,
    "distinct_sources": DISTINCT_SOURCES,
    "assembled_pages": ASSEMBLED_PAGES,
    "rss_file_scan": RSS_FILE_SCAN,
    "sitemap_file_scan": SITEMAP_FILE_SCAN,
    "atom_round_trip": ATOM_ROUND_TRIP,
    "sitemap_index_expand": SITEMAP_INDEX_EXPAND,
    "robots_candidates": ROBOTS_CANDIDATES,
    "hours_round_trip": HOURS_ROUND_TRIP,
    "page_attach": PAGE_ATTACH,
    "url_sections_capitalized": URL_SECTIONS_CAPITALIZED,
    "url_sections_breadcrumb": URL_SECTIONS_BREADCRUMB,
    "run_hours": RUN_HOURS,
    "el_pais_feed_export": EL_PAIS_FEED_EXPORT,
    "stream_upsert": STREAM_UPSERT,
    "select_sources": SELECT_SOURCES,
    "page_categories": PAGE_CATEGORIES,
    "event_time_parts": EVENT_TIME_PARTS,
}
