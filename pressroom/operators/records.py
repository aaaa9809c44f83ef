"""Projections and record building (PRJ1-PRJ20).

Every operator is a ``select``/``withColumns`` of Column expressions: one
projection per step, no per-column loops of ``withColumn`` calls, no UDFs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_of_lit, iso_format, local_part, parse_any
from ..functions.text import clean_text, slug_title
from ..functions.urls import strip_scheme_host, title_from_slug
from ..schemas import EXPORT_COLUMNS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_of_text(as_of) -> Column:
    return F.date_format(as_of_lit(as_of), "yyyy-MM-dd HH:mm:ss")


# --------------------------------------------------------------------- PRJ1
def record_from_url(df: DataFrame, as_of, url: str = "url", site_url=None, source=None) -> DataFrame:
    """PRJ1: an export record built from the URL alone.

    title   = slug of the last piece, each '-' part title-cased
    section / subsection = pieces -2 / -3 of ``url.strip('/').split('/')``
    domain  = host of the site URL (of the URL itself when no site URL is given)
    publish_date = as_of ('yyyy-MM-dd HH:mm:ss')
    """
    u = F.col(url)
    parts = F.split(F.regexp_replace(u, "^/+|/+$", ""), "/")
    n = F.size(parts)
    site = _c(site_url) if site_url is not None else u
    return df.select(
        "*",
        title_from_slug(u).alias("title"),
        _as_of_text(as_of).alias("publish_date"),
        F.lit("").alias("authors"),
        (_c(source) if source is not None else F.lit("")).alias("source"),
        strip_scheme_host(site).alias("domain"),
        F.lit("").alias("summary"),
        F.when(n > 1, slug_title(F.try_element_at(parts, F.lit(-2)))).otherwise(F.lit("")).alias("section"),
        F.when(n > 2, slug_title(F.try_element_at(parts, F.lit(-3)))).otherwise(F.lit("")).alias("subsection"),
    )


# --------------------------------------------------------------------- PRJ2
def _as_export_text(c: Column, dtype: T.DataType, list_sep: str) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.filter(c.cast("array<string>"), lambda x: x.isNotNull() & (x != "")), list_sep)
    return c.cast("string")


def to_export(df: DataFrame, list_sep: str = ", ", as_of=None, default_authors: str | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """PRJ2: the 9-column export record, every value a string, null -> ''.

    ``default_authors`` / ``as_of`` reproduce the variant that writes 'Redacción'
    for missing authors and the run time for a missing date.
    """
    out = []
    for name in EXPORT_COLUMNS:
        if name in df.columns:
            v = _as_export_text(F.col(name), df.schema[name].dataType, list_sep)
        else:
            v = F.lit(None).cast("string")
        if name == "authors" and default_authors is not None:
            v = F.coalesce(v, F.lit(default_authors))
        if name == "publish_date" and as_of is not None:
            v = F.coalesce(v, iso_format(as_of_lit(as_of)))
        out.append(F.coalesce(v, F.lit("")).alias(name))
    return df.select(*out, *[F.col(k) for k in keep])


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with an expensive column that is computed once per row.

    The optimizer puts a projected expression into every later condition that names it; a
    generator's output it leaves alone.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# --------------------------------------------------------------------- PRJ3
# Default texts of required fields and of the error record (PRJ3, PRJ4).
def required_defaults(as_of) -> dict[str, Column]:
    """Typed defaults of the required article fields."""
    return {
        "title": F.lit("Sin título"),
        "text": F.lit(""),
        "publish_date": iso_format(as_of_lit(as_of)),
        "authors": F.array(F.lit("Redacción")),
        "html": F.lit(""),
        "images": F.array().cast("array<string>"),
        "keywords": F.array().cast("array<string>"),
        "summary": F.lit(""),
        "section": F.lit("general"),
        "subsection": F.lit(""),
    }


def fill_required(df: DataFrame, as_of) -> DataFrame:
    """PRJ3: add missing required fields and replace nulls by typed defaults."""
    defaults = required_defaults(as_of)
    cols = {k: (F.coalesce(F.col(k), v) if k in df.columns else v) for k, v in defaults.items()}
    return df.withColumns(cols)


# --------------------------------------------------------------------- PRJ4
def error_record(df: DataFrame, error_col: str, as_of) -> DataFrame:
    """PRJ4: rows with an error become the fixed error record (they are kept, flagged)."""
    err = F.col(error_col).isNotNull()
    repl = {
        "title": F.lit("Error al extraer el artículo"),
        "text": F.lit(""),
        "publish_date": iso_format(as_of_lit(as_of)),
        "authors": F.array(F.lit("Error")),
        "html": F.lit(""),
        "images": F.array().cast("array<string>"),
        "keywords": F.array().cast("array<string>"),
        "summary": F.concat(F.lit("Error al procesar el artículo: "), F.col(error_col)),
        "section": F.lit("error"),
        "subsection": F.lit(""),
    }
    cols = {k: (F.when(err, v).otherwise(F.col(k)) if k in df.columns else F.when(err, v))
            for k, v in repl.items()}
    return df.withColumns(cols).withColumn("is_error", err)


# --------------------------------------------------------------------- PRJ5
def snippets(df: DataFrame, html: str = "html", text: str = "text", images: str = "images",
             keywords: str = "keywords", meta_description: str | None = "meta_description") -> DataFrame:
    """PRJ5: html[:500]+'...', images[:5], keywords[:10], summary = description or text[:200]+'...'."""
    cols = {}
    if html in df.columns:
        h = F.col(html)
        cols[html] = F.when(h.isNotNull() & (h != ""), F.concat(F.substring(h, 1, 500), F.lit("..."))) \
            .otherwise(F.lit(""))
    if images in df.columns:
        cols[images] = F.slice(F.col(images), 1, 5)
    if keywords in df.columns:
        cols[keywords] = F.slice(F.col(keywords), 1, 10)
    if text in df.columns:
        desc = F.col(meta_description) if meta_description and meta_description in df.columns else F.lit(None)
        raw = F.coalesce(F.nullif(desc, F.lit("")),
                         F.concat(F.substring(F.coalesce(F.col(text), F.lit("")), 1, 200), F.lit("...")))
        cols["summary"] = F.coalesce(F.nullif(clean_text(raw), F.lit("")), F.lit("Sin resumen disponible"))
    return df.withColumns(cols)


def feed_summary(c, n: int = 500) -> Column:
    """PRJ5 (feed variant): first ``n`` characters of the entry summary."""
    return F.substring(_c(c), 1, n)


# --------------------------------------------------------------------- PRJ6-8
def project_paths(df: DataFrame, data: str, paths: Sequence[str], prefix: str = "") -> DataFrame:
    """PRJ6: one column per dotted path of a JSON payload, parsed once.

    The payload is parsed with ``try_parse_json`` into a VARIANT once per row;
    each path is a ``try_variant_get`` (null when any step is missing, like the
    reference's stop-at-null walk).  Output names keep the dots (``og.url``).
    Non-string leaves are returned as their JSON text.
    """
    v = F.try_parse_json(F.col(data))
    tmp = f"_{data}_v"
    out = df.withColumn(tmp, v)

    def get(p: str) -> Column:
        jp = "$" + "".join(f"['{x}']" for x in p.split("."))
        return F.try_variant_get(F.col(tmp), jp, "string")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[get(p).alias(prefix + p) for p in paths])


def rename_dotted(df: DataFrame) -> DataFrame:
    """PRJ7: every ``a.b`` column renamed ``a_b`` in one projection."""
    return df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns])


def effective_times(df: DataFrame, published=("article.published_time", "og.published_time"),
                    modified=("article.modified_time", "og.modified_time")) -> DataFrame:
    """PRJ8: published_time_tz / modified_time_tz = first present of each pair, as instants."""
    pub = F.coalesce(*[F.col(f"`{c}`") for c in published])
    mod = F.coalesce(*[F.col(f"`{c}`") for c in modified])
    return with_once(with_once(df, "published_time_tz", parse_any(pub)), "modified_time_tz", parse_any(mod))


# --------------------------------------------------------------------- PRJ9-14
PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "YM": "yyyyMM"}


def hour_columns(df: DataFrame, ts, tz: str = "Europe/Rome", prefix: str = "") -> DataFrame:
    """PRJ9: year, month, day, hour (and YM as yyyyMM) of ``ts`` in zone ``tz``, as strings."""
    t = _c(ts)
    cols = {f"{prefix}{k}": local_part(t, p, tz) for k, p in PARTS.items()
            if prefix or k != "YM"}
    return df.withColumns(cols)


def partition_from_times(df: DataFrame, tz: str = "Europe/Rome") -> DataFrame:
    """PRJ9: published_*/modified_* parts, then year/month/day/hour = modified else published."""
    df = hour_columns(df, "modified_time_tz", tz, prefix="modified_time_tz_rome_")
    df = hour_columns(df, "published_time_tz", tz, prefix="published_time_tz_rome_")
    return df.withColumns({k: F.coalesce(F.col(f"modified_time_tz_rome_{k}"), F.col(f"published_time_tz_rome_{k}"))
                           for k in ("year", "month", "day", "hour")})


def weekday_columns(ts) -> dict[str, Column]:
    """PRJ10: English day name and weekend flag (Saturday/Sunday)."""
    t = _c(ts)
    return {"day_of_week": F.date_format(t, "EEEE"),
            "is_weekend": F.coalesce(F.dayofweek(t).isin(1, 7), F.lit(False))}


# Weekday names in Italian, default 'Invalid day' (PRJ14).
WEEKDAY_IT = {"Monday": "Lunedì", "Tuesday": "Martedì", "Wednesday": "Mercoledì",
              "Thursday": "Giovedì", "Friday": "Venerdì", "Saturday": "Sabato", "Sunday": "Domenica"}


def weekday_in_italian(day_name) -> Column:
    m = F.create_map(*[x for k, v in WEEKDAY_IT.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, _c(day_name)), F.lit("Invalid day"))


def audit_time(run_ts) -> Column:
    """PRJ12: the run time as a literal 'yyyy-MM-dd HH:mm:ss' string."""
    return _as_of_text(run_ts)


def category_from_url(url, video_host: str = "https://video.") -> Column:
    """PRJ13: 'video' for the video host, else path piece 3 (piece 4 after 'pwa')."""
    u = _c(url)
    parts = F.split(u, "/")
    p3 = F.get(parts, 3)
    return (F.when(u.contains(video_host), F.lit("video"))
            .when(p3 == "pwa", F.get(parts, 4))
            .otherwise(p3))


def edition(url) -> Column:
    """PRJ13: edition is a constant in the reference job."""
    return F.lit("Undefined")


# --------------------------------------------------------------------- PRJ15-17
def superset(frames: Sequence[DataFrame], preferred: Sequence[str] = ()) -> DataFrame:
    """PRJ15: union by name of frames with different columns; preferred columns first, rest sorted."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    rest = sorted(c for c in out.columns if c not in preferred)
    return out.select(*[c for c in preferred if c in out.columns], *rest)


def assert_same_columns(new: DataFrame, old: DataFrame) -> None:
    """PRJ16: schema drift guard (driver-side metadata only, no job)."""
    a, b = set(new.columns), set(old.columns)
    if a != b:
        raise ValueError(f"column sets differ: only new {sorted(a - b)}, only old {sorted(b - a)}")


def reshape_20min(df: DataFrame) -> DataFrame:
    """PRJ17: the 20minutos record shape, with the date under ``publish_date`` (B11 fixed)."""
    cols = ["url", "title", "publish_date", "section", "authors", "summary", "text"]
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in cols])


# --------------------------------------------------------------------- PRJ18-20
def clean_record(df: DataFrame, as_of, author_rule: str = "strict") -> DataFrame:
    """PRJ19: STR1 on five text fields, authors cleaned (default 'Redacción'), ISO date or as_of."""
    from ..functions.authors import clean_authors
    cols = {f: clean_text(F.col(f)) for f in ("title", "text", "summary", "section", "subsection")
            if f in df.columns}
    if "authors" in df.columns:
        a = F.col("authors")
        if not isinstance(df.schema["authors"].dataType, T.ArrayType):
            a = F.when(a.isNotNull() & (a != ""), F.array(a))
        cleaned = clean_authors(F.coalesce(a, F.array(F.lit("Redacción"))), rule=author_rule)
        cols["authors"] = F.when(F.size(cleaned) > 0, cleaned).otherwise(F.array(F.lit("Redacción")))
    if "publish_date" in df.columns:
        cols["publish_date"] = F.coalesce(iso_format(parse_any(F.col("publish_date"))),
                                          iso_format(as_of_lit(as_of)))
    return df.withColumns(cols)


def record_from_entry(entries: DataFrame, as_of, url: str = "url", news_title: str = "news_title",
                      published: str = "published", summary: str | None = "summary") -> DataFrame:
    """PRJ20: a record from a feed/sitemap entry without a page: sitemap title, else slug title."""
    t = F.col(news_title) if news_title in entries.columns else F.lit(None)
    p = F.col(published) if published in entries.columns else F.lit(None)
    s = F.col(summary) if summary and summary in entries.columns else F.lit("")
    return entries.withColumns({
        "title": F.coalesce(F.nullif(t, F.lit("")), title_from_slug(F.col(url))),
        "publish_date": F.coalesce(iso_format(parse_any(p)), iso_format(as_of_lit(as_of))),
        "summary": F.coalesce(s, F.lit("")),
    })


# --------------------------------------------------------------------- PRJ18
def assemble_article(pages: DataFrame, as_of, url: str = "url", html: str = "html",
                     source=None, section_rule: str = "base", author_rule: str = "strict",
                     keep: Sequence[str] = (), default_author: str = "Redacción") -> DataFrame:
    """PRJ18: one article record per page, by field precedence, with the required defaults.

    title        h1 selectors -> <title> -> og:title; 'Sin título'
    publish_date <time datetime> / published meta -> JSON-LD datePublished; else as_of (ISO)
    authors      AUT10: JSON-LD authors, then meta author tags, then the byline meta
                 (each cleaned by ``author_rule``); else ['Redacción']
    text         paragraphs of the first <article> longer than 30 characters
    summary      description meta, else text[:200] + '...'; cleaned; 'Sin resumen disponible'
    section      by ``section_rule`` (base / nodate / mapped / first)
    """
    from ..functions import html as H
    from ..functions import urls as U
    from ..functions.authors import author_precedence

    # stage 1: every expensive per-page value once (fresh lambdas defeat common-subexpression
    # elimination, and CollapseProject keeps an expensive column that is referenced twice)
    h = F.col(html)
    m = H.meta_map(h)
    stage = pages.select(*[k for k in keep if k not in (url, html)], F.col(url), h, m.alias("_m"), H.main_text(h).alias("_text"),
                         H.jsonld_authors(h).alias("_ld_authors"),
                         H.jsonld_field(h, "$.datePublished").alias("_ld_date"),
                         *([source.alias("_source")] if source is not None else []))
    m = F.col("_m")
    t = F.coalesce(H.page_title(F.col(html)), H.head_title(F.col(html)),
                   F.nullif(F.element_at(m, F.lit("og:title")), F.lit("")))
    date_txt = F.coalesce(H.time_datetime(F.col(html), meta=m), F.col("_ld_date"))
    text = F.col("_text")
    desc = F.nullif(F.element_at(m, F.lit("description")), F.lit(""))
    summary = F.coalesce(desc, F.concat(F.substring(text, 1, 200), F.lit("...")))
    u = F.col(url)
    if section_rule == "nodate":
        sec = U.sections_nodate(u)
    elif section_rule == "mapped":
        sec = U.sections_mapped(u)
    elif section_rule == "first":
        sec = F.struct(U.section_first(u).alias("section"), F.lit("").alias("subsection"))
    else:
        sec = U.sections_base(u)
    authors = author_precedence(F.col("_ld_authors"), H.meta_authors(m, is_map=True),
                                H.meta_byline(m, is_map=True), rule=author_rule, default=default_author)
    return stage.select(
        *keep, u.alias("url"),
        F.coalesce(F.nullif(clean_text(t), F.lit("")), F.lit("Sin título")).alias("title"),
        text.alias("text"),
        F.coalesce(iso_format(parse_any(date_txt)), iso_format(as_of_lit(as_of))).alias("publish_date"),
        authors.alias("authors"),
        (F.col("_source") if source is not None else F.lit("")).alias("source"),
        U.domain(u).alias("domain"),
        F.coalesce(F.nullif(clean_text(summary), F.lit("")), F.lit("Sin resumen disponible")).alias("summary"),
        sec["section"].alias("section"), sec["subsection"].alias("subsection"),
    )
