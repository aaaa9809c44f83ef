"""Multi-site export as one Spark plan (§2.15, UDF2, AGG5, AGG6).

The registry carries each site's rules as columns (recency_rule, section_rule,
author_rule, caps).  Rules are applied as ``when(site rule = ...)`` column
choices, so every site goes through the same plan: no per-site loop, no driver
threads.  Documents (feeds, sitemaps) and pages are inputs; nothing is fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import authors as A
from ..functions import html as H
from ..functions import urls as U
from ..functions.dates import iso_format, parse_any, parse_sitemap_lastmod, to_instant
from ..operators import dedupe, enrich, recency
from ..operators.records import with_once
from ..sources.feeds import parse_feed, parse_sitemap
from ..sources.registry import feed_plan


def entries_for_sites(sites: DataFrame, docs: DataFrame, sitemap_head: int | None = None) -> DataFrame:
    """SRC9 + SRC3/SRC4: the planned documents of every site parsed into one entry table.

    ``sitemap_head``: LIM2, entries considered per sitemap before the recency filter (none: all).
    """
    plan = feed_plan(sites)
    d = docs.select("url", "content")
    planned = plan.join(d, "url", "inner")
    rss = parse_feed(planned.filter(F.col("kind") == "rss"), keep=["site", "feed_ord", "url"])
    rss = rss.select("site", F.lit("rss").alias("kind"), "feed_ord", "item_ord", F.col("link").alias("entry_url"), "title",
                     F.coalesce("published", "updated", "created", "dc_date").alias("published"),
                     "summary", "authors", "categories")
    sm = parse_sitemap(planned.filter(F.col("kind") == "sitemap"), keep=["site", "kind", "feed_ord", "url"])
    if sitemap_head is not None:
        sm = sm.filter(F.col("item_ord") < sitemap_head)                   # LIM2 before recency
    sm = sm.select("site", "kind", "feed_ord", "item_ord", F.col("loc").alias("entry_url"),
                   F.col("news_title").alias("title"),
                   F.coalesce("lastmod", "news_publication_date").alias("published"),
                   F.lit(None).cast("string").alias("summary"), F.array().cast("array<string>").alias("authors"),
                   F.array().cast("array<string>").alias("categories"))
    return rss.unionByName(sm)


def _recent_by_rule(rule: Column, ts: Column, as_of, days: int, url: Column) -> Column:
    choices = [(r, recency.is_recent(ts, as_of, days, r)) for r in ("midnight", "age", "calendar", "age_or_now")]
    expr = F.when(rule == "days_floor", recency.is_recent(ts, as_of, days, "days_floor"))
    for name, cond in choices:
        expr = expr.when(rule == name, cond)
    return expr.otherwise(F.lit(True))        # 'none': the site applies no recency rule (B17)


def _section_by_rule(rule: Column, url: Column, categories: Column) -> Column:
    base = U.sections_base(url)["section"]
    nodate = U.section_or_tag(U.sections_nodate(url)["section"], categories)
    return (F.when(rule == "base", base).when(rule == "nodate", nodate)
            .when(rule == "first", U.section_first(url)).when(rule == "mapped", U.sections_mapped(url)["section"])
            .when(rule == "capitalized", U.section_capitalized(url)).when(rule == "breadcrumb", U.section_breadcrumb(url))
            .when(rule == "from_url", U.slug_title(F.try_element_at(F.split(F.regexp_replace(url, "^/+|/+$", ""), "/"), F.lit(-2))))
            .otherwise(F.lit("")))


def _authors_by_rule(rule: Column, site: Column, authors: Column) -> Column:
    empty = F.array().cast("array<string>")
    a = F.coalesce(authors, empty)
    return (F.when(rule == "strict", A.clean_strict(a)).when(rule == "cut", A.clean_cut(a))
            .when(rule == "okd", A.clean_okd(a)).when(rule == "strip", A.clean_strip(a))
            .when((rule == "stoplist") & (site == "Infobae"), A.clean_stoplist(a, *A.STOPLISTS["infobae"][:2]))
            .when(rule == "stoplist", A.clean_stoplist(a, *A.STOPLISTS["voz_populi"][:2], strip_por=True))
            .otherwise(a))


def run_sites(sites: DataFrame, docs: DataFrame, as_of, days: int = 1, pages: DataFrame | None = None,
              default_cap: int | None = None, sitemap_head: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All sites in one plan -> (export records, ingest report per site and feed).

    Caps apply where they are given: per site ``max_articles`` of the registry or else
    ``default_cap``, per feed ``max_articles_per_feed`` (LIM4). Without one nothing is cut and
    ``rank`` is null. The report (AGG5) counts what the documents hold, before any cap.
    """
    e = entries_for_sites(sites, docs, sitemap_head)
    rules = sites.select(F.col("name").alias("site"), "recency_rule", "section_rule", "author_rule",
                         F.coalesce("max_articles", F.lit(default_cap).cast("int")).alias("cap"), "max_articles_per_feed",
                         F.regexp_extract("url", "^[a-z]+://([^/]*)", 1).alias("domain"))
    e = e.join(rules, "site", "left")
    e = e.withColumn("url", U.canonical_url("entry_url")).filter(recency.http_only("url"))
    # sitemap lastmods follow the 'midnight' rule's own formats; feed dates are RFC 822 / ISO
    ts = F.when((F.col("kind") == "sitemap") & (F.col("recency_rule") == "midnight"),
                parse_sitemap_lastmod(F.col("published"))).otherwise(parse_any(F.col("published")))
    e = with_once(e, "_ts", ts)
    ts = F.col("_ts")
    e = with_once(e, "recent", _recent_by_rule(F.col("recency_rule"), ts, as_of, days, F.col("url")))
    report = e.groupBy("site", "feed_ord").agg(F.count(F.lit(1)).alias("n_found"),
                                               F.count_if("recent").alias("n_recent"),
                                               F.count_if(~F.col("recent")).alias("n_skipped"))
    in_feed = (F.col("kind") == "sitemap") | F.col("max_articles_per_feed").isNull() \
        | (F.col("item_ord") < F.col("max_articles_per_feed"))                                  # LIM4 per feed
    kept = dedupe.first_seen(e.filter(F.col("recent") & in_feed), ["site", "url"], ["feed_ord", "item_ord"])  # AGG2
    # the largest cap of the registry (one row per site: a bounded, tiny read) as a literal bound,
    # so the window is planned with a WindowGroupLimit below the shuffle; the per-site cap follows
    max_cap = rules.agg(F.max("cap")).first()[0]
    from pyspark.sql import Window
    w = Window.partitionBy("site").orderBy("feed_ord", "item_ord")
    free = kept.filter("cap is null").withColumn("rank", F.lit(None).cast("int"))
    kept = free if max_cap is None else (
        kept.filter("cap is not null").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(int(max_cap)))
        .filter(F.col("rank") <= F.col("cap")).unionByName(free))                              # LIM1/LIM5
    if pages is not None:
        p = enrich.pages_for(kept, pages.select("url", "html")).select(
            F.col("url"), H.page_title("html").alias("page_title"), H.meta_authors("html").alias("meta_authors"))
        kept = kept.join(p, "url", "left")
    else:
        kept = kept.withColumns({"page_title": F.lit(None).cast("string"),
                                 "meta_authors": F.array().cast("array<string>")})
    title = F.coalesce(F.nullif(F.col("page_title"), F.lit("")), F.nullif(F.col("title"), F.lit("")),
                       U.title_from_slug(F.col("url")))
    auth = _authors_by_rule(F.col("author_rule"), F.col("site"),
                            F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.col("meta_authors")))
    out = kept.select(
        title.alias("title"), "url",
        F.coalesce(iso_format(ts), iso_format(to_instant(F.lit(str(as_of))))).alias("publish_date"),
        F.array_join(auth, ", ").alias("authors"), F.col("site").alias("source"), "domain",
        F.coalesce("summary", F.lit("")).alias("summary"),
        _section_by_rule(F.col("section_rule"), F.col("url"), F.col("categories")).alias("section"),
        F.lit("").alias("subsection"), "rank")
    return out, report


def run_report(sites: DataFrame, exported: DataFrame) -> DataFrame:
    """AGG6: exported rows per configured site, success flag, totals."""
    per = exported.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("n_exported"))
    rep = sites.select("name").join(per, "name", "left").fillna(0, ["n_exported"])
    return rep.withColumn("ok", F.col("n_exported") > 0)


# ------------------------------------------------------------------ site-specific flows
def okdiario_urls(index_docs: DataFrame, docs: DataFrame, rss_entries: DataFrame, as_of, days: int = 1,
                  max_articles: int | None = None) -> DataFrame:
    """OKDiario discovery (the intended flow of §2.15, B10 decided).

    Sitemap index -> children with 'google-news' ones first, a later one ahead of an earlier
    one (LIM7) -> their entries in order, dropping only entries whose lastmod parses to before
    as_of - days (unknown kept; zoned dates compared as instants, B15) -> the first
    ``max_articles`` (LIM5) -> topped up from recent RSS entries whose URL is not already
    there (JON6).  ``rss_entries``: site, feed_ord, item_ord, url, published.
    """
    from ..sources.feeds import index_children
    ch = index_children(index_docs, keep=["site"], priority_marker="google-news")
    entries = parse_sitemap(ch.join(docs.select(F.col("url").alias("child_url"), "content"), "child_url"),
                            keep=["site", "child_ord"])
    t = parse_any(F.col("lastmod"))
    fresh = F.coalesce(t >= to_instant(F.lit(str(as_of))) - F.make_dt_interval(F.lit(days)), F.lit(True))
    primary = entries.filter(fresh).select("site", F.col("loc").alias("url"),
                                           F.col("child_ord").alias("o1"), F.col("item_ord").alias("o2"))
    rss = rss_entries.filter(recency.is_recent(parse_any(F.col("published")), as_of, days, "calendar"))
    fallback = rss.select("site", "url", F.col("feed_ord").alias("o1"), F.col("item_ord").alias("o2"))
    return enrich.top_up(primary, fallback, "url", "site", max_articles, ["o1", "o2"])


def el_mundo_enrich(records: DataFrame, pages: DataFrame) -> DataFrame:
    """El Mundo export (JON3): only empty fields of the URL records are filled from the page --
    title (HTM1), authors from the byline selectors (HTM3, joined ', ', sorted: the reference
    keeps a set), publication date (HTM7) and mapped section/subsection (URL4)."""
    wanted = enrich.pages_for(records, pages.select("url", "html"))
    sec = U.sections_mapped(F.col("url"))
    meta = wanted.select("url", H.page_title("html").alias("title"),
                       F.array_sort(H.flat_authors("html", "el_mundo")).alias("authors"),
                       H.time_datetime("html").alias("publish_date"),
                       sec["section"].alias("section"), sec["subsection"].alias("subsection"))
    return enrich.fill_missing(records, meta, "url", ["title", "authors", "publish_date", "section", "subsection"])


# Meta tags read for El País authors (HTM6), in order.
EL_PAIS_AUTHOR_META = ["author", "byl", "sailthru.author", "article:author", "og:article:author",
                       "twitter:creator", "parsely-author"]


def el_pais_page_authors(html) -> Column:
    """HTM6: JSON-LD authors when there are any; otherwise meta and element authors, cleaned
    (AUT9 for meta values, AUT4 for every name) and sorted."""
    html = F.col(html) if isinstance(html, str) else html
    m = H.meta_map(html)
    meta = F.filter(F.array(*[A.meta_author_value(F.element_at(m, F.lit(k))) for k in EL_PAIS_AUTHOR_META]),
                    lambda v: v.isNotNull() & (v != ""))
    ld = H.jsonld_authors(html)
    names = F.when(F.size(ld) > 0, ld).otherwise(F.concat(meta, H.flat_authors(html, "el_pais")))
    return F.array_sort(F.array_distinct(A.clean_each(names, "cut")))


def feed_or_page_authors(feed_authors, page_authors) -> Column:
    """HTM6 precedence: authors given by the feed entry win; the page is the fallback."""
    fa = F.coalesce(feed_authors, F.array().cast("array<string>"))
    return F.when(F.size(fa) > 0, fa).otherwise(F.coalesce(page_authors, F.array().cast("array<string>")))


def el_pais_records(feed_docs: DataFrame, as_of, days: int = 1, pages: DataFrame | None = None,
                    max_per_feed: int | None = None, source: str = "El País", domain: str = "elpais.com") -> DataFrame:
    """El País (§2.15): 28 ordered MRSS feeds -> export records.

    LIM4 first ``max_per_feed`` entries of each feed; STR5 canonical URL, FLT10 http(s) only;
    DAT4 date, unknown dropped; FLT5 whole days since <= days, then FLT2 exact age; AGG2 first
    seen across feeds; URL2 sections with the feed tag as fallback (URL7); authors from the
    feed (AUT4), else from the page (HTM6), joined '; ', else 'Unknown'.
    ``feed_docs``: feed_ord, content.
    """
    from ..functions.authors import clean_cut
    from ..functions.dates import feed_date
    from ..functions.text import collapse_ws
    from ..operators import limits
    items = parse_feed(feed_docs, keep=["feed_ord"])
    if max_per_feed is not None:
        items = limits.head_of_each(items, "item_ord", max_per_feed)
    ts = feed_date("published", "updated", "created", "dc_date")
    e = with_once(items, "ts", ts).select("feed_ord", "item_ord", U.canonical_url("link").alias("url"), "title", "ts",
                                          "summary", "authors", "categories")
    e = e.filter(recency.http_only("url") & F.col("ts").isNotNull()
                 & recency.is_recent(F.col("ts"), as_of, days, "days_floor", keep_unknown=False)
                 & recency.is_recent(F.col("ts"), as_of, days, "age"))
    e = dedupe.first_seen(e, "url", ["feed_ord", "item_ord"])
    feed_auth = clean_cut(F.col("authors"), default=None)
    if pages is not None:
        wanted = enrich.pages_for(e, pages.select("url", "html"))
        e = e.join(wanted.select("url", el_pais_page_authors("html").alias("page_authors")), "url", "left")
        auth = feed_or_page_authors(feed_auth, F.col("page_authors"))
    else:
        auth = feed_auth
    sec = U.sections_nodate(F.col("url"))
    t = F.col("title")
    return e.select(
        "url",
        F.when(t.isNull() | (t == ""), F.lit("No title")).otherwise(F.trim(t)).alias("title"),
        iso_format(F.col("ts")).alias("publish_date"),
        F.when(F.size(auth) > 0, F.array_join(auth, "; ")).otherwise(F.lit("Unknown")).alias("authors"),
        F.lit(source).alias("source"), F.lit(domain).alias("domain"),
        F.coalesce(collapse_ws(F.col("summary")), F.lit("")).alias("summary"),
        U.section_or_tag(sec["section"], F.col("categories")).alias("section"),
        sec["subsection"].alias("subsection"))


def sitemap_overlay_records(pages: DataFrame, sitemap_docs: DataFrame, as_of, mode: str, source: str) -> DataFrame:
    """Público ('all') / El Español ('nonnull'): page-assembled records (PRJ18) overlaid with the
    facts of their news-sitemap entry (JON2), then required fields filled (PRJ3) and cleaned (PRJ19).

    all      title, publication date and URL sections of the entry replace the page's, nulls
             included (a missing sitemap title becomes the default title)
    nonnull  only present facts replace: title, publication date, publication name (source)
             and language ('es' when the entry has news data but no language)
    """
    from ..operators import records
    recs = records.assemble_article(pages, as_of, source=F.lit(source))
    e = parse_sitemap(sitemap_docs, keep=[]).filter("has_news")
    e = dedupe.first_seen(e, "loc", ["item_ord"]).withColumnRenamed("loc", "url")
    if mode == "all":
        sec = U.sections_base(F.col("url"))
        facts = e.select("url", F.col("news_title").alias("title"),
                         F.col("news_publication_date").alias("publish_date"),
                         sec["section"].alias("section"), sec["subsection"].alias("subsection"))
        cols = ["title", "publish_date", "section", "subsection"]
    else:
        facts = e.select("url", F.col("news_title").alias("title"),
                         F.col("news_publication_date").alias("publish_date"),
                         F.col("news_name").alias("source"),
                         F.coalesce("news_language", F.lit("es")).alias("language"))
        cols = ["title", "publish_date", "source", "language"]
    out = enrich.overlay(recs, facts, "url", cols, mode=mode)
    out = records.fill_required(out, as_of)
    return records.clean_record(out, as_of) if mode == "all" else out


def capped_site_urls(sitemap_entries: DataFrame, front_links: DataFrame | None, n: int | None = None) -> DataFrame:
    """Infobae / Vozpópuli URL discovery (LIM6 + FLT14 + STR7).

    Sitemap locations, distinct, in first-seen order; when fewer than ``n``, article links of
    the front page (``/noticias/`` ... ``.html``, made absolute) are added; the first ``n``
    per site are kept.  (The reference picks from a set; here the ordinal decides.)
    ``sitemap_entries``: site, feed_ord, item_ord, loc;  ``front_links``: site, base_url, pos, href.
    """
    from ..operators import limits
    sm = sitemap_entries.select("site", F.col("loc").alias("url"), F.lit(0).alias("tier"),
                                "feed_ord", "item_ord")
    if front_links is not None:
        fl = front_links.filter(U.is_article_link("href")).select(
            "site", U.absolute_url("base_url", "href").alias("url"), F.lit(1).alias("tier"),
            F.lit(0).alias("feed_ord"), F.col("pos").alias("item_ord"))
        sm = sm.unionByName(fl)
    return limits.first_distinct(sm, "url", "site", n, ["tier", "feed_ord", "item_ord"])


def jsonld_site_records(pages: DataFrame, as_of, site: str) -> DataFrame:
    """Infobae / Vozpópuli records from pages: title from the page (else JSON-LD headline),
    ISO publication date (null when invalid, DAT6), JSON-LD authors through the site's stop
    list (AUT6), description as summary, section by URL5 (Infobae) or URL6 (Vozpópuli)
    with the page breadcrumb."""
    from ..functions.authors import STOPLISTS, clean_stoplist
    from ..functions.dates import iso_or_default
    key = "infobae" if site.lower().startswith("infobae") else "voz_populi"
    stop, default, por = STOPLISTS[key]
    h = F.col("html")
    stage = pages.select("url", h, H.jsonld_authors(h, every_item=False).alias("_a"),
                         H.breadcrumb_second(h).alias("_crumb"))
    section = (U.section_capitalized(F.col("url"), F.col("_crumb")) if key == "infobae"
               else U.section_breadcrumb(F.col("url"), F.col("_crumb")))
    return stage.select(
        "url",
        F.coalesce(H.page_title(h), H.head_title(h), H.jsonld_field_last(h, "$.headline"), F.lit("")).alias("title"),
        iso_or_default(H.jsonld_field_last(h, "$.datePublished")).alias("publish_date"),
        clean_stoplist(F.col("_a"), stop, default, strip_por=por).alias("authors"),
        section.alias("section"), F.lit(site).alias("source"), U.domain(F.col("url")).alias("domain"),
        F.coalesce(H.jsonld_field_last(h, "$.description"), F.lit("")).alias("summary"))


def feed_page_records(entries: DataFrame, pages: DataFrame, as_of, days: int = 1, rule: str = "el_confidencial",
                      max_articles: int | None = None, source: str = "") -> DataFrame:
    """Feed entries -> page-assembled records.

    el_confidencial  FLT4 on the entry date (unknown = as_of, kept); entries of all feeds in
                     order, not deduplicated; first ``max_articles`` (LIM1); PRJ18 with the
                     strict author rule, PRJ3 defaults, PRJ19 clean-up
    20minutos        every item; PRJ18 with the strip/split author rule (AUT2, AUT7); FLT5 on
                     the page date in its two formats, unknown kept; PRJ17 record shape
    ``entries``: site, feed_ord, item_ord, url, published.
    """
    from ..functions.dates import parse_20min_date
    from ..operators import limits, records
    e = entries
    if rule == "el_confidencial":
        e = e.filter(recency.is_recent(parse_any(F.col("published")), as_of, days, "age_or_now"))
        e = limits.cap_per(e, "site", max_articles, ["feed_ord", "item_ord"], rank_col="rank")
    wanted = enrich.pages_for(e, pages.select("url", "html"))
    author_rule = "strict" if rule == "el_confidencial" else "strip"
    recs = records.assemble_article(wanted, as_of, source=F.lit(source), author_rule=author_rule,
                                    keep=["html"], default_author="Redacción" if rule == "el_confidencial"
                                    else "20minutos")
    if rule == "el_confidencial":
        out = recs.join(e.select("url", "rank"), "url")
        out = records.clean_record(records.fill_required(out, as_of), as_of)
        return out.drop("html")
    page_ts = parse_20min_date(H.time_datetime(F.col("html")))
    recs = recs.filter(recency.is_recent(page_ts, as_of, days, "days_floor", keep_unknown=True))
    return records.reshape_20min(recs)


def sitemap_then_rss_records(docs: DataFrame, pages: DataFrame, max_articles: int | None = None,
                             source: str = "") -> DataFrame:
    """Libertad Digital / eldiario.es: sitemap documents first, then RSS feeds, consumed in
    order under one quota (LIM5); every <loc> of a sitemap (index locations included), every
    item link of a feed; no recency filter (the days argument is unused there, B17); records
    from the page: title, ISO date or null, the single author meta (HTM11), section =
    ``urlparse(url).path.split('/')[1]`` (URL3), description as summary.
    ``docs``: site, src_ord, kind ('sitemap' / 'rss'), content.
    """
    from ..functions.dates import iso_or_default
    from ..operators import limits
    from ..sources.feeds import index_children
    sm = docs.filter(F.col("kind") == "sitemap")
    locs = parse_sitemap(sm, keep=["site", "src_ord"]).select("site", "src_ord", "item_ord", F.col("loc").alias("url"))
    idx = index_children(sm, keep=["site", "src_ord"]).select(
        "site", "src_ord", F.col("child_ord").alias("item_ord"), F.col("child_url").alias("url"))
    rss = parse_feed(docs.filter(F.col("kind") == "rss"), keep=["site", "src_ord"]).select(
        "site", "src_ord", "item_ord", F.col("link").alias("url"))
    seq = locs.unionByName(idx).unionByName(rss).filter(F.col("url").isNotNull())
    picked = limits.cap_sequential(seq, "site", max_articles, "src_ord", "item_ord", rank_col="rank")
    wanted = enrich.pages_for(picked, pages.select("url", "html"))
    h = F.col("html")
    m = H.meta_map(h)
    recs = wanted.select("url", F.coalesce(H.page_title(h), H.head_title(h)).alias("title"),
                         iso_or_default(H.time_datetime(h, meta=m)).alias("publish_date"),
                         H.meta_author_single(m, is_map=True).alias("authors"),
                         F.coalesce(F.element_at(m, F.lit("description")), F.lit("")).alias("summary"))
    first_piece = F.coalesce(F.get(F.split(U.url_path(F.col("url")), "/"), 1), F.lit(""))
    out = picked.join(recs, "url", "left")
    return out.select("site", "rank", "url", "title", "publish_date", "authors", first_piece.alias("section"),
                      F.lit(source).alias("source"), U.domain(F.col("url")).alias("domain"), "summary")
