"""Registered queries of the registry, feed, page and job rules, each with its DuckDB twin.

The documents, feeds and pages that a rule reads are built from columns of the given tables, and
the SQL reads those columns, so a rule that mis-reads its markup does not agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import authors as A
from ..functions import dates as D
from ..functions import html as H
from ..functions import text as X
from ..functions import urls as U
from ..operators import dedupe, enrich, recency, records
from .catalog import AS_OF, DAYS, HOUR_AS_OF, RSS_CHUNK, _rss_docs, _ts_text, table
from .oracle import _SLUG, _parts
from .sqlparts import canonical, fmt_ts, q

_AS_OF = f"TIMESTAMP {q(AS_OF)}"
FEED = "https://feeds.example/"


def _event_sites(spark, sf_dir):
    """A registry with a site per event type: its feeds are the RSS documents of the events, in order."""
    docs = _rss_docs(spark, sf_dir)
    url = F.concat(F.lit(FEED), "event_type", F.lit("/"), F.col("chunk").cast("string"))
    docs = docs.select("event_type", "chunk", url.alias("url"), "content")
    sites = docs.groupBy("event_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "url"))), lambda x: x["url"]).alias("rss_feeds"))
    empty = F.array().cast("array<string>")
    sites = sites.select(F.col("event_type").alias("name"), F.lit("https://news.example").alias("url"), F.lit(True).alias("use_rss"),
                         "rss_feeds", empty.alias("sitemap"), empty.alias("sitemaps"), F.lit(None).cast("int").alias("max_articles"),
                         F.lit(None).cast("int").alias("max_articles_per_feed"), F.lit("age").alias("recency_rule"),
                         F.lit("first").alias("section_rule"), F.lit("none").alias("author_rule"))
    return sites, docs


def site_plan(spark, sf_dir):
    """SRC9, SET6: the feeds of every site of the registry in order."""
    from ..sources.registry import feed_plan
    return feed_plan(_event_sites(spark, sf_dir)[0]).select("site", "kind", F.col("feed_ord").cast("long").alias("feed_ord"), "url")


def site_export(spark, sf_dir):
    """UDF2 and the site plan: all sites' feeds -> fresh, first seen, uncapped export records."""
    from .sites import run_sites
    sites, docs = _event_sites(spark, sf_dir)
    out, _ = run_sites(sites, docs, AS_OF, DAYS)
    return out.select("title", "url", "publish_date", "source", "domain", "section")


def site_ingest_report(spark, sf_dir):
    """AGG5: entries found, recent and skipped per site and feed, counted before any cap."""
    from .sites import run_sites
    sites, docs = _event_sites(spark, sf_dir)
    return run_sites(sites.withColumn("max_articles", F.lit(2)), docs, AS_OF, DAYS)[1].select(
        "site", F.col("feed_ord").cast("long").alias("feed_ord"), "n_found", "n_recent", "n_skipped")


def site_sitemap_head(spark, sf_dir):
    """LIM2: the first entries of every sitemap, before the recency rule."""
    from ..operators.limits import head_of_each
    from ..sources.feeds import parse_sitemap
    pages = table(spark, sf_dir, "pages")
    docs = (pages.groupBy(F.floor(F.col("page_id") / 16).alias("chunk")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("page_id", "url"))),
        lambda p: F.concat(F.lit("<url><loc>"), X.xml_escape(p["url"]), F.lit("</loc></url>"))), "").alias("e"))
        .select("chunk", F.concat(F.lit("<urlset>"), "e", F.lit("</urlset>")).alias("content")))
    e = head_of_each(parse_sitemap(docs, keep=["chunk"]), "item_ord", 5)
    return e.select("chunk", F.col("item_ord").cast("long").alias("item_ord"), "loc")


def registry_gaps(spark, sf_dir):
    """FLT15: required registry fields that a site lacks."""
    from ..sources.registry import registry_check
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("k"))
    arr = (lambda on: F.when(on, F.array(F.lit("https://x/s.xml"))).otherwise(F.array().cast("array<string>")))
    sites = d.select(F.col("source").alias("name"), F.when(F.col("k") % 3 != 0, F.lit("https://x")).alias("url"),
                     arr(F.col("k") % 2 == 0).alias("sitemap"), arr(F.col("k") % 5 == 0).alias("sitemaps"),
                     F.when(F.col("k") % 7 != 0, F.lit(True)).alias("is_own_site"))
    return registry_check(sites).select("name", F.array_join("missing", ",").alias("missing"), "complete")


def attach_site(spark, sf_dir):
    """JON9: site attributes onto records."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("site"))
    sites = docs.groupBy("site").agg(F.min("doc_id").alias("max_articles")).select(
        "site", F.upper("site").alias("source"), F.concat(F.col("site"), F.lit(".example")).alias("domain"), "max_articles")
    return enrich.attach_site(docs, sites)


def rejects_split(spark, sf_dir):
    """FLT11: payloads with the error marker (or none) apart from the good ones."""
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat(F.lit('{"error_url_report":"'), "url", F.lit('"}')))
                                             .when(F.col("page_id") % 7 != 0, F.concat(F.lit('{"og:url":"'), "url", F.lit('"}'))).alias("data"))
    good, bad = recency.split_rejects(p, "data")
    return good.select("page_id", F.lit("good").alias("side")).unionByName(bad.select("page_id", F.lit("reject").alias("side")))


def identity_and_time(spark, sf_dir):
    """FLT12: identity URL present and one of the four times present."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    rows = e.select("event_id", F.when(k % 4 != 0, F.lit("u")).alias("og.url"), F.when(k % 3 == 0, F.lit("t")).alias("article.published_time"),
                    F.lit(None).cast("string").alias("og.published_time"), F.when(k % 5 == 0, F.lit("t")).alias("og.modified_time"),
                    F.when(k % 7 == 0, F.lit("t")).alias("article.modified_time"))
    return rows.filter(recency.has_identity_and_time()).select("event_id")


def null_lastmod(spark, sf_dir):
    """FLT13, SET1, JON5: entries with a lastmod, and those without that were published before the end
    of the run hour, resolved from the page's times."""
    e = table(spark, sf_dir, "events")
    k, t = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    rows = e.select("event_id", F.when(k % 3 == 0, F.lit("given")).alias("lastmod"), F.when(k % 4 != 0, t).alias("pub"),
                    F.when(k % 2 == 0, F.lit("article")).alias("a"), (k % 5 != 0).alias("has_article"), F.lit("og").alias("o"))
    has, missing = recency.split_null_lastmod(rows, AS_OF, "lastmod", "pub")
    missing = missing.withColumn("lastmod", enrich.resolve_lastmod(F.col("a"), F.col("has_article"), F.col("o")))
    return has.unionByName(missing).select("event_id", "lastmod")


def url_dates(spark, sf_dir):
    """DAT3 and FLT6's URL branch: the first valid date in the path, and recency by it."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    path = F.when(k % 3 == 0, F.date_format("ts", "yyyy/MM/dd")).when(k % 3 == 1, F.concat(F.lit("2024/13/45/"), F.date_format("ts", "yyyy/M/d"))) \
        .otherwise(F.lit("no/date"))
    url = F.concat(F.lit("https://news.example/"), path, F.lit("/"), k.cast("string"), F.lit(".html"))
    lastmod = F.when(k % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k % 5 == 1, F.lit("broken"))
    rows = e.select("event_id", url.alias("url"), lastmod.alias("lastmod"))
    return rows.select("event_id", F.date_format(D.url_date("url"), "yyyy-MM-dd").alias("url_day"),
                       recency.is_recent(F.col("lastmod"), AS_OF, DAYS, "lastmod_or_url", url=F.col("url")).alias("recent"))


def unknown_dates(spark, sf_dir):
    """FLT1-FLT5, FLT7: each rule over dated rows and rows of unknown date (a third of them)."""
    e = table(spark, sf_dir, "events")
    ts = F.when(F.col("event_id") % 3 != 0, D.to_instant("ts"))
    rows = e.select("event_id", ts.alias("t"))
    return rows.select("event_id", *(recency.is_recent(F.col("t"), AS_OF, DAYS, r).alias(r)
                                     for r in ("midnight", "age", "calendar", "age_or_now", "days_floor", "min_date")))


def _page(meta, body):
    return F.concat(F.lit("<html><head>"), meta, F.lit("</head><body>"), body, F.lit("</body></html>"))


def page_meta(spark, sf_dir):
    """HTM2, HTM11, HTM7, HTM9, PRJ11: meta tags in both attribute orders, a time in three quotings,
    a breadcrumb and the paywall marker, in pages built from the customers."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    meta = F.concat(F.lit('<meta name="author" content="'), "c_name", F.lit('"><meta content="'), F.col("c_mktsegment"),
                    F.lit('" property="article:section">'))
    when = F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    time = F.when(k % 3 == 0, F.concat(F.lit('<time datetime="'), when, F.lit('">x</time>'))) \
        .when(k % 3 == 1, F.concat(F.lit("<time class=c datetime='"), when, F.lit("'>x</time>"))) \
        .otherwise(F.concat(F.lit("<time datetime=2023-01-01>o</time><time datetime="), when, F.lit(" itemprop=datePublished>x</time>")))
    body = F.concat(F.lit('<ol class="breadcrumb"><li>Home</li><li><a>'), "c_mktsegment", F.lit("</a></li></ol>"), time,
                    F.when(k % 4 == 0, F.lit('<script>{"isAccessibleForFree": false}</script>')).otherwise(""))
    p = c.select("c_custkey", _page(meta, body).alias("html"))
    m = H.meta_map("html")
    return p.select("c_custkey", F.element_at(m, F.lit("article:section")).alias("section"),
                    F.array_join(H.meta_author_single("html"), "|").alias("author"), H.time_datetime("html").alias("day"),
                    H.breadcrumb_second("html").alias("crumb"), H.paywall_flag("html").alias("flag"))


def page_jsonld(spark, sf_dir):
    """HTM5: author as a list, an object and a string, a broken block, and the first headline."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = (lambda a: F.concat(F.lit('{"name":"'), a, F.lit('"}')))
    author = F.when(k % 3 == 0, F.concat(F.lit("["), name(F.col("c_name")), F.lit(","), name(F.col("c_mktsegment")), F.lit("]"))) \
        .when(k % 3 == 1, name(F.col("c_name"))).otherwise(F.concat(F.lit('"'), "c_name", F.lit('"')))
    block = F.concat(F.lit('<script type="application/ld+json">{"headline":"H'), k.cast("string"), F.lit('","author":'), author, F.lit("}</script>"))
    p = c.select("c_custkey", F.concat(F.lit('<script type="application/ld+json">{broken</script>'), block).alias("html"))
    return p.select("c_custkey", F.array_join(H.jsonld_authors("html"), "|").alias("authors"), H.jsonld_field("html", "$.headline").alias("headline"))


def page_references(spark, sf_dir):
    """Character references (named, decimal, hexadecimal, twice-escaped) and links in every quoting."""
    c = table(spark, sf_dir, "customer")
    text = F.concat(F.lit("Espa&ntilde;a &#8217;&#x20AC; &amp;lt; &bogus; "), F.col("c_name"))
    html = F.concat(F.lit("<p>"), text, F.lit("</p><a href='/a/"), "c_name", F.lit("'>x</a><a class=b href=/b/"), "c_custkey",
                    F.lit(' >y</a><a href="/c">z</a>'))
    p = c.select("c_custkey", html.alias("html"))
    return p.select("c_custkey", H.tag_text(H.first_tag_inner("html", "p")).alias("text"), F.array_join(H.links("html"), " ").alias("links"))


def rdf_feed(spark, sf_dir):
    """SRC3: RSS 1.0 (items beside the channel), dates in ``date``, text in ``content:encoded``, CDATA (STR4)."""
    from ..sources.feeds import parse_feed
    e = table(spark, sf_dir, "events")
    k = F.col("event_id").cast("string")
    item = F.concat(F.lit("<item><title><![CDATA["), "event_type", F.lit(" <b>]]></title><link>https://x/"), k, F.lit("</link><date>"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</date><content:encoded>c"), k, F.lit("</content:encoded></item>"))
    docs = (e.select(F.floor(F.col("event_id") / RSS_CHUNK).alias("chunk"), "event_id", item.alias("item")).groupBy("chunk")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda s: s["item"]), "").alias("items"))
            .select("chunk", F.concat(F.lit('<rdf:RDF xmlns:rdf="r" xmlns:content="c"><channel><title>t</title></channel>'), "items",
                                      F.lit("</rdf:RDF>")).alias("content")))
    return parse_feed(docs, keep=["chunk"]).select("chunk", F.col("item_ord").cast("long").alias("item_ord"), "title", "link",
                                                   _ts_text(D.parse_iso_any("dc_date")).alias("published"), "summary")


def entry_records(spark, sf_dir):
    """PRJ20: records from entries without a page: the entry's title, else one from the URL's last piece."""
    p = table(spark, sf_dir, "pages")
    e = p.select("page_id", U.canonical_url("url").alias("url"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("News "), F.col("page_id").cast("string"))).alias("news_title"),
                 F.when(F.col("page_id") % 3 == 0, F.lit("2024-01-02T03:04:05Z")).otherwise(F.lit("bad")).alias("published"))
    r = records.record_from_entry(e, AS_OF)
    return r.select("page_id", "title", "publish_date", "summary")


def required_fields(spark, sf_dir):
    """PRJ3, PRJ4: nulls filled with the typed defaults; failed rows as the error record."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    rows = d.select("doc_id", F.when(k % 2 == 0, F.lit("T")).alias("title"), F.lit(None).cast("string").alias("section"),
                    F.when(k % 5 == 0, F.lit("boom")).alias("err"))
    r = records.error_record(records.fill_required(rows, AS_OF), "err", AS_OF)
    return r.select("doc_id", "title", "section", F.array_join("authors", ",").alias("authors"), "summary", "is_error")


def superset_columns(spark, sf_dir):
    """PRJ15, PRJ17: union of records with different columns, preferred ones first."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("title"), F.col("doc_id").alias("key"), "text")
    p = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("key"))
    both = records.superset([d, p], ["title", "url"])
    return records.reshape_20min(both.withColumn("key2", F.col("key"))).select("url", "title", "section", "text")


def distinct_authors(spark, sf_dir):
    """AGG4, AGG7: distinct names over several lists of a row, and without regard to case inside one."""
    c = table(spark, sf_dir, "customer")
    a = F.array("c_name", F.upper("c_name"), F.col("c_mktsegment"))
    b = F.array(F.col("c_mktsegment"), F.lit(""), F.col("c_name"))
    return c.select("c_custkey", F.array_join(dedupe.distinct_authors(a, b), "|").alias("merged"),
                    F.array_join(dedupe.ci_distinct(a), "|").alias("ci"))


def author_values(spark, sf_dir):
    """AUT9: author meta values without URL prefix and at sign."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace("c_name", "#", " ").alias("n"))
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("https://x.es/autor/"), "n")).when(k % 3 == 1, F.concat(F.lit("@"), "n")).otherwise(F.col("n"))
    return c.select("c_custkey", A.meta_author_value(raw).alias("author"))


def tag_section(spark, sf_dir):
    """URL7: the feed's tag where the URL gives no section."""
    e = table(spark, sf_dir, "events")
    sec = F.when(F.col("event_id") % 2 == 0, F.lit("Urlsec")).otherwise(F.lit(""))
    tags = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit(" "), "event_type", F.lit(" ")), F.lit("x")))
    return e.select("event_id", U.section_or_tag(sec, tags).alias("section"))


JOB_DELAY = 6


def hourly_job(spark, sf_dir):
    """STM1 end to end: feed documents and pages -> curated hours, links, payloads, rejects (a link in eleven
    has no page), published rows of the run's window and the latest HTML; the published dataset read back."""
    from ..session import scratch_path
    from .medallion import run_hour
    ev = table(spark, sf_dir, "events").filter("event_id % 11 <> 0")
    url = F.concat(F.lit("https://news.example/"), "event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".html"))
    when = F.date_format(D.to_instant("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    meta = F.concat(F.lit('<meta property="og:url" content="'), url, F.lit('"><meta property="article:published_time" content="'), when,
                    F.lit('"><meta property="article:modified_time" content="'), when, F.lit('"><meta name="msapplication-TileColor" content="c'),
                    F.col("event_id").cast("string"), F.lit('">'))
    pages = ev.select(url.alias("url"), _page(meta, F.lit("<article><p>x</p></article>")).alias("html"))
    docs = _rss_docs(spark, sf_dir).select(F.col("event_type").alias("site"), "content")
    paths = run_hour(spark, docs, None, pages, scratch_path(spark, "hourly-job"), HOUR_AS_OF, JOB_DELAY)
    columns = ["og_url", "category", "isAccessibleForFree", "day_of_week", "msapplication-TileColor", "year", "month", "day", "hour"]
    pub = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).parquet(paths["published"])
    return pub.withColumnRenamed("msapplication-TileColor", "color").withColumnRenamed("isAccessibleForFree", "access")


RULE_QUERIES = {f.__name__: f for f in (
    site_plan, site_export, site_ingest_report, site_sitemap_head, registry_gaps, attach_site, rejects_split, identity_and_time,
    null_lastmod, url_dates, unknown_dates, page_meta, page_jsonld, page_references, rdf_feed, entry_records, required_fields,
    superset_columns, distinct_authors, author_values, tag_section, hourly_job)}

_CHUNK = f"floor(event_id / {RSS_CHUNK})"
_FEEDS = f"""SELECT event_type, chunk, (row_number() OVER (PARTITION BY event_type ORDER BY chunk) - 1)::BIGINT AS feed_ord
             FROM (SELECT DISTINCT event_type, CAST({_CHUNK} AS BIGINT) AS chunk FROM events)"""
_FRESH = f"date_trunc('second', ts) >= {_AS_OF} - INTERVAL {DAYS} DAY"

_LO, _HI = recency.hour_bounds(HOUR_AS_OF, JOB_DELAY)

RULE_ORACLE = {
    "hourly_job": f"""WITH e AS (SELECT *, {_parts('ts')} FROM events WHERE event_id % 11 <> 0)
        SELECT 'https://news.example/' || event_type || '/' || event_id || '.html' AS og_url, event_type AS category, 'FREE' AS access,
               dayname(ts) AS day_of_week, 'c' || event_id AS color, year, month, day, hour
        FROM e WHERE TRY_CAST(year || month || day || hour AS INTEGER) BETWEEN {_LO} AND {_HI}""",
    "site_plan": f"SELECT event_type AS site, 'rss' AS kind, feed_ord, '{FEED}' || event_type || '/' || chunk AS url FROM ({_FEEDS})",
    "site_export": f"""SELECT event_type || ' & user ' || user_id AS title, 'https://news.example/' || event_type || '/' || event_id || '.html' AS url,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS publish_date, event_type AS source, 'news.example' AS domain,
        event_type AS section FROM events WHERE {_FRESH}""",
    "site_ingest_report": f"""SELECT e.event_type AS site, f.feed_ord, count(*) AS n_found, count(*) FILTER ({_FRESH}) AS n_recent,
        count(*) FILTER (NOT ({_FRESH})) AS n_skipped FROM events e JOIN ({_FEEDS}) f
        ON f.event_type = e.event_type AND f.chunk = {_CHUNK} GROUP BY 1, 2""",
    "site_sitemap_head": """SELECT CAST(floor(page_id / 16) AS BIGINT) AS chunk, (row_number() OVER w - 1)::BIGINT AS item_ord, url AS loc FROM pages
        WINDOW w AS (PARTITION BY floor(page_id / 16) ORDER BY page_id) QUALIFY row_number() OVER w <= 5""",
    "registry_gaps": """WITH s AS (SELECT source AS name, min(doc_id) AS k FROM documents GROUP BY 1)
        SELECT name, array_to_string(list_filter([CASE WHEN k % 3 = 0 THEN 'url' END, CASE WHEN k % 2 <> 0 AND k % 5 <> 0 THEN 'sitemap' END,
               CASE WHEN k % 7 = 0 THEN 'is_own_site' END], lambda x: x IS NOT NULL), ',') AS missing,
               k % 3 <> 0 AND (k % 2 = 0 OR k % 5 = 0) AND k % 7 <> 0 AS complete FROM s""",
    "attach_site": """SELECT doc_id, source AS site, upper(source) AS source, source || '.example' AS domain,
        min(doc_id) OVER (PARTITION BY source) AS max_articles FROM documents""",
    "rejects_split": "SELECT page_id, CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 THEN 'reject' ELSE 'good' END AS side FROM pages",
    "identity_and_time": "SELECT event_id FROM events WHERE event_id % 4 <> 0 AND (event_id % 3 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0)",
    "null_lastmod": f"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'given' WHEN event_id % 5 = 0 THEN 'og'
        WHEN event_id % 2 = 0 THEN 'article' END AS lastmod FROM events
        WHERE event_id % 3 = 0 OR (event_id % 4 <> 0 AND date_trunc('second', ts) < date_trunc('hour', {_AS_OF}) + INTERVAL 1 HOUR)""",
    "url_dates": f"""SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN strftime(ts, '%Y-%m-%d') END AS url_day,
        CASE WHEN event_id % 5 = 0 THEN date_trunc('second', ts) >= {_AS_OF} - INTERVAL {DAYS} DAY WHEN event_id % 5 = 1 THEN FALSE
             WHEN event_id % 3 <> 2 THEN CAST(ts AS DATE) >= {_AS_OF} - INTERVAL {DAYS} DAY ELSE FALSE END AS recent FROM events""",
    "unknown_dates": f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS t FROM events)
        SELECT event_id, coalesce(t >= date_trunc('day', {_AS_OF}) - INTERVAL {DAYS} DAY, TRUE) AS midnight,
               coalesce(t >= {_AS_OF} - INTERVAL {DAYS} DAY, FALSE) AS age,
               coalesce(CAST({_AS_OF} AS DATE) - CAST(t AS DATE) <= {DAYS}, FALSE) AS calendar,
               coalesce(t >= {_AS_OF} - INTERVAL {DAYS} DAY, TRUE) AS age_or_now,
               coalesce(floor((epoch_us({_AS_OF}) - epoch_us(t)) / 86400000000.0) <= {DAYS}, TRUE) AS days_floor,
               coalesce(t >= {_AS_OF} - INTERVAL {DAYS} DAY, TRUE) AS min_date FROM e""",
    "page_meta": """SELECT c_custkey, c_mktsegment AS section, c_name AS author, '2024-01-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') AS day,
        c_mktsegment AS crumb, CASE WHEN c_custkey % 4 = 0 THEN 'LOCKED' ELSE 'FREE' END AS flag FROM customer""",
    "page_jsonld": """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || '|' || c_mktsegment ELSE c_name END AS authors,
        'H' || c_custkey AS headline FROM customer""",
    "page_references": """SELECT c_custkey, 'España ’€ &lt; &bogus; ' || c_name AS text, '/a/' || c_name || ' /b/' || c_custkey || ' /c' AS links
        FROM customer""",
    "rdf_feed": f"""SELECT CAST({_CHUNK} AS BIGINT) AS chunk, (row_number() OVER (PARTITION BY {_CHUNK} ORDER BY event_id) - 1)::BIGINT AS item_ord,
        event_type || ' <b>' AS title, 'https://x/' || event_id AS link, {fmt_ts("date_trunc('second', ts)")} AS published, 'c' || event_id AS summary FROM events""",
    "entry_records": f"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'News ' || page_id ELSE {_SLUG} END AS title,
        CASE WHEN page_id % 3 = 0 THEN '2024-01-02T03:04:05+00:00'
        ELSE strftime({_AS_OF}, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS publish_date, '' AS summary FROM (SELECT page_id, {canonical("url")} AS url FROM pages)""",
    "required_fields": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Error al extraer el artículo' WHEN doc_id % 2 = 0 THEN 'T' ELSE 'Sin título' END AS title,
        CASE WHEN doc_id % 5 = 0 THEN 'error' ELSE 'general' END AS section, CASE WHEN doc_id % 5 = 0 THEN 'Error' ELSE 'Redacción' END AS authors,
        CASE WHEN doc_id % 5 = 0 THEN 'Error al procesar el artículo: boom' ELSE '' END AS summary, doc_id % 5 = 0 AS is_error FROM documents""",
    "superset_columns": """SELECT NULL::VARCHAR AS url, source AS title, '' AS section, text FROM documents
        UNION ALL SELECT url, NULL, '', NULL FROM pages""",
    "distinct_authors": """SELECT c_custkey, array_to_string(list_sort(list_distinct([c_name, upper(c_name), c_mktsegment])), '|') AS merged,
        c_name || '|' || c_mktsegment AS ci FROM customer""",
    "author_values": """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'autor/' ELSE '' END || replace(c_name, '#', ' ') AS author
        FROM customer""",
    "tag_section": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'Urlsec' WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS section FROM events""",
}
