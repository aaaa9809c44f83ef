"""Registered queries of joins over time, retention, history schemas, author sources and the whole hourly job.

As in ``catalog_rules``: what a rule reads is built from columns of the given tables, and the SQL
reads those columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import authors as A
from ..functions import dates as D
from ..operators import enrich, records
from .catalog import AS_OF, HOUR_AS_OF, _export_records, _rss_docs, _ts_text, table
from .catalog_rules import _HI, _LO, JOB_DELAY, _page
from .oracle import _parts
from .sqlparts import clean_ws, fmt_ts, q

_AS_OF = f"TIMESTAMP {q(AS_OF)}"


# ------------------------------------------------------------------ JON4
def page_as_of(spark, sf_dir):
    """JON4: each event's link takes the newest snapshot of its page not after the event. Three pages in a row are
    snapshots of one URL, eight days apart; links of later users have none."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    at = F.lit("2024-01-02 00:00:00").cast("timestamp") + F.make_dt_interval((k % 3 * 8).cast("int"), F.lit(0), (k % 50).cast("int"))
    url = (lambda n: F.concat(F.lit("https://news.example/"), n.cast("string")))
    pages = p.select(url(F.floor(k / 3)).alias("url"), at.alias("fetched_at"), "html", "page_id")
    links = table(spark, sf_dir, "events").select("event_id", url(F.col("user_id")).alias("url"), D.to_instant("ts").alias("at"))
    out = enrich.attach_pages_as_of(links, pages, "at", page_cols=("html", "page_id"))
    return out.select("event_id", "has_page", "page_id", F.length("html").cast("long").alias("html_chars"),
                      _ts_text("fetched_at").alias("fetched"))


# ------------------------------------------------------------------ SNK6, SNK7
def _exported_days(spark, sf_dir):
    """An export of the documents on four days, a run each; its folder."""
    from ..session import scratch_path
    from ..sinks.writers import write_export
    out = scratch_path(spark, "export-days")
    docs = table(spark, sf_dir, "documents")
    for d in range(4):
        write_export(_export_records(docs.filter(F.col("doc_id") % 4 == d)), out, f"2024-01-{16 + 4 * d:02d} 13:00:00")
    return out


def retention(spark, sf_dir):
    """SNK6: of four export days, those older than a week are dropped; a dry run lists the same and drops nothing, and
    a second run finds nothing left. What is left is read back (SRC12)."""
    from ..sinks.writers import apply_retention
    from ..sources.tables import read_export
    out = _exported_days(spark, sf_dir)
    listed = apply_retention(spark, out, AS_OF, 7, dry_run=True)
    dropped = apply_retention(spark, out, AS_OF, 7)
    again = apply_retention(spark, out, AS_OF, 7)
    left = read_export(spark, out).groupBy("source_key", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    return left.select("source_key", "dt", "n", F.lit(listed == dropped and bool(dropped) and not again).alias("consistent"))


def outputs_of_day(spark, sf_dir):
    """SNK7: rows per source of one export day, from the counts beside the export; files from the listing."""
    from ..sinks.writers import outputs_on
    day = outputs_on(spark, _exported_days(spark, sf_dir), "2024-01-24")
    return day.select("source_key", "n_rows", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > 0).alias("has_bytes"))


# ------------------------------------------------------------------ PRJ16
def history_widen(spark, sf_dir):
    """PRJ16: two stored days whose files have different columns, read as one with the columns of both."""
    from ..session import scratch_path
    from ..sinks.writers import write_hours
    from ..sources.tables import read_touched_hours
    e = table(spark, sf_dir, "events")
    at = D.to_instant("ts")
    rows = e.select("event_id", "value", "event_type", F.date_trunc("day", at).alias("t"), (F.dayofmonth(at) > 15).alias("late"))
    rows = records.hour_columns(rows, "t", "UTC")
    out = scratch_path(spark, "history")
    write_hours(rows.filter("not late").drop("late", "event_type", "t"), out)
    write_hours(rows.filter("late").drop("late", "value", "t"), out)
    hours = [("2024", "01", f"{d:02d}", "00") for d in range(1, 32)]
    back = read_touched_hours(spark, out, hours, ["event_id", "summary"], drift="widen")
    return back.select("event_id", "value", "event_type", "summary", "day")


# ------------------------------------------------------------------ DAT9
def relative_bounds(spark, sf_dir):
    """DAT9: bounds like now-1d and now-6h of a registry, and whether an event lies between two of them."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    start = F.when(k % 5 == 0, F.concat(F.lit("now-"), (k % 40).cast("string"), F.lit("d"))) \
        .when(k % 5 == 1, F.concat(F.lit(" NOW-"), (k % 700).cast("string"), F.lit("h "))) \
        .when(k % 5 == 2, F.lit("yesterday")).when(k % 5 == 3, F.lit("now+90m")).otherwise(F.lit("now"))
    rows = e.select("event_id", D.to_instant("ts").alias("t"), D.relative_instant(start, AS_OF).alias("lo"),
                    D.relative_instant(F.lit("now"), AS_OF).alias("hi"))
    return rows.select("event_id", _ts_text("lo").alias("bound"), F.col("t").between(F.col("lo"), F.col("hi")).alias("inside"))


# ------------------------------------------------------------------ authors of pages and records
def page_authors(spark, sf_dir):
    """HTM3, HTM6: authors of pages built from the customers. JSON-LD authors win; else meta tags (AUT9) and author
    elements, cleaned by the cut rule (AUT4); texts that hold a stop word or are too long are no authors."""
    from .sites import el_pais_page_authors
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.concat(F.lit("Ana "), F.translate("c_mktsegment", " ", ""))
    other = F.concat(F.lit("Luis "), F.translate("c_mktsegment", " ", ""))
    ld = F.when(k % 3 == 0, F.concat(F.lit('<script type="application/ld+json">{"author":{"name":"'), name, F.lit('"}}</script>'))).otherwise("")
    meta = F.when(k % 2 == 0, F.concat(F.lit('<meta name="author" content="https://x.es/'), name, F.lit('">'))).otherwise("")
    body = F.concat(F.lit('<span class="big firma_nombre">by <b>'), other, F.lit("</b></span><a rel=author>Redacción central</a>"
                    "<div class='byline'>"), F.repeat(F.lit("x"), 101), F.lit("</div><p itemprop=author>Seguir a Eva</p>"))
    p = c.select("c_custkey", _page(F.concat(meta, ld), body).alias("html"))
    return p.select("c_custkey", F.array_join(el_pais_page_authors("html"), "|").alias("authors"))


def author_sources(spark, sf_dir):
    """AUT10, AUT11, AUT6, AUT8: extracted names, else meta names, else the byline, else the default (strict rule); names of
    a 'Por ...' byline; the stop list of a site; a name from an e-mail address."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.concat(F.lit("Ana "), F.initcap(F.translate("c_mktsegment", " ", "")))
    rows = c.select("c_custkey", name.alias("n"),
                    F.when(k % 2 == 0, F.array(name, F.lit("12:30"), F.upper(name))).alias("extracted"),
                    F.when(k % 3 == 0, F.array(F.concat(F.lit("Luis "), F.initcap(F.translate("c_mktsegment", " ", ""))))).alias("meta"),
                    F.when(k % 5 == 0, F.lit("Eva Ruiz Gil")).otherwise("redacción").alias("byline"))
    stop, default, por = A.STOPLISTS["voz_populi"]
    listed = A.clean_stoplist(F.array(F.concat(F.lit("Por "), "n"), F.lit("vozpópuli"), F.when(k % 2 == 0, F.col("n"))), stop, default, por)
    none = A.clean_stoplist(F.array(F.lit("Redacción"), F.lit(" ")), stop, default, por)
    return rows.select(
        "c_custkey", F.array_join(A.author_precedence("extracted", "meta", "byline"), "|").alias("authors"),
        F.array_join(A.byline_names(F.concat(F.lit("12 de enero. Por "), "n", F.lit(" | hoy"))), "|").alias("byline"),
        F.array_join(listed, "|").alias("listed"), F.array_join(none, "|").alias("nobody"),
        A.name_from_email(F.concat(F.lower(F.translate("n", " ", ".")), F.lit("@x.es"))).alias("mail"))


def clean_records(spark, sf_dir):
    """PRJ19: texts cleaned, authors through the strict rule with a default, dates to ISO or the run's time."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    rows = d.select("doc_id", F.concat(F.lit("  A\t"), "lang", F.lit(" \n")).alias("title"), "text", F.lit(None).cast("string").alias("summary"),
                    F.when(k % 2 == 0, F.lit("Ana Gil")).when(k % 3 == 0, F.lit("de la web")).alias("authors"),
                    F.when(k % 5 == 0, F.lit("2024-01-02T03:04:05Z")).otherwise("soon").alias("publish_date"))
    r = records.clean_record(rows, AS_OF)
    return r.select("doc_id", "title", "text", "summary", F.array_join("authors", "|").alias("authors"), "publish_date")


# ------------------------------------------------------------------ SRC8, SRC11
def registry_lookup(spark, sf_dir):
    """SRC8: a registry written as JSON lines with missing keys and loaded with its schema; a site found by its name in
    any case; SRC9: sitemaps of sites that use no RSS."""
    from ..session import scratch_path
    from ..sources.registry import feed_plan, load_sites, site_by_name
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("k"))
    feeds = F.when(F.col("k") % 2 == 0, F.array(F.concat(F.lit("https://x/"), "source"))).alias("rss_feeds")
    out = scratch_path(spark, "registry")
    d.select(F.col("source").alias("name"), F.lit("https://x").alias("url"), (F.col("k") % 3 != 0).alias("use_rss"), feeds,
             F.array(F.concat(F.lit("https://s/"), "source"), F.lit("https://s/2")).alias("sitemap")).write.json(out)
    sites = load_sites(spark, out)
    plan = feed_plan(sites).select("site", "kind", F.col("feed_ord").cast("long").alias("feed_ord"), "url")
    found = site_by_name(sites, "SRC1").select(F.lit("site").alias("site"), F.col("name").alias("kind"), F.size("rss_feeds").cast("long").alias("feed_ord"), "url")
    return plan.unionByName(found)


def stored_pages(spark, sf_dir):
    """SRC11: the page table as its schema has it, whatever other columns are stored."""
    from ..session import scratch_path
    from ..sources.tables import read_pages
    out = scratch_path(spark, "pages")
    table(spark, sf_dir, "pages").select(F.lit(1).alias("status"), "html", "url", "page_id").write.parquet(out)
    return read_pages(spark, out)


# ------------------------------------------------------------------ STM1 whole
def hourly_runs(spark, sf_dir):
    """STM1 with both sides and two runs: feed links and sitemap locations (SET3, FLT13: entries without a lastmod take the
    page's time), pages, rejects appended by each run (SNK2), the latest HTML (SNK3) and the published rows, whose audit
    time is the last run's (PRJ12). Links of every eleventh event and no sitemap entry lack a page."""
    from ..session import scratch_path
    from .medallion import _stage, run_hour
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id").cast("string")
    when = F.date_format(D.to_instant("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.concat(F.lit("https://news.example/"), "event_type", F.lit("/"), k, F.lit(".html"))
    mapped = F.concat(F.lit("https://news.example/mapa/"), k, F.lit(".html"))

    def meta(u):
        return F.concat(F.lit('<meta property="og:url" content="'), u, F.lit('"><meta property="article:published_time" content="'), when,
                        F.lit('"><meta property="article:modified_time" content="'), when, F.lit('">'))
    body = F.lit("<article><p>x</p></article>")
    pages = ev.filter("event_id % 11 <> 0").select(url.alias("url"), _page(meta(url), body).alias("html")).unionByName(
        ev.select(mapped.alias("url"), _page(meta(mapped), body).alias("html")))
    entry = F.concat(F.lit("<url><loc>"), mapped, F.lit("</loc>"),
                     F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("<lastmod>"), when, F.lit("</lastmod>"))).otherwise(""),
                     F.lit("<news:news><news:publication_date>"), when, F.lit("</news:publication_date><news:title>t</news:title></news:news></url>"))
    maps = (ev.select(F.floor(F.col("event_id") / 64).alias("chunk"), "event_id", entry.alias("e")).groupBy("chunk")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "e"))), lambda s: s["e"]), "").alias("e"))
            .select(F.lit("mapa").alias("site"), F.concat(F.lit('<urlset xmlns:news="n">'), "e", F.lit("</urlset>")).alias("content")))
    feeds = _rss_docs(spark, sf_dir).select(F.col("event_type").alias("site"), "content")
    feeds, maps, pages = _stage(feeds, "feeds"), _stage(maps, "maps"), _stage(pages, "pages")     # landed once, read by both runs
    out = scratch_path(spark, "hourly-runs")
    for run in (1, 2):
        paths = run_hour(spark, feeds, maps, pages, out, HOUR_AS_OF, JOB_DELAY, run_ts=f"2024-01-28 13:0{run}:00")

    def read(name, columns):
        return spark.read.schema(", ".join(f"`{c}` string" for c in [*columns, "year", "month", "day", "hour"])).parquet(paths[name])
    pub = read("published", ["og_url", "category", "audit_time"]).select("og_url", "category", "audit_time", "hour", F.lit("published").alias("dataset"))
    html = read("published_html", ["og_url", "html"]).select("og_url", F.lit(None).cast("string").alias("category"),
                                                             F.length("html").cast("string").alias("audit_time"), "hour", F.lit("html").alias("dataset"))
    bad = read("errors", ["link"]).groupBy("link", "hour").agg(F.count(F.lit(1)).cast("string").alias("audit_time")).select(
        F.col("link").alias("og_url"), F.lit(None).cast("string").alias("category"), "audit_time", "hour", F.lit("errors").alias("dataset"))
    return pub.unionByName(html).unionByName(bad)


FLOW_QUERIES = {f.__name__: f for f in (page_as_of, retention, outputs_of_day, history_widen, relative_bounds, page_authors, author_sources,
                                        clean_records, registry_lookup, stored_pages, hourly_runs)}

_SEG = "upper(substr(c_mktsegment, 1, 1)) || lower(replace(substr(c_mktsegment, 2), ' ', ''))"
_AS_OF_ISO = q(AS_OF.replace(" ", "T") + "+00:00")
_SOURCE_KEY = "regexp_replace(lower(source), '[^\\p{L}\\p{N}]', '_', 'g')"
_WHEN = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"


def _job_page(url: str) -> str:
    return (f"'<html><head><meta property=\"og:url\" content=\"' || {url} || '\"><meta property=\"article:published_time\" content=\"' || {_WHEN} || "
            f"'\"><meta property=\"article:modified_time\" content=\"' || {_WHEN} || '\"></head><body><article><p>x</p></article></body></html>'")


FLOW_ORACLE = {
    "page_as_of": f"""WITH s AS (SELECT 'https://news.example/' || (page_id // 3) AS url, html, page_id,
            TIMESTAMP '2024-01-02 00:00:00' + to_days((page_id % 3 * 8)::INT) + to_minutes(page_id % 50) AS f FROM pages),
        l AS (SELECT event_id, 'https://news.example/' || user_id AS url, ts FROM events)
        SELECT event_id, s.url IS NOT NULL AS has_page, page_id, length(html) AS html_chars, {fmt_ts('f')} AS fetched
        FROM l ASOF LEFT JOIN s ON l.url = s.url AND l.ts >= s.f""",
    "retention": f"""SELECT {_SOURCE_KEY} AS source_key, CASE doc_id % 4 WHEN 2 THEN '2024-01-24' ELSE '2024-01-28' END AS dt, count(*) AS n,
        TRUE AS consistent FROM documents WHERE doc_id % 4 >= 2 GROUP BY ALL""",
    "outputs_of_day": f"""SELECT {_SOURCE_KEY} AS source_key, count(*) AS n_rows, TRUE AS has_files, TRUE AS has_bytes
        FROM documents WHERE doc_id % 4 = 2 GROUP BY ALL""",
    "history_widen": """SELECT event_id, CASE WHEN day(ts) <= 15 THEN value END AS value, CASE WHEN day(ts) > 15 THEN event_type END AS event_type,
        NULL::VARCHAR AS summary, strftime(ts, '%d') AS day FROM events""",
    "relative_bounds": f"""WITH b AS (SELECT event_id, ts, CASE event_id % 5 WHEN 0 THEN {_AS_OF} - to_days((event_id % 40)::INT)
            WHEN 1 THEN {_AS_OF} - to_hours(event_id % 700) WHEN 3 THEN {_AS_OF} + INTERVAL 90 MINUTE WHEN 4 THEN {_AS_OF} END AS lo FROM events)
        SELECT event_id, {fmt_ts('lo')} AS bound, ts BETWEEN lo AND {_AS_OF} AS inside FROM b""",
    "page_authors": f"""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Ana ' || {_SEG}
        WHEN c_custkey % 2 = 0 THEN 'Ana ' || {_SEG} || '|Luis ' || {_SEG} ELSE 'Luis ' || {_SEG} END AS authors FROM customer""",
    "author_sources": f"""WITH c AS (SELECT c_custkey, 'Ana ' || {_SEG} AS n, {_SEG} AS seg FROM customer)
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN n WHEN c_custkey % 3 = 0 THEN 'Luis ' || seg
               WHEN c_custkey % 5 = 0 THEN 'Eva Ruiz Gil' ELSE 'Redacción' END AS authors, n AS byline,
               CASE WHEN c_custkey % 2 = 0 THEN n || '|' || n ELSE n END AS listed, 'Redacción Vozpópuli' AS nobody, n AS mail FROM c""",
    "clean_records": f"""SELECT doc_id, trim('A ' || lang) AS title, coalesce({clean_ws('text')}, '') AS text, '' AS summary,
        CASE WHEN doc_id % 2 = 0 THEN 'Ana Gil' ELSE 'Redacción' END AS authors,
        CASE WHEN doc_id % 5 = 0 THEN '2024-01-02T03:04:05+00:00' ELSE {_AS_OF_ISO} END AS publish_date FROM documents""",
    "registry_lookup": """WITH d AS (SELECT source, min(doc_id) AS k FROM documents GROUP BY 1)
        SELECT source AS site, 'rss' AS kind, 0::BIGINT AS feed_ord, 'https://x/' || source AS url FROM d WHERE k % 3 <> 0 AND k % 2 = 0
        UNION ALL SELECT source, 'sitemap', i, CASE i WHEN 0 THEN 'https://s/' || source ELSE 'https://s/2' END
        FROM d, (VALUES (0::BIGINT), (1::BIGINT)) AS v(i) WHERE NOT (k % 3 <> 0 AND k % 2 = 0)
        UNION ALL SELECT 'site', source, (k % 2 = 0)::BIGINT, 'https://x' FROM d WHERE lower(source) = 'src1'""",
    "stored_pages": "SELECT page_id, url, html FROM pages",
    "hourly_runs": f"""WITH e AS (SELECT *, {_parts('ts')}, 'https://news.example/' || event_type || '/' || event_id || '.html' AS u,
            'https://news.example/mapa/' || event_id || '.html' AS m FROM events),
        w AS (SELECT * FROM e WHERE TRY_CAST(year || month || day || hour AS INTEGER) BETWEEN {_LO} AND {_HI}),
        pages AS (SELECT u AS og_url, event_type AS category, {_job_page('u')} AS html, hour FROM w WHERE event_id % 11 <> 0
                  UNION ALL SELECT m, 'mapa', {_job_page('m')}, hour FROM w)
        SELECT og_url, category, '2024-01-28 13:02:00' AS audit_time, hour, 'published' AS dataset FROM pages
        UNION ALL SELECT og_url, NULL, length(html)::VARCHAR, hour, 'html' FROM pages
        UNION ALL SELECT u, NULL, '2', hour, 'errors' FROM w WHERE event_id % 11 = 0""",
}
