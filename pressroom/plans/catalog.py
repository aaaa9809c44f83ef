"""Driver query catalog: every registered query reads the given tables whole.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB statement for the oracle check lives in ``oracle.py`` under the same
name.  Parameters (as_of, caps, day counts) are fixed per query and are the
same on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import html as H
from ..functions import text as X
from ..functions import urls as U
from ..operators import dedupe, enrich, limits, recency, records

# Fixed run parameters of the catalog queries (the test data ends 2024-01-30).
AS_OF = "2024-01-28 13:45:00"
DAYS = 3
DOMAIN_CAP = 10
SOURCE_CAP = 10
QUOTA = 15
TOP_UP = 12
LANG_ORDER = ["es", "en", "fr", "de"]
HOUR_AS_OF = "2024-01-28 13:00:00"
HOUR_DELAY = 30
MERGE_SPLIT = "2024-01-20 00:00:00"
MERGE_NEW_FROM = "2024-01-15 00:00:00"
MERGE_AUDIT_OLD = "2024-01-20 00:00:00"
MERGE_AUDIT_NEW = "2024-01-31 00:00:00"
MERGE_DELAY = 120
META_PATHS = ["k", "k.x", "missing.path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    from ..session import ensure_semantics
    ensure_semantics(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(c):
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------------ pages
def site_digest(spark, sf_dir):
    """Flagship: pages -> canonical URL -> sections -> title -> export record
    -> first seen per canonical URL -> first DOMAIN_CAP per domain."""
    pages = table(spark, sf_dir, "pages")
    sec = U.sections_base(F.col("url"))
    recs = pages.select(
        "page_id",
        U.canonical_url("url").alias("url"),
        U.domain("url").alias("domain"),
        X.clean_text(H.page_title("html")).alias("title"),
        sec["section"].alias("section"), sec["subsection"].alias("subsection"),
    )
    recs = recs.withColumns({
        "publish_date": F.lit(AS_OF), "authors": F.lit("Redacción"),
        "source": F.col("domain"), "summary": F.lit(""),
    })
    firsts = dedupe.first_seen(recs, "url", ["page_id"])
    capped = limits.cap_per(firsts, "domain", DOMAIN_CAP, ["page_id"], rank_col="rank")
    return records.to_export(capped, keep=["page_id", "rank"])


def canonical_first_seen(spark, sf_dir):
    """STR5 + AGG2: first page per canonical URL and the number of versions, in one aggregation."""
    pages = table(spark, sf_dir, "pages").select("page_id", U.canonical_url("url").alias("canonical_url"))
    return pages.groupBy("canonical_url").agg(F.min_by("page_id", "page_id").alias("page_id"),
                                              F.count(F.lit(1)).alias("n_versions"))


def url_sections_base(spark, sf_dir):
    s = U.sections_base(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", s["section"].alias("section"),
                                                s["subsection"].alias("subsection"))


def url_sections_nodate(spark, sf_dir):
    s = U.sections_nodate(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", s["section"].alias("section"),
                                                s["subsection"].alias("subsection"))


def url_sections_first(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.section_first("url").alias("section"))


def url_sections_mapped(spark, sf_dir):
    s = U.sections_mapped(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", s["section"].alias("section"),
                                                s["subsection"].alias("subsection"))


def record_from_url(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = records.record_from_url(pages, AS_OF, url="url", source=F.lit("pages"))
    return out.select("page_id", "title", "publish_date", "authors", "source", "domain", "summary",
                      "section", "subsection")


def page_titles(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", X.clean_text(H.tag_text(H.first_tag_inner("html", "h1"))).alias("title"))


def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    ex = pages.select("page_id", "url", F.posexplode(H.links("html")).alias("pos", "href"))
    return ex.select("page_id", "pos", "href", U.absolute_url("url", "href").alias("absolute_url"),
                     U.is_article_link("href").alias("is_article"),
                     U.is_article_link("href", "/", ".html").alias("is_html"))


def page_paragraphs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    ps = H.article_paragraphs("html")
    return pages.select("page_id", F.size(F.filter(ps, lambda p: F.length(p) > 30)).cast("bigint").alias("n_paragraphs"),
                        H.main_text("html").alias("text"))


def page_flag(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", H.paywall_flag("html").alias("access"))


# ------------------------------------------------------------------ documents: text
def clean_text_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.clean_text("text").alias("clean"),
                       X.csv_flat("text").alias("flat"))


def normalize_text_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.normalize_text("text").alias("normalized"))


# ------------------------------------------------------------------ events: recency + report
def _recent_report(spark, sf_dir, rule):
    ev = table(spark, sf_dir, "events")
    ok = recency.is_recent(D.to_instant("ts"), AS_OF, DAYS, rule)
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_found"),
        F.count_if(ok).alias("n_recent"),
        F.count_if(~ok).alias("n_skipped"),
    )


def recent_midnight(spark, sf_dir):
    return _recent_report(spark, sf_dir, "midnight")


def recent_age(spark, sf_dir):
    return _recent_report(spark, sf_dir, "age")


def recent_calendar(spark, sf_dir):
    return _recent_report(spark, sf_dir, "calendar")


def recent_days_floor(spark, sf_dir):
    return _recent_report(spark, sf_dir, "days_floor")


def recent_age_or_now(spark, sf_dir):
    return _recent_report(spark, sf_dir, "age_or_now")


def recent_today(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.filter(recency.is_today(D.to_instant("ts"), AS_OF)).select("event_id", "event_type")


def hour_window(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ev = ev.filter(recency.instant_bounds("ts", HOUR_AS_OF, HOUR_DELAY))     # pushed to the scan
    ev = records.hour_columns(ev.select("event_id", D.to_instant("ts").alias("t")), "t", "Europe/Rome")
    return recency.hour_window(ev, HOUR_AS_OF, HOUR_DELAY).select("event_id", "year", "month", "day", "hour")


def weekday_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    w = records.weekday_columns(D.to_instant("o_orderdate"))
    return o.select("o_orderkey", w["day_of_week"].alias("day_of_week"), w["is_weekend"].alias("is_weekend"),
                    records.weekday_in_italian(w["day_of_week"]).alias("day_of_week_it"))


def latest_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts", "value")
    latest = dedupe.latest_by(ev, "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", _ts_text("ts").alias("ts"), "value")


def _published_batch(ev: DataFrame, audit: str) -> DataFrame:
    t = D.to_instant("ts")
    return ev.select(
        F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                 F.col("user_id").cast("string")).alias("og_url"),
        F.date_trunc("hour", t).alias("modified_time_tz"),
        F.lit(audit).alias("audit_time"),
        "event_id", "value",
    )


def merge_published(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    old = _published_batch(ev.filter(F.col("ts") < F.lit(MERGE_SPLIT).cast("timestamp_ntz")), MERGE_AUDIT_OLD)
    new = _published_batch(ev.filter(F.col("ts") >= F.lit(MERGE_NEW_FROM).cast("timestamp_ntz")), MERGE_AUDIT_NEW)
    old = records.hour_columns(old, "modified_time_tz", "Europe/Rome")
    old = recency.hour_window(old, MERGE_SPLIT, MERGE_DELAY).drop("year", "month", "day", "hour")
    merged = dedupe.merge_latest(new, old, ["modified_time_tz", "og_url"], ["audit_time", "event_id"])
    return merged.select("og_url", _ts_text("modified_time_tz").alias("modified_time"), "audit_time",
                         "event_id", "value")


def merge_curated(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    t = D.to_instant("ts")

    def curated(df):
        df = df.select(F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                                F.col("user_id").cast("string")).alias("link"), t.alias("t"))
        return records.hour_columns(df, "t", "Europe/Rome").drop("t")
    old = curated(ev.filter(F.col("ts") < F.lit(MERGE_SPLIT).cast("timestamp_ntz")))
    new = curated(ev.filter(F.col("ts") >= F.lit(MERGE_NEW_FROM).cast("timestamp_ntz")))
    old = recency.hour_window(old, MERGE_SPLIT, MERGE_DELAY)
    return dedupe.merge_distinct(new, old)


# ------------------------------------------------------------------ documents: caps, joins
def cap_per_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return limits.cap_per(docs, "source", SOURCE_CAP, ["doc_id"], rank_col="rank")


def _lang_ord():
    m = F.create_map(*[x for i, lang in enumerate(LANG_ORDER) for x in (F.lit(lang), F.lit(i))])
    return F.coalesce(F.element_at(m, F.col("lang")), F.lit(len(LANG_ORDER)))


def quota(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    docs = docs.withColumn("feed_ord", _lang_ord())
    out = limits.cap_sequential(docs, "source", QUOTA, "feed_ord", "doc_id",
                                valid=F.col("n_chars") >= 200, rank_col="rank")
    return out.select("doc_id", "source", "lang", "rank")


def top_up(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    primary = docs.join(good, "doc_id", "left_semi")
    out = enrich.top_up(primary, docs, "doc_id", "source", TOP_UP, ["doc_id"])
    return out.select("doc_id", "source")


def anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_anti")


def _overlay_sides(spark, sf_dir):
    left = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(-1).alias("quality"),
                                                    F.lit(-1).alias("toxic"))
    right = table(spark, sf_dir, "labels").select("doc_id", "quality",
                                                  F.nullif(F.col("toxic"), F.lit(0)).alias("toxic"))
    return left, right


def overlay_all(spark, sf_dir):
    left, right = _overlay_sides(spark, sf_dir)
    return enrich.overlay(left, right, "doc_id", ["quality", "toxic"], mode="all")


def overlay_nonnull(spark, sf_dir):
    left, right = _overlay_sides(spark, sf_dir)
    return enrich.overlay(left, right, "doc_id", ["quality", "toxic"], mode="nonnull")


def fill_missing(spark, sf_dir):
    left = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.when(F.col("n_chars") < 500, F.lit("")).otherwise(F.col("lang")).alias("lang_hint"))
    right = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("lang_hint"))
    return enrich.fill_missing(left, right, "doc_id", ["lang_hint"])


def section_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return j.select("n_nationkey", "n_name", "r_name",
                    U.section_name(F.lower("r_name")).alias("region_display"),
                    U.section_name(F.lower("n_name")).alias("nation_display"))


def meta_paths(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    out = records.project_paths(ev, "props", META_PATHS)
    return records.rename_dotted(out.drop("props"))


def run_report(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", U.domain("url").alias("domain"))
    exported = limits.cap_per(pages, "domain", DOMAIN_CAP, ["page_id"])
    found = pages.groupBy("domain").agg(F.count(F.lit(1)).alias("n_found"))
    done = exported.groupBy("domain").agg(F.count(F.lit(1)).alias("n_exported"))
    rep = found.join(done, "domain", "left").fillna(0, ["n_exported"])
    return rep.withColumn("ok", F.col("n_exported") > 0)


QUERIES = {
    "site_digest": site_digest,
    "canonical_first_seen": canonical_first_seen,
    "url_sections_base": url_sections_base,
    "url_sections_nodate": url_sections_nodate,
    "url_sections_first": url_sections_first,
    "url_sections_mapped": url_sections_mapped,
    "record_from_url": record_from_url,
    "page_titles": page_titles,
    "page_links": page_links,
    "page_paragraphs": page_paragraphs,
    "page_flag": page_flag,
    "clean_text": clean_text_docs,
    "normalize_text": normalize_text_docs,
    "recent_midnight": recent_midnight,
    "recent_age": recent_age,
    "recent_calendar": recent_calendar,
    "recent_days_floor": recent_days_floor,
    "recent_age_or_now": recent_age_or_now,
    "recent_today": recent_today,
    "hour_window": hour_window,
    "weekday_parts": weekday_parts,
    "latest_per_key": latest_per_key,
    "merge_published": merge_published,
    "merge_curated": merge_curated,
    "cap_per_source": cap_per_source,
    "quota": quota,
    "top_up": top_up,
    "anti": anti,
    "overlay_all": overlay_all,
    "overlay_nonnull": overlay_nonnull,
    "fill_missing": fill_missing,
    "section_lookup": section_lookup,
    "meta_paths": meta_paths,
    "run_report": run_report,
}


# ------------------------------------------------------------------ authors
def _candidates(text):
    """Author-like strings of a text: every sentence of every line, initcapped, with its punctuation and its
    lower-case ' y ' between names."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\\. |\n"),
                       lambda p: F.replace(F.initcap(p), F.lit(" Y "), F.lit(" y ")))


def _authors(rule):
    def q(spark, sf_dir):
        """Author rule over the candidates of every document's whole text. A document's list is built,
        cleaned and made distinct inside its own row, so no shuffle is needed: the document's
        sentences bound it."""
        from ..functions.authors import clean_authors, or_default
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        a = clean_authors(_candidates(F.col("text")), rule=rule)
        if rule == "strip":
            a = or_default(a, "20minutos")
        rows = records.with_once(docs, "authors", a)
        return rows.select("doc_id", F.array_join("authors", "|").alias("authors"), F.size("authors").cast("bigint").alias("n_authors"))
    q.__name__ = f"authors_{rule}"
    return q


authors_strict = _authors("strict")
authors_strip = _authors("strip")
authors_cut = _authors("cut")
authors_okd = _authors("okd")
authors_strip50 = _authors("strip50")


# ------------------------------------------------------------------ XML and CSV round trips
RSS_CHUNK = 8
SITEMAP_CHUNK = 16


def rss_round_trip(spark, sf_dir):
    """events -> RSS documents of at most RSS_CHUNK items (consecutive event ids of one type)
    -> SRC3 parse (order kept) -> DAT1 RFC 822 parse."""
    from ..sources.feeds import parse_feed
    docs = _rss_docs(spark, sf_dir)
    items = parse_feed(docs, keep=["event_type", "chunk"])
    return items.select(F.col("guid").cast("bigint").alias("event_id"), "event_type",
                        F.col("item_ord").cast("bigint").alias("item_ord"), "title", "link",
                        _ts_text(D.parse_rfc822("published")).alias("published"))


def sitemap_round_trip(spark, sf_dir):
    """pages -> news sitemaps of at most SITEMAP_CHUNK URLs per domain -> SRC4 parse
    -> DAT2 ISO parse -> FLT6 recency (lastmod, else URL date)."""
    from ..sources.feeds import parse_sitemap
    pages = table(spark, sf_dir, "pages")
    lastmod = F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.col("page_id").cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.concat(
        F.lit("<url><loc>"), X.xml_escape(F.col("url")), F.lit("</loc><lastmod>"), lastmod,
        F.lit("</lastmod><news:news><news:title>"), X.xml_escape(X.clean_text(H.page_title("html"))),
        F.lit("</news:title></news:news></url>"))
    dom = U.domain("url")
    chunk = F.floor(F.col("page_id") / SITEMAP_CHUNK)
    docs = (pages.select(dom.alias("domain"), chunk.alias("chunk"), "page_id", entry.alias("e"))
            .groupBy("domain", "chunk")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "e"))),
                                          lambda s: s["e"]), "").alias("entries")))
    docs = docs.select("domain", "chunk", F.concat(
        F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
              'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">'),
        F.col("entries"), F.lit("</urlset>")).alias("content"))
    ent = parse_sitemap(docs, keep=["domain", "chunk"])
    return ent.select("domain", F.col("item_ord").cast("bigint").alias("item_ord"), "loc",
                      _ts_text(D.parse_iso_any("lastmod")).alias("lastmod"),
                      F.coalesce("news_title", F.lit("")).alias("news_title"),
                      recency.is_recent(F.col("lastmod"), AS_OF, DAYS, "lastmod_or_url", url=F.col("loc"))
                      .alias("recent"))


def _export_records(docs):
    """documents -> export records: whole texts with their line breaks, titles with quotes and the separator, some
    without authors or date."""
    k = F.col("doc_id")
    return docs.select(
        F.concat(F.lit('"Doc" ^ '), k.cast("string"), F.lit(", "), "lang").alias("title"),
        F.concat(F.lit("https://docs.example/"), F.col("source"), F.lit("/"), k.cast("string")).alias("url"),
        F.when(k % 2 == 0, F.lit(AS_OF)).alias("publish_date"),
        F.when(k % 3 != 0, F.array(F.col("source"), F.lit(""), F.concat(F.lit("Autor "), F.col("lang")))).alias("authors"),
        "source", F.lit("docs.example").alias("domain"), F.col("text").alias("summary"), F.col("text"),
        F.col("lang").alias("section"), F.lit("").alias("subsection"))


def _export_round_trip(dialect, columns=None):
    def q(spark, sf_dir):
        """SNK4, SNK5, SRC12: documents -> export records -> one '^' dialect per (source, day) -> read back."""
        from ..session import scratch_path
        from ..sinks.writers import DIALECTS, write_export
        from ..sources.tables import read_export
        out = scratch_path(spark, "export")
        recs = _export_records(table(spark, sf_dir, "documents"))
        write_export(recs.select(*columns, "source") if columns else recs, out, AS_OF, dialect=dialect)
        back = read_export(spark, out, dialect, [*columns, "source"] if columns else None)
        names = [*columns, "source"] if columns else DIALECTS[dialect]["columns"]
        return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names], "source_key", F.col("dt").cast("string").alias("dt"))
    q.__name__ = f"csv_{dialect}"
    return q


csv_round_trip = _export_round_trip("default")
csv_bom = _export_round_trip("bom")
csv_append = _export_round_trip("append")
csv_semicolon = _export_round_trip("semicolon")
csv_flat = _export_round_trip("flat", ["title", "url", "publish_date", "authors", "summary"])


# ------------------------------------------------------------------ streaming
STREAM_DELAY = "6 hours"


def _event_stream(spark, sf_dir):
    from ..streaming.streams import read_stream_files, with_event_time
    schema = table(spark, sf_dir, "events").schema
    s = read_stream_files(spark, sf_dir, schema, glob="events.parquet")
    return with_event_time(s, "ts")


# Where the month of events is cut into the files that land one after the other.
STREAM_CUTS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-23 00:00:00"]


def _quarter():
    """The file (0 to 3) of an event."""
    t = F.col("ts").cast("timestamp")
    return sum((F.when(t >= F.lit(c).cast("timestamp"), 1).otherwise(0) for c in STREAM_CUTS), F.lit(0))


def _land(df, folder, file):
    """One more file of a stream's folder, newer than those before it."""
    df.coalesce(1).write.mode("append").parquet(f"{folder}/file={file}")


def stream_dedupe(spark, sf_dir):
    """STM2: links per hour deduplicated over five files, one a micro-batch, with RocksDB state. A seventh of each
    file comes again in the next; a thirteenth of the first week comes only in the fourth file, too late, and is
    dropped. The stream stops after two files and goes on from its checkpoint."""
    from ..session import scratch_path
    from ..streaming.streams import read_stream_files, rocksdb_state, run_to_parquet, stream_hours
    ev = table(spark, sf_dir, "events").withColumn("q", _quarter())
    link = F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"))
    rows = ev.select(link.alias("link"), D.to_instant("ts").alias("event_time"), "event_id", "q")
    late = (F.col("q") == 0) & (F.col("event_id") % 13 == 0)
    out, chk, src = (scratch_path(spark, f"stream-dedupe{x}") for x in ("", "-chk", "-src"))
    schema = rows.drop("q", "event_id").schema
    with rocksdb_state(spark):
        for files in ([0, 1], [2, 3, 4]):
            for k in files:
                again = (F.col("q") == k - 1) & (F.col("event_id") % 7 == 0) & ~late
                wanted = ((F.col("q") == k) & ~late) | again | (late if k == 3 else F.lit(False))
                _land(rows.filter(wanted).drop("q", "event_id"), src, k)
            s = read_stream_files(spark, f"{src}/*", schema, max_files=1)
            run_to_parquet(stream_hours(s, ["link"], "event_time", STREAM_DELAY).select("link", "hour"), out, chk, "append")
    return spark.read.parquet(out).select("link", _ts_text("hour").alias("hour"))


def stream_hourly(spark, sf_dir):
    """STM4: events per hour and type, late rows accepted up to the delay (update mode)."""
    from ..session import scratch_path
    from ..streaming.streams import run_counts
    from ..streaming.streams import stream_hourly as hourly
    s = _event_stream(spark, sf_dir)
    out, chk = scratch_path(spark, "stream-hourly"), scratch_path(spark, "stream-hourly-chk")
    run_counts(hourly(s, "event_time", STREAM_DELAY, "event_type"), out, chk, "event_type")
    r = spark.read.parquet(out)
    return r.select(_ts_text("window_start").alias("window_start"), "event_type", "n")


QUERIES.update({
    "authors_strict": authors_strict,
    "authors_strip": authors_strip,
    "authors_cut": authors_cut,
    "authors_okd": authors_okd,
    "authors_strip50": authors_strip50,
    "rss_round_trip": rss_round_trip,
    "sitemap_round_trip": sitemap_round_trip,
    "csv_round_trip": csv_round_trip,
    "csv_bom": csv_bom,
    "csv_append": csv_append,
    "csv_semicolon": csv_semicolon,
    "csv_flat": csv_flat,
    "stream_dedupe": stream_dedupe,
    "stream_hourly": stream_hourly,
})


# ------------------------------------------------------------------ more operators over the tables
FIRST_USERS = 20


def _event_entries(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                 F.col("user_id").cast("string")).alias("url"),
        F.dayofmonth("ts").alias("feed_ord"), F.col("event_id").alias("item_ord"),
        F.concat(F.lit("ev "), F.col("event_id").cast("string")).alias("title"),
        _ts_text("ts").alias("publish_date"), F.col("event_type").alias("summary"), "value")


def feed_enrich(spark, sf_dir):
    """JON1: URL records (high-value events) enriched from the first matching feed entry."""
    e = _event_entries(spark, sf_dir)
    urls = e.filter(F.col("value") > 50).select("url").distinct().select(
        "url", U.title_from_slug("url").alias("title"), F.lit(AS_OF).alias("publish_date"),
        F.lit("").alias("summary"))
    return enrich.enrich_from_feed(urls, e.drop("value"))


def first_distinct_users(spark, sf_dir):
    """LIM6: per event type, the first FIRST_USERS distinct users in (ts, event_id) order."""
    ev = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id")
    out = limits.first_distinct(ev, "user_id", "event_type", FIRST_USERS, ["ts", "event_id"])
    return out.select("event_type", "user_id", "event_id")


def doc_snippets(spark, sf_dir):
    """PRJ5: summary (text[:200]+'...', cleaned, default) and html-style snippet of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("html"))
    out = records.snippets(docs, meta_description=None)
    return out.select("doc_id", "summary", F.col("html").alias("snippet"))


def iso_dates(spark, sf_dir):
    """DAT6: ISO re-format of every event time (Python isoformat of a UTC instant); DAT5: the
    strict '...Z' parse of each time written that way, and of an unparseable value (-> as_of)."""
    ev = table(spark, sf_dir, "events")
    zulu = F.date_format(D.to_instant("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return ev.select("event_id", D.iso_format(D.to_instant("ts")).alias("iso"),
                     D.iso_or_default(F.col("props"), AS_OF).alias("props_date"),
                     _ts_text(D.strict_z(zulu, AS_OF)).alias("strict_z"),                 # DAT5
                     _ts_text(D.strict_z(F.col("props"), AS_OF)).alias("strict_z_default"))


def distinct_sources(spark, sf_dir):
    """AGG3: the unordered set of sources."""
    return dedupe.distinct_values(table(spark, sf_dir, "documents"), "source")


QUERIES.update({
    "feed_enrich": feed_enrich,
    "first_distinct_users": first_distinct_users,
    "doc_snippets": doc_snippets,
    "iso_dates": iso_dates,
    "distinct_sources": distinct_sources,
})


def assembled_pages(spark, sf_dir):
    """PRJ18: one article record per page (title/date/text/summary/section precedence and defaults).
    Authors are left out here (the strict rule needs Unicode \\b, which the SQL oracle lacks);
    they are covered by fixtures."""
    pages = table(spark, sf_dir, "pages")
    out = records.assemble_article(pages, AS_OF, keep=["page_id"])
    return out.select("page_id", "title", "publish_date", "source", "domain", "summary", "section", "subsection",
                      F.length("text").cast("bigint").alias("text_chars"))


QUERIES["assembled_pages"] = assembled_pages


# ------------------------------------------------------------------ file sources, Atom
def _rss_docs(spark, sf_dir):
    """events -> RSS documents of at most RSS_CHUNK items (shared by the RSS queries)."""
    ev = table(spark, sf_dir, "events")
    t = D.to_instant("ts")
    item = F.concat(
        F.lit("<item><title>"), X.xml_escape(F.concat(F.col("event_type"), F.lit(" & user "),
                                                       F.col("user_id").cast("string"))),
        F.lit("</title><link>https://news.example/"), F.col("event_type"), F.lit("/"),
        F.col("event_id").cast("string"), F.lit(".html</link><pubDate>"),
        F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss Z"), F.lit("</pubDate><guid>"),
        F.col("event_id").cast("string"), F.lit("</guid></item>"))
    chunk = F.floor(F.col("event_id") / RSS_CHUNK)
    docs = (ev.select("event_type", chunk.alias("chunk"), "event_id", item.alias("item"))
            .groupBy("event_type", "chunk")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))),
                                          lambda s: s["item"]), "").alias("items")))
    return docs.select("event_type", "chunk", F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>'), F.col("event_type"),
        F.lit("</title>"), F.col("items"), F.lit("</channel></rss>")).alias("content"))


def rss_file_scan(spark, sf_dir):
    """SRC1: events written as RSS files with Spark's XML sink (each output file is one
    <channel> of <item>s) and scanned back with rowTag=item."""
    from ..session import scratch_path
    from ..sources.feeds import read_rss_items
    ev = table(spark, sf_dir, "events")
    items = ev.select(
        F.concat(F.col("event_type"), F.lit(" & user "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                 F.col("event_id").cast("string"), F.lit(".html")).alias("link"),
        F.date_format(D.to_instant("ts"), "EEE, dd MMM yyyy HH:mm:ss Z").alias("pubDate"),
        F.col("event_id").cast("string").alias("guid"))
    out = scratch_path(spark, "rss-files")
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(out)
    back = read_rss_items(spark, out)
    return back.select(F.col("guid").cast("bigint").alias("event_id"), "title", "link",
                       _ts_text(D.parse_rfc822("pubDate")).alias("published"))


_URLSET_ROOT = 'urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def sitemap_file_scan(spark, sf_dir):
    """SRC2: pages written as news sitemaps of at most SITEMAP_CHUNK URLs, half of them gzip-compressed, and
    scanned back: locations, dates, and the news:* title, date and language."""
    from ..session import scratch_path
    from ..sources.feeds import read_sitemap
    pages = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    lastmod = F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), k.cast("int")),
                            "yyyy-MM-dd'T'HH:mm:ss'Z'")
    news = F.when(k % 4 != 0, F.concat(
        F.lit("<news:news><news:publication><news:name>Diario</news:name><news:language>es</news:language></news:publication>"
              "<news:publication_date>"), F.substring(lastmod, 1, 10), F.lit("</news:publication_date><news:title>"),
        X.xml_escape(F.concat(F.lit("T & <b> "), "url")), F.lit("</news:title></news:news>"))).otherwise("")
    entry = F.concat(F.lit("<url>\n <loc> "), X.xml_escape(F.col("url")), F.lit(" </loc><lastmod>"), lastmod, F.lit("</lastmod>"),
                     news, F.lit("</url>"))
    docs = (pages.groupBy(F.floor(k / SITEMAP_CHUNK).alias("chunk"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", entry.alias("e")))), lambda s: s["e"]), "\n").alias("e"))
            .select("chunk", F.concat(
                F.lit('<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
                      'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">\n'), "e", F.lit("\n</urlset>")).alias("value")))
    out = scratch_path(spark, "sitemap-files")
    for half, packed in ((0, "none"), (1, "gzip")):
        docs.filter(F.col("chunk") % 2 == half).select("value").write.option("compression", packed).text(f"{out}/{packed}")
    sm = read_sitemap(spark, f"{out}/*")
    return sm.select("loc", _ts_text(D.parse_iso_any("lastmod")).alias("lastmod"), "news_title",
                     F.col("news_publication_date").alias("news_day"), "news_language")


ATOM_CHUNK = 8


def atom_round_trip(spark, sf_dir):
    """conversations -> Atom documents (at most ATOM_CHUNK entries, author e-mail only)
    -> SRC3 Atom path -> AUT8 name from e-mail -> DAT4 date precedence (published, updated)."""
    from ..sources.feeds import parse_feed
    cv = table(spark, sf_dir, "conversations")
    upd = F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp")
                        + F.make_dt_interval(F.lit(0), F.col("conv_id").cast("int"), F.col("turn").cast("int")),
                        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.concat(
        F.lit("<entry><title>"), X.xml_escape(F.concat(F.col("role"), F.lit(" turn "), F.col("turn").cast("string"))),
        F.lit('</title><link rel="alternate" href="https://chat.example/'), F.col("conv_id").cast("string"),
        F.lit("/"), F.col("turn").cast("string"), F.lit('"/><updated>'), upd,
        F.lit("</updated><author><email>"), F.col("role"), F.lit(".conv"), F.col("conv_id").cast("string"),
        F.lit("@chat.example</email></author><id>"), F.col("conv_id").cast("string"), F.lit(":"),
        F.col("turn").cast("string"), F.lit("</id></entry>"))
    chunk = F.floor(F.col("turn") / ATOM_CHUNK)
    docs = (cv.select("conv_id", chunk.alias("chunk"), "turn", entry.alias("e"))
            .groupBy("conv_id", "chunk")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "e"))),
                                          lambda s: s["e"]), "").alias("entries")))
    docs = docs.select("conv_id", "chunk", F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'),
                                                    "entries", F.lit("</feed>")).alias("content"))
    items = parse_feed(docs, keep=["conv_id", "chunk"])
    return items.select("conv_id", F.col("item_ord").cast("bigint").alias("item_ord"), "guid", "title", "link",
                        F.array_join("authors", "|").alias("authors"),
                        _ts_text(D.feed_date("published", "updated")).alias("published"))


QUERIES.update({
    "rss_file_scan": rss_file_scan,
    "sitemap_file_scan": sitemap_file_scan,
    "atom_round_trip": atom_round_trip,
})


# ------------------------------------------------------------------ indexes, robots, partitioned history
INDEX_FANOUT = 16
INDEX_CHILDREN = 5


def _child_url(dom, chunk):
    kind = F.when(dom.startswith("blog."), F.lit("google-news-")).otherwise(F.lit("sitemap-"))
    return F.concat(F.lit("https://"), dom, F.lit("/"), kind, chunk.cast("string"), F.lit(".xml"))


def sitemap_index_expand(spark, sf_dir):
    """SRC5 + LIM3 + LIM7: per domain, sitemap indexes of at most INDEX_FANOUT child sitemaps
    (each child: the domain's pages of one SITEMAP_CHUNK); children named 'google-news' go first
    (later ones ahead), the first INDEX_CHILDREN are joined to their documents and parsed."""
    from ..sources.feeds import expand_sitemap_index
    pages = table(spark, sf_dir, "pages")
    dom = U.domain("url")
    chunk = F.floor(F.col("page_id") / SITEMAP_CHUNK)
    entry = F.concat(F.lit("<url><loc>"), X.xml_escape(F.col("url")), F.lit("</loc></url>"))
    child_docs = (pages.select(dom.alias("domain"), chunk.alias("chunk"), "page_id", entry.alias("e"))
                  .groupBy("domain", "chunk")
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "e"))),
                                                lambda s: s["e"]), "").alias("entries"))
                  .select(_child_url(F.col("domain"), F.col("chunk")).alias("url"),
                          F.concat(F.lit(f"<{_URLSET_ROOT}>"), "entries", F.lit("</urlset>")).alias("content")))
    children = pages.select(dom.alias("domain"), chunk.alias("chunk")).distinct()
    ichunk = F.floor(F.col("chunk") / INDEX_FANOUT)
    index_docs = (children.select("domain", ichunk.alias("ichunk"), "chunk",
                                  F.concat(F.lit("<sitemap><loc>"), _child_url(F.col("domain"), F.col("chunk")),
                                           F.lit("</loc></sitemap>")).alias("s"))
                  .groupBy("domain", "ichunk")
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "s"))),
                                                lambda z: z["s"]), "").alias("items"))
                  .select(F.col("domain").alias("site"),
                          F.concat(F.lit("https://"), "domain", F.lit("/index-"), F.col("ichunk").cast("string"),
                                   F.lit(".xml")).alias("url"),
                          F.concat(F.lit('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                                   "items", F.lit("</sitemapindex>")).alias("content")))
    ex = expand_sitemap_index(index_docs, child_docs, max_children=INDEX_CHILDREN, keep=("site",),
                              priority_marker="google-news")
    return ex.select(F.col("site").alias("domain"), "index_url", F.col("child_ord").cast("bigint").alias("child_ord"),
                     "child_url", F.col("item_ord").cast("bigint").alias("item_ord"), "loc")


def robots_candidates(spark, sf_dir):
    """SRC6 + SRC7: robots.txt documents per domain chunk (directives in mixed case and
    indentation) -> Sitemap: entries -> candidates = common paths of every domain ∪ entries."""
    from ..sources.feeds import robots_sitemaps, sitemap_candidates
    pages = table(spark, sf_dir, "pages")
    dom = U.domain("url")
    chunk = F.floor(F.col("page_id") / SITEMAP_CHUNK)
    directive = F.when(dom.startswith("blog."), F.lit("  sitemap:  ")).otherwise(F.lit("Sitemap: "))
    line = F.concat(directive, F.lit("https://"), dom, F.lit("/sitemap-"), F.col("page_id").cast("string"), F.lit(".xml"))
    robots = (pages.select(dom.alias("site"), chunk.alias("chunk"), "page_id", line.alias("l"))
              .groupBy("site", "chunk")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "l"))),
                                            lambda s: s["l"]), "\n").alias("lines"))
              .select("site", "chunk", F.concat(F.lit("User-agent: *\nDisallow: /private\n"), "lines").alias("content")))
    entries = robots_sitemaps(robots, keep=["site", "chunk"])
    sites = pages.select(dom.alias("name")).distinct().select("name", F.concat(F.lit("https://"), "name", F.lit("/"))
                                                              .alias("url"))
    return sitemap_candidates(sites, entries.select("site", "sitemap_url"))


def hours_round_trip(spark, sf_dir):
    """SNK1 + SRC10 + FLT9: two overlapping batches written hour-partitioned with dynamic
    overwrite (the second replaces the hours it touches), then the run window read back."""
    from ..session import scratch_path
    from ..sinks.writers import write_hours
    from ..sources.tables import read_hours
    ev = table(spark, sf_dir, "events")

    def batch(df, name):
        df = df.select("event_id", F.lit(name).alias("batch"), D.to_instant("ts").alias("t"))
        return records.hour_columns(df, "t", "Europe/Rome").drop("t")
    base = scratch_path(spark, "hours")
    write_hours(batch(ev.filter(F.col("ts") < F.lit(MERGE_SPLIT).cast("timestamp_ntz")), "b1"), base)
    write_hours(batch(ev.filter(F.col("ts") >= F.lit(MERGE_NEW_FROM).cast("timestamp_ntz")), "b2"), base)
    schema = spark.createDataFrame([], "event_id bigint, batch string").schema
    return read_hours(spark, base, MERGE_SPLIT, MERGE_DELAY, schema)


def page_attach(spark, sf_dir):
    """JON4: canonical URLs with the page snapshot stored under that exact URL, if any."""
    pages = table(spark, sf_dir, "pages")
    urls = pages.select(U.canonical_url("url").alias("url")).distinct()
    j = enrich.attach_pages(urls, pages.select("url", "html"))
    return j.select("url", "has_page", F.length("html").cast("bigint").alias("html_chars"))


def url_sections_capitalized(spark, sf_dir):
    """URL5 with the HTM9 breadcrumb of the page as fallback."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", U.section_capitalized(F.col("url"), H.breadcrumb_second("html")).alias("section"))


def url_sections_breadcrumb(spark, sf_dir):
    """URL6: breadcrumb label first, then the first path piece, then 'General'."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", U.section_breadcrumb(F.col("url"), H.breadcrumb_second("html")).alias("section"))


def run_hours(spark, sf_dir):
    """DAT8: the hour list of the run window with the events of each hour (zero when none)."""
    hours = spark.range(1).select(F.explode(D.window_hours(AS_OF, HOUR_DELAY)).alias("h"))
    ev = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", D.to_instant("ts")).alias("h")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return hours.join(ev, "h", "left").select(_ts_text("h").alias("hour"), F.coalesce("n", F.lit(0)).alias("n"))


QUERIES.update({
    "sitemap_index_expand": sitemap_index_expand,
    "robots_candidates": robots_candidates,
    "hours_round_trip": hours_round_trip,
    "page_attach": page_attach,
    "url_sections_capitalized": url_sections_capitalized,
    "url_sections_breadcrumb": url_sections_breadcrumb,
    "run_hours": run_hours,
})


# ------------------------------------------------------------------ site flow and streaming upsert
def el_pais_feed_export(spark, sf_dir):
    """El País flow (LIM4, STR5, FLT10, DAT4, FLT5 + FLT2, AGG2, URL2/URL7, AUT4) over RSS
    documents built from the events (each document one feed)."""
    from .sites import el_pais_records
    docs = _rss_docs(spark, sf_dir).select(F.col("chunk").alias("feed_ord"), "content")
    return el_pais_records(docs, AS_OF, DAYS)


def stream_upsert(spark, sf_dir):
    """STM3: five files, one a micro-batch, through foreachBatch into the hour-partitioned latest-version merge
    (WIN3). A fifth of each file is corrected in the next (a later audit, another value). Then the first file
    is replayed from an empty checkpoint: the ledger knows the batch. The merged dataset is read back."""
    from ..session import scratch_path
    from ..streaming.streams import BatchLedger, read_stream_files, stream_published
    ev = table(spark, sf_dir, "events").withColumn("q", _quarter())
    rows = ev.select(
        F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string")).alias("og_url"),
        F.date_trunc("day", D.to_instant("ts")).alias("modified_time_tz"), F.lit(MERGE_AUDIT_OLD).alias("audit_time"),
        "event_id", "value", "q")
    rows = records.hour_columns(rows, "modified_time_tz", "Europe/Rome")
    corrected = rows.filter("event_id % 5 = 0").withColumns(
        {"q": F.col("q") + 1, "audit_time": F.lit(MERGE_AUDIT_NEW), "value": F.col("value") + 1})
    both = rows.unionByName(corrected)
    base, src, ledger = (scratch_path(spark, f"stream-upsert{x}") for x in ("", "-src", "-ledger"))
    schema = rows.drop("q").schema
    for k in range(5):                                       # the fifth has corrections only
        _land(both.filter(F.col("q") == k).drop("q"), src, k)
    merged = BatchLedger(spark, ledger, "events")
    stream_published(read_stream_files(spark, f"{src}/*", schema, max_files=1), base, scratch_path(spark, "stream-upsert-chk"), merged)
    stream_published(read_stream_files(spark, f"{src}/file=0", schema, max_files=1), base, scratch_path(spark, "stream-upsert-chk"), merged)
    out = spark.read.parquet(base)
    return out.select("og_url", _ts_text("modified_time_tz").alias("modified_time"), "event_id", "value")


QUERIES.update({"el_pais_feed_export": el_pais_feed_export, "stream_upsert": stream_upsert})


def select_sources(spark, sf_dir):
    """JON7: configured sources (of the es/fr documents) selected by requested names (the
    upper-cased sources of the de documents), case-insensitively; requested names that match
    nothing are reported as unknown."""
    docs = table(spark, sf_dir, "documents")
    sites = docs.filter(F.col("lang").isin("es", "fr")).select(F.col("source").alias("name")).distinct()
    wanted = docs.filter(F.col("lang") == "de").select(F.upper("source").alias("name")).distinct()
    found, unknown = enrich.select_sites(sites, wanted)
    return found.select("name", F.lit("found").alias("status")).unionByName(
        unknown.select("name", F.lit("unknown").alias("status")))


QUERIES["select_sources"] = select_sources


def page_categories(spark, sf_dir):
    """PRJ13: category from the URL ('video' for the video host; piece 4 after 'pwa'), edition."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", records.category_from_url(F.col("url")).alias("category"),
                    records.edition(F.col("url")).alias("edition"))


def event_time_parts(spark, sf_dir):
    """PRJ8 + PRJ9: effective published/modified times (purchases get a modification an hour
    later) and the partition parts taken from the modified time, else the published one, in Rome."""
    ev = table(spark, sf_dir, "events")
    t = D.to_instant("ts")
    df = ev.select("event_id", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("article.published_time"),
                   F.when(F.col("event_type") == "purchase",
                          F.date_format(t + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                   .alias("og.modified_time"),
                   F.lit(None).cast("string").alias("og.published_time"),
                   F.lit(None).cast("string").alias("article.modified_time"))
    df = records.partition_from_times(records.effective_times(df), "Europe/Rome")
    return df.select("event_id", "year", "month", "day", "hour",
                     F.coalesce("modified_time_tz_rome_YM", "published_time_tz_rome_YM").alias("ym"))


QUERIES.update({"page_categories": page_categories, "event_time_parts": event_time_parts})
