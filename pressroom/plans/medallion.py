"""The hourly raw -> curated -> published job (STM1, WIN3, WIN4, SET1-SET4, PRJ6-PRJ13).

Inputs are documents that have already landed (feeds and sitemaps in a
``content`` column, pages as HTML); outputs are hour-partitioned Parquet
datasets.  Each step is one declarative plan; merges that read and then
overwrite the same dataset first stage their result under the shared
checkpoint folder (B3), so the overwrite never reads what it is replacing and
a lost executor only re-runs the staged stage.

UDF1: the reference's five row-at-a-time Python UDFs become plan operators here --
last-modified lookup = JON5 join, article download = JON4 page attach, dotted path =
PRJ6 projection of a parsed payload, category = PRJ13 expression, edition = a literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions.dates import parse_rfc822, parse_any
from ..operators import dedupe, enrich, recency, records
from ..session import path_exists, scratch_path
from ..sinks.writers import HOUR_PARTS, write_hours, write_latest_html, write_rejects
from ..sources.feeds import parse_feed, parse_sitemap
from ..sources.tables import read_touched_hours

TZ = "Europe/Rome"

# The page-metadata paths projected into the published dataset (PRJ6).
META_COLUMNS = ['description', 'keywords', 'news_keywords', 'tags', 'application-name',
                'image_thumb_src', 'thumb', 'viewport', 'format-detection', 'fb.app_id',
                'og.site_name', 'og.type', 'og.title', 'og.description', 'og.image',
                'og.url', 'article.publisher', 'article.published_time',
                'article.modified_time', 'article.content_tier', 'article.content_plan',
                'twitter.card', 'twitter.site', 'twitter.title', 'twitter.description',
                'twitter.image', 'twitter.url', 'gs.twitter.text', 'testo',
                'article.opening_media', 'msapplication-task', 'msapplication-tooltip',
                'msapplication-starturl', 'msapplication-window',
                'msapplication-TileColor', 'msapplication-TileImage', 'article.section',
                'robots', 'tbl.url', 'tbl.uid', 'og.published_time', 'og.modified_time',
                'og.section', 'ge.thumbnailurl', 'ge.fullframeurl', 'twitter.domain',
                'article.content_lab', 'html']


def _stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint dir and read it back."""
    spark = df.sparkSession
    p = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def _read_history(spark: SparkSession, base: str, new: DataFrame, drift: str = "refuse") -> DataFrame | None:
    """The history of the hours that ``new`` touches: those are the ones a dynamic overwrite replaces.

    PRJ16: the schemas in the files of these hours are compared with ``new``'s before anything is written
    (``read_touched_hours``)."""
    if not path_exists(spark, base):
        return None
    hours = [tuple(r) for r in new.select(*HOUR_PARTS).distinct().collect()]     # as many as hours are touched
    old = read_touched_hours(spark, base, hours, [c for c in new.columns if c not in HOUR_PARTS], drift)
    return None if old is None else old.select(*(F.col(f"`{c}`").cast(new.schema[c].dataType) for c in new.columns))


# ------------------------------------------------------------------ curated
def _near_window(t, as_of, delay: int):
    """A cheap superset of the run's hours on the instant itself, tested before the hour's texts are made."""
    return recency.instant_bounds(F.col(t).cast("timestamp_ntz"), as_of, delay)


def curated_feed_rows(feed_docs: DataFrame, as_of, delay: int) -> DataFrame:
    """Feed items of the run with hour partitions from pubDate (RFC 822, else a plain cast)."""
    items = parse_feed(feed_docs, keep=["site"])
    t = parse_rfc822(F.col("published"))
    items = records.with_once(items.select("site", "item_ord", "title", "link", "published", "summary"), "_t", t)
    items = records.hour_columns(items.filter(_near_window("_t", as_of, delay)), "_t", TZ).drop("_t")
    return items.filter(recency.in_hour_window(as_of, delay))


def curated_sitemap_rows(sitemap_docs: DataFrame, as_of, delay: int, pages: DataFrame | None = None) -> DataFrame:
    """Sitemap entries of the run.

    FLT13/SET1: entries with a lastmod, plus entries without one that were
    published before the end of the run hour, whose lastmod is looked up in the
    page metadata (JON5: article:modified_time when the page has article
    metadata, else og:modified_time); then lastmod = lastmod or publication date.
    """
    e = _stage(parse_sitemap(sitemap_docs, keep=["site"]), "sitemap-entries")     # read three times below
    has, missing = recency.split_null_lastmod(e, as_of, "lastmod", "news_publication_date")
    if pages is not None:
        wanted = enrich.pages_for(missing.select(F.col("loc").alias("url")), pages.select("url", "html"))
        m = wanted.select(F.col("url").alias("loc"), H.meta_map("html").alias("_m"))
        art = F.map_filter("_m", lambda k, v: k.startswith("article:"))
        resolved = enrich.resolve_lastmod(F.element_at("_m", F.lit("article:modified_time")),
                                          F.size(art) > 0, F.element_at("_m", F.lit("og:modified_time")))
        missing = missing.join(m, "loc", "left").withColumn("lastmod", resolved).drop("_m")
    rows = has.unionByName(missing)
    eff = F.coalesce(F.col("lastmod"), F.col("news_publication_date"))
    rows = records.with_once(rows.withColumn("lastmod", eff), "_t", parse_any(F.col("lastmod")))
    rows = records.hour_columns(rows.filter(_near_window("_t", as_of, delay)), "_t", TZ).drop("_t")
    return rows.filter(recency.in_hour_window(as_of, delay))


def merge_curated_into(new: DataFrame, base: str) -> DataFrame:
    """WIN4/SET2: new ∪ history of the touched hours, whole-row distinct, touched hours replaced."""
    spark = new.sparkSession
    new = _stage(new, "curated-new")      # its hours are read first, then its rows: the run is parsed once
    old = _read_history(spark, base, new)
    merged = _stage(dedupe.merge_distinct(new, old), "curated")
    write_hours(merged, base)
    return merged


# ------------------------------------------------------------------ published
def _link_schema(name: str) -> T.StructType:
    """Explicit, so that partition values stay the strings they were written as ("01", not 1)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (name, *HOUR_PARTS)])


def candidate_links(feed_base: str, sitemap_base: str, spark: SparkSession, as_of, delay: int) -> DataFrame:
    """SET3: distinct links of the window from the feed and sitemap datasets, with their hour."""
    parts = [F.col(p) for p in HOUR_PARTS]
    out = []
    if path_exists(spark, feed_base):
        f = spark.read.schema(_link_schema("link")).parquet(feed_base).filter(recency.in_hour_window(as_of, delay))
        out.append(f.select(F.col("link"), *parts).distinct())
    if path_exists(spark, sitemap_base):
        s = spark.read.schema(_link_schema("loc")).parquet(sitemap_base).filter(recency.in_hour_window(as_of, delay))
        out.append(s.select(F.col("loc").alias("link"), *parts).distinct())
    if not out:
        return spark.createDataFrame([], "link string, year string, month string, day string, hour string")
    u = out[0]
    for o in out[1:]:
        u = u.unionByName(o)
    return u.distinct()


def page_payload(links: DataFrame, pages: DataFrame, as_of=None) -> DataFrame:
    """JON4 + HTM2: attach the page; the payload is the page metadata map plus html and text.

    A link without a page gets an error payload (it goes to the rejects dataset).
    """
    j = enrich.attach_pages(links.withColumnRenamed("link", "url"), pages, as_of, url="url",
                            page_cols=("html",))
    # a page's own <meta name="html"/"testo"> must not collide with the payload keys
    m = F.map_filter(H.meta_map("html"), lambda k, v: ~k.isin("html", "testo"))
    data = F.when(F.col("has_page"), F.to_json(F.map_concat(
        m, F.create_map(F.lit("html"), F.col("html"), F.lit("testo"), H.main_text("html")))))
    err = F.to_json(F.struct(F.col("url").alias("error_url_report"),
                             F.lit("page not fetched").alias("error_execution_real_time")))
    return j.select(F.col("url").alias("link"), *HOUR_PARTS, F.coalesce(data, err).alias("data"))


def published_rows(payload: DataFrame, as_of, delay: int, run_ts) -> tuple[DataFrame, DataFrame]:
    """The published projection of good payloads: 48 metadata paths, filters, time parts.

    Returns (published rows without html, slim html rows for the latest-html dataset).
    """
    flat = F.from_json(F.col("data"), "map<string,string>")
    sel = [F.element_at(flat, F.lit(c.replace(".", ":").lower())).alias(c) for c in META_COLUMNS]
    df = payload.select(*HOUR_PARTS, *sel).dropDuplicates()
    df = df.filter(recency.has_identity_and_time())
    df = records.effective_times(df)
    df = df.drop("article.modified_time", "article.published_time", "og.published_time", "og.modified_time")
    df = df.withColumn("category", records.category_from_url(F.col("`og.url`")))
    df = df.drop(*HOUR_PARTS)
    df = records.partition_from_times(df, TZ)
    df = df.filter(recency.in_hour_window(as_of, delay))
    eff = F.coalesce("published_time_tz", "modified_time_tz")
    df = df.withColumns(records.weekday_columns(eff)).withColumn("edition", records.edition(F.col("`og.url`")))
    df = records.rename_dotted(df)
    html_rows = df.select(*HOUR_PARTS, "og_url", "html", "published_time_tz", "modified_time_tz")
    df = df.withColumn("isAccessibleForFree", H.paywall_flag("html")) \
        .withColumn("audit_time", records.audit_time(run_ts)).drop("html").dropDuplicates()
    return df, html_rows


def merge_published_into(new: DataFrame, base: str) -> DataFrame:
    """WIN3/SET4: history of the touched hours ∪ new, latest audit per (modified_time_tz, og_url),
    touched hours replaced.  Ties on audit time are broken by the row's own columns."""
    spark = new.sparkSession
    new = _stage(new, "published-new")
    old = _read_history(spark, base, new)
    both = new if old is None else old.unionByName(new)
    keys = ["modified_time_tz", "og_url"]
    merged = _stage(dedupe.latest_by(both, keys, dedupe.full_order(both, ["audit_time"], exclude=keys)), "published")
    write_hours(merged, base)
    return merged


def run_hour(spark: SparkSession, feed_docs: DataFrame | None, sitemap_docs: DataFrame | None,
             pages: DataFrame, out_base: str, as_of, delay: int, run_ts=None) -> dict[str, str]:
    """STM1: one hourly run end to end; returns the dataset locations written."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    run_ts = run_ts or as_of
    paths = {k: f"{out_base.rstrip('/')}/{k}" for k in
             ("feed_rss", "sitemap", "published", "published_html", "errors")}
    if feed_docs is not None:
        merge_curated_into(curated_feed_rows(feed_docs, as_of, delay), paths["feed_rss"])
    if sitemap_docs is not None:
        merge_curated_into(curated_sitemap_rows(sitemap_docs, as_of, delay, pages), paths["sitemap"])
    links = candidate_links(paths["feed_rss"], paths["sitemap"], spark, as_of, delay)
    payload = _stage(page_payload(links, pages, as_of), "payload")
    good, bad = recency.split_rejects(payload, "data")
    write_rejects(bad, paths["errors"])
    pub, html_rows = published_rows(good, as_of, delay, run_ts)
    write_latest_html(html_rows, paths["published_html"])
    merge_published_into(pub, paths["published"])
    return paths
