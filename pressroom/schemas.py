"""Explicit schemas for every source and record (no inference on XML/CSV reads)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# 9-column export record (all strings), in output order.
EXPORT_COLUMNS = ["title", "url", "publish_date", "authors", "source", "domain",
                  "summary", "section", "subsection"]
ARTICLE_EXPORT = T.StructType([T.StructField(c, S) for c in EXPORT_COLUMNS])

# Wide article record.
ARTICLE = T.StructType([
    T.StructField("title", S), T.StructField("text", S), T.StructField("publish_date", S),
    T.StructField("authors", T.ArrayType(S)), T.StructField("url", S), T.StructField("source", S),
    T.StructField("domain", S), T.StructField("html", S), T.StructField("images", T.ArrayType(S)),
    T.StructField("keywords", T.ArrayType(S)), T.StructField("summary", S),
    T.StructField("section", S), T.StructField("subsection", S),
])

# RSS <item> (file scan, rowTag=item).
RSS_ITEM = T.StructType([
    T.StructField("title", S), T.StructField("link", S), T.StructField("pubDate", S),
    T.StructField("description", S), T.StructField("author", S),
    T.StructField("category", T.ArrayType(S)), T.StructField("guid", S),
])

# Sitemap <url> (file scan, rowTag=url); namespaced fields keep their prefix.
NEWS = T.StructType([
    T.StructField("news:publication", T.StructType([
        T.StructField("news:name", S), T.StructField("news:language", S)])),
    T.StructField("news:publication_date", S),
    T.StructField("news:title", S),
])
SITEMAP_URL = T.StructType([
    T.StructField("loc", S), T.StructField("lastmod", S), T.StructField("news:news", NEWS),
])

# Documents held in a column (feeds, sitemaps, indexes, robots.txt).
DOCUMENTS_RAW = T.StructType([
    T.StructField("site", S), T.StructField("kind", S), T.StructField("url", S),
    T.StructField("feed_ord", T.IntegerType()), T.StructField("fetched_at", T.TimestampType()),
    T.StructField("content", S),
])

SITEMAP_OPTIONS = T.StructType([
    T.StructField("news_sitemap", T.BooleanType()), T.StructField("ignore_gz", T.BooleanType()),
    T.StructField("timeout", T.IntegerType()), T.StructField("follow_sitemap_links", T.BooleanType()),
])

SITE = T.StructType([
    T.StructField("name", S), T.StructField("url", S), T.StructField("is_own_site", T.BooleanType()),
    T.StructField("use_rss", T.BooleanType()), T.StructField("rss_feeds", T.ArrayType(S)),
    T.StructField("sitemap", T.ArrayType(S)), T.StructField("sitemaps", T.ArrayType(S)),
    T.StructField("max_articles", T.IntegerType()), T.StructField("max_articles_per_feed", T.IntegerType()),
    T.StructField("headers", T.MapType(S, S)), T.StructField("sitemap_options", SITEMAP_OPTIONS),
    T.StructField("recency_rule", S), T.StructField("section_rule", S),
    T.StructField("author_rule", S), T.StructField("overlay_mode", S),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", S), T.StructField("html", S),
])
