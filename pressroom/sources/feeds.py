"""Feed, sitemap and robots.txt sources (SRC1-SRC7).

Two ways in:
* file scans with the built-in XML source (``rowTag``), for order-free use;
* documents held in a column (one fetched document per row), parsed with
  ``from_xml`` and ``posexplode`` so that every item keeps its ordinal -- the
  "first N" / "first match wins" rules depend on it.

Broken XML yields zero items (PERMISSIVE parse -> null struct), never a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.authors import name_from_email
from ..functions.text import strip_cdata
from ..schemas import RSS_ITEM, SITEMAP_URL

# One schema for RSS 2.0 / MRSS (channel.item), Atom (entry), sitemaps (url) and
# sitemap indexes (sitemap); the document's root element name is not part of it.
# Items lie in the channel (RSS 2.0) or beside it (RSS 1.0).
_ITEMS = """array<struct<title:string, link:string, pubDate:string, `dc:date`:string, date:string,
  description:string, summary:string, `content:encoded`:string, author:string, `dc:creator`:string,
  category: array<string>, guid:string>>"""
DOC_SCHEMA = f"""
channel struct<item: {_ITEMS}>, item {_ITEMS},
entry array<struct<title:string, link: array<struct<_href:string, _rel:string>>, published:string,
  updated:string, created:string, summary:string, content:string,
  author: array<struct<name:string, email:string>>, category: array<struct<_term:string>>, id:string>>,
url array<struct<loc:string, lastmod:string, `news:news`: struct<`news:publication`:
  struct<`news:name`:string, `news:language`:string>, `news:publication_date`:string, `news:title`:string>>>,
sitemap array<struct<loc:string, lastmod:string>>
"""


def _empty():
    return F.array().cast("array<string>")


def _parsed(docs: DataFrame, content: str, keep: Sequence[str]) -> tuple[DataFrame, Column]:
    """``keep`` and the parsed document, and that column. The document is a generator's row: as a plain expression it
    would be parsed anew at every mention, in the optimizer's filters too."""
    x = "_doc"
    while x in keep:
        x = f"_{x}"
    tree = F.from_xml(F.col(content), DOC_SCHEMA, {"mode": "PERMISSIVE"})
    return docs.select(*keep, F.explode(F.array(tree)).alias(x)), F.col(x)


# ---------------------------------------------------------------- SRC1 / SRC2
def read_rss_items(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: every ``<item>`` of the RSS files under ``path`` (explicit schema, no inference)."""
    return (spark.read.format("xml").option("rowTag", "item").schema(RSS_ITEM).load(path)
            .withColumn("source_file", F.input_file_name()))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: every ``<url>`` of the sitemap files under ``path`` with its ``news:*`` fields; ``.gz`` files are decoded
    by extension.

    The files are text whose records end at ``</url>``, so a plain file of any size is read in splits and no
    file is held whole; each record's entry is parsed by ``from_xml``. Adds ``news_title``,
    ``news_publication_date``, ``news_name``, ``news_language`` and ``source_file``. A broken entry has null fields.
    """
    records = spark.read.option("lineSep", "</url>").text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    inner = F.regexp_extract("value", "(?s)^.*<url(?:\\s[^>]*)?>(.*)$", 1)
    entry = F.from_xml(F.concat(F.lit("<url>"), inner, F.lit("</url>")), SITEMAP_URL, {"mode": "PERMISSIVE"})
    out = records.filter(F.col("value").rlike("<url[\\s>]")).select(F.explode(F.array(entry)).alias("u"), "source_file")
    news = F.col("u")["news:news"]
    return out.select(F.trim("u.loc").alias("loc"), F.trim("u.lastmod").alias("lastmod"), news.alias("news:news"),
                      news["news:title"].alias("news_title"), news["news:publication_date"].alias("news_publication_date"),
                      news["news:publication"]["news:name"].alias("news_name"),
                      news["news:publication"]["news:language"].alias("news_language"), "source_file")


# ---------------------------------------------------------------- SRC3
def parse_feed(docs: DataFrame, content: str = "content", keep: Sequence[str] | None = None) -> DataFrame:
    """SRC3: RSS / MRSS / Atom documents in a column -> one row per item, order kept.

    Output: ``keep`` columns, ``item_ord`` (0-based), ``kind`` ('rss'/'atom'), title, link,
    published, updated, created, dc_date, summary, authors (array), categories (array), guid.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c != content]
    docs, x = _parsed(docs, content, keep)
    rss_items = F.concat(F.coalesce(x["channel"]["item"], F.array()), F.coalesce(x["item"], F.array()))
    rss = F.transform(rss_items, lambda i: F.struct(
        F.lit("rss").alias("kind"),
        strip_cdata(i["title"]).alias("title"),
        F.trim(strip_cdata(i["link"])).alias("link"),
        i["pubDate"].alias("published"),
        F.lit(None).cast("string").alias("updated"),
        F.lit(None).cast("string").alias("created"),
        F.coalesce(i["dc:date"], i["date"]).alias("dc_date"),
        strip_cdata(F.coalesce(i["description"], i["summary"], i["content:encoded"])).alias("summary"),
        F.filter(F.array(i["author"], i["dc:creator"]), lambda a: a.isNotNull() & (F.trim(a) != "")).alias("authors"),
        F.coalesce(i["category"], _empty()).alias("categories"),
        i["guid"].alias("guid"),
    ))
    atom = F.transform(x["entry"], lambda e: F.struct(
        F.lit("atom").alias("kind"),
        e["title"].alias("title"),
        F.trim(F.coalesce(
            F.get(F.filter(e["link"], lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate")), 0)["_href"],
            F.get(e["link"], 0)["_href"])).alias("link"),
        e["published"].alias("published"),
        e["updated"].alias("updated"),
        e["created"].alias("created"),
        F.lit(None).cast("string").alias("dc_date"),
        F.coalesce(e["summary"], e["content"]).alias("summary"),
        F.filter(F.transform(e["author"], lambda a: F.coalesce(a["name"], name_from_email(a["email"]))),
                 lambda a: a.isNotNull() & (F.trim(a) != "")).alias("authors"),
        F.coalesce(F.transform(e["category"], lambda c: c["_term"]), _empty()).alias("categories"),
        e["id"].alias("guid"),
    ))
    items = F.concat(F.coalesce(rss, F.array()), F.coalesce(atom, F.array()))
    out = docs.select(*keep, F.posexplode(items).alias("item_ord", "it"))
    return out.select(*keep, "item_ord", "it.*")


# ---------------------------------------------------------------- SRC4
def parse_sitemap(docs: DataFrame, content: str = "content", keep: Sequence[str] | None = None) -> DataFrame:
    """SRC4: sitemap documents in a column -> one row per ``<url>``, order kept, with ``news:*`` fields."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != content]
    docs, x = _parsed(docs, content, keep)
    out = docs.select(*keep, F.posexplode(x["url"]).alias("item_ord", "u"))
    news = F.col("u")["news:news"]
    return out.select(
        *keep, "item_ord",
        F.trim(F.col("u")["loc"]).alias("loc"),
        F.trim(F.col("u")["lastmod"]).alias("lastmod"),
        news["news:publication_date"].alias("news_publication_date"),
        news["news:title"].alias("news_title"),
        news["news:publication"]["news:name"].alias("news_name"),
        news["news:publication"]["news:language"].alias("news_language"),
        news.isNotNull().alias("has_news"),
    )


def index_children(docs: DataFrame, content: str = "content", keep: Sequence[str] | None = None,
                   max_children: int | None = None, priority_marker: str | None = None) -> DataFrame:
    """SRC5/LIM3/LIM7: child sitemap locations of sitemap-index documents.

    With ``priority_marker`` (e.g. 'google-news') matching children go first, a later
    match ahead of an earlier one; then the first ``max_children`` are kept (none: all).
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c != content]
    docs, x = _parsed(docs, content, keep)
    locs = F.filter(F.transform(x["sitemap"], lambda s: F.trim(s["loc"])),
                    lambda u: u.isNotNull() & (u != ""))
    if priority_marker:
        # ranking happens inside the document's own array: no shuffle, no regrouping
        keyed = F.transform(locs, lambda u, i: F.struct(
            F.when(u.contains(priority_marker), 0).otherwise(1).alias("tier"),
            F.when(u.contains(priority_marker), -i).otherwise(i).alias("o"), u.alias("u")))
        locs = F.transform(F.array_sort(keyed), lambda z: z["u"])
    ch = docs.select(*keep, F.posexplode(locs if max_children is None else F.slice(locs, 1, max_children)).alias("child_ord", "child_url"))
    return ch


def expand_sitemap_index(index_docs: DataFrame, docs: DataFrame, max_children: int | None = None,
                         url: str = "url", content: str = "content", keep: Sequence[str] = ("site",),
                         priority_marker: str | None = None) -> DataFrame:
    """SRC5: index -> first children -> their documents (equi-join on URL) -> sitemap entries.

    ``item_ord`` of the result is (child_ord, entry position) flattened so order is kept across children.
    Nested indexes: call again on the joined documents (a fixed number of rounds).
    """
    ch = index_children(index_docs, content, list(keep) + [url], max_children, priority_marker)
    ch = ch.withColumnRenamed(url, "index_url")
    child_docs = docs.select(F.col(url).alias("child_url"), F.col(content))
    joined = ch.join(child_docs, on="child_url", how="inner")
    return parse_sitemap(joined, content, keep=[*keep, "index_url", "child_ord", "child_url"])


# ---------------------------------------------------------------- SRC6 / SRC7
def robots_sitemaps(docs: DataFrame, content: str = "content", keep: Sequence[str] | None = None) -> DataFrame:
    """SRC6: ``Sitemap:`` directives of robots.txt documents, in order (lines trimmed first)."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != content]
    lines = docs.select(*keep, F.posexplode(F.split(F.col(content), "\r?\n")).alias("line_ord", "line"))
    t = F.trim(F.col("line"))
    return (lines.filter(F.lower(t).startswith("sitemap:"))
            .select(*keep, "line_ord", F.trim(F.substring(t, 9, 1 << 30)).alias("sitemap_url")))


# Sitemap locations tried on every site.
COMMON_SITEMAP_PATHS = ["/robots.txt", "/sitemap.xml", "/sitemap_index.xml", "/sitemap-news.xml",
                        "/sitemaps/sitemap.xml", "/sitemap/sitemap.xml"]


def sitemap_candidates(sites: DataFrame, robots: DataFrame | None = None, site: str = "name",
                       url: str = "url") -> DataFrame:
    """SRC7/SET5: per site, the common paths under its base URL ∪ robots.txt entries, distinct."""
    base = F.regexp_replace(F.col(url), "/+$", "")
    common = sites.select(F.col(site).alias("site"),
                          F.explode(F.array(*[F.concat(base, F.lit(p)) for p in COMMON_SITEMAP_PATHS]))
                          .alias("sitemap_url"))
    if robots is not None:
        common = common.unionByName(robots.select("site", "sitemap_url"))
    return common.distinct()
