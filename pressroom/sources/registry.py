"""Site registry and feed plan (SRC8, SRC9, FLT15, JON7).

The registry is data: one JSON line per site with an explicit schema.  It is
bounded by the number of configured sites, which is what makes broadcasting it
to record-level joins safe.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.recency import missing_fields
from ..schemas import SITE

SITES_FILE = os.path.join(os.path.dirname(__file__), "sites.jsonl")


def load_sites(spark: SparkSession, path: str | None = None) -> DataFrame:
    """SRC8: the site registry (explicit schema, missing keys -> null)."""
    if path:
        df = spark.read.schema(SITE).json(path)
    else:
        # the package's own file: read where the package is, executors need not have it
        with open(SITES_FILE, encoding="utf-8") as f:
            lines = [(line.strip(),) for line in f if line.strip()]
        df = spark.createDataFrame(lines, "line string").select(F.from_json("line", SITE).alias("s")).select("s.*")
    return df.withColumns({
        "rss_feeds": F.coalesce("rss_feeds", F.array().cast("array<string>")),
        "sitemap": F.coalesce("sitemap", F.array().cast("array<string>")),
        "sitemaps": F.coalesce("sitemaps", F.array().cast("array<string>")),
        "use_rss": F.coalesce("use_rss", F.lit(False)),
    })


def site_by_name(sites: DataFrame, name: str) -> DataFrame:
    """SRC8: case-insensitive lookup."""
    return sites.filter(F.lower("name") == F.lit(name.lower()))


def feed_plan(sites: DataFrame) -> DataFrame:
    """SRC9/SET6: one row per (site, kind, url, feed_ord); a site's feeds stay in order via ``feed_ord``.

    RSS feeds when the site uses RSS and has feeds (configured RSS wins even if
    it later yields nothing); otherwise ``sitemap`` followed by ``sitemaps``.
    """
    rss = F.col("use_rss") & (F.size("rss_feeds") > 0)
    urls = F.when(rss, F.col("rss_feeds")).otherwise(F.concat("sitemap", "sitemaps"))
    kind = F.when(rss, F.lit("rss")).otherwise(F.lit("sitemap"))
    return sites.select(F.col("name").alias("site"), kind.alias("kind"),
                        F.posexplode(urls).alias("feed_ord", "url"))


def registry_check(sites: DataFrame) -> DataFrame:
    """FLT15: per site, the required fields that are missing (config check report)."""
    s = sites.withColumn("sitemap_any", F.when((F.size("sitemap") > 0) | (F.size("sitemaps") > 0), F.lit("x")))
    miss = missing_fields(("name", "url", "sitemap_any", "is_own_site"))
    out = s.select("name", F.transform(miss, lambda f: F.when(f == "sitemap_any", F.lit("sitemap")).otherwise(f))
                   .alias("missing"))
    return out.withColumn("complete", F.size("missing") == 0)
