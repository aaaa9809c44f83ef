"""Enrichment joins (JON1-JON9).

Join strategy: the right side is first reduced to one row per key, by an order that makes the
choice repeatable (so a join never multiplies rows), then joined with a plain equi-join. Spark
and AQE broadcast a side when its measured size is under the broadcast threshold; a hot key on
the big side is split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import first_seen, full_order, latest_by


def _one_per_key(right: DataFrame, key: str, order: Sequence | None) -> DataFrame:
    """The first row per key: by ``order``, then (or without one) by the row's own values."""
    return first_seen(right, key, full_order(right, list(order or ()), exclude=[key]))


def enrich_from_feed(urls: DataFrame, entries: DataFrame, key: str = "url",
                     order: Sequence = ("feed_ord", "item_ord"),
                     cols: Sequence[str] = ("title", "publish_date", "summary")) -> DataFrame:
    """JON1: fill title/date/summary from the first matching feed entry (right wins when matched)."""
    first = first_seen(entries.select(key, *order, *cols), key, list(order))
    r = first.select(F.col(key), *[F.col(c).alias(f"_r_{c}") for c in cols],
                     F.lit(True).alias("_r_hit"))
    j = urls.join(r, on=key, how="left")
    out = [F.when(F.col("_r_hit"), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in urls.columns]
    return j.select(*out)


def overlay(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str],
            mode: str = "nonnull", right_order: Sequence | None = None) -> DataFrame:
    """JON2: overlay right-side facts on left rows matched by ``key``.

    mode='all'     matched right values replace left ones, nulls included
    mode='nonnull' only non-null right values replace left ones
    """
    extra = [o for o in (right_order or ()) if o not in cols and o != key]
    right = _one_per_key(right.select(key, *cols, *extra), key, right_order)
    r = right.select(F.col(key), *[F.col(c).alias(f"_r_{c}") for c in cols], F.lit(True).alias("_r_hit"))
    j = left.join(r, on=key, how="left")

    def pick(c: str) -> Column:
        rc, lc = F.col(f"_r_{c}"), (F.col(c) if c in left.columns else F.lit(None))
        if mode == "all":
            return F.when(F.col("_r_hit"), rc).otherwise(lc).alias(c)
        if mode == "nonnull":
            return F.coalesce(rc, lc).alias(c)
        raise ValueError("mode must be 'all' or 'nonnull'")

    extra = [pick(c) for c in cols if c not in left.columns]
    return j.select(*[pick(c) if c in cols else F.col(c) for c in left.columns], *extra)


def fill_missing(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str],
                 list_sep: str = ", ", right_order: Sequence | None = None) -> DataFrame:
    """JON3: fill only empty (null or '') left fields from the right side; lists joined."""
    extra = [o for o in (right_order or ()) if o not in cols and o != key]
    right = _one_per_key(right.select(key, *cols, *extra), key, right_order)
    rsel = []
    for c in cols:
        dt = right.schema[c].dataType.simpleString()
        v = F.array_join(F.col(c), list_sep) if dt.startswith("array") else F.col(c).cast("string")
        rsel.append(v.alias(f"_r_{c}"))
    j = left.join(right.select(F.col(key), *rsel), on=key, how="left")
    out = []
    for c in left.columns:
        if c in cols:
            lc = F.col(c).cast("string")
            out.append(F.when(lc.isNull() | (lc == ""), F.col(f"_r_{c}")).otherwise(lc).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def pages_for(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """The pages whose URL is wanted: a ``left_semi`` join against the distinct wanted URLs. Where
    they are under the broadcast threshold the page table is filtered map-side and not shuffled
    (a left outer join cannot broadcast its left side, so joining directly would shuffle it)."""
    return pages.join(urls.select(url).distinct(), on=url, how="left_semi")


def attach_pages(urls: DataFrame, pages: DataFrame, as_of=None, url: str = "url",
                 fetched_at: str = "fetched_at", page_cols: Sequence[str] = ("html",)) -> DataFrame:
    """JON4: attach the newest page snapshot (fetched at or before as_of) to each URL.

    Adds ``has_page``; URLs without a page are kept (flagged) so callers can
    route them to rejects.  Pages are first reduced to the wanted URLs (``pages_for``).
    """
    from ..functions.dates import as_of_lit
    p = pages_for(urls, pages, url)
    # the snapshot is picked by time and content hash, and its markup is joined afterwards, so no
    # aggregation carries pages
    ids = p.withColumn("_snap", F.xxhash64(*page_cols))
    if fetched_at in pages.columns:
        if as_of is not None:
            ids = ids.filter(F.col(fetched_at) <= as_of_lit(as_of))
        best = ids.groupBy(url).agg(F.max(F.struct(F.col(fetched_at), F.col("_snap"))).alias("_b"))
        best = best.select(url, F.col(f"_b.{fetched_at}").alias(fetched_at), F.col("_b._snap").alias("_snap"))
        on = [url, fetched_at, "_snap"]
    else:
        best, on = ids.groupBy(url).agg(F.min("_snap").alias("_snap")), [url, "_snap"]
    # snapshots that agree in the key are equal rows: any of them
    p = ids.select(*on, *page_cols).join(best, on).drop("_snap").dropDuplicates([url])
    p = p.withColumn("has_page", F.lit(True))
    j = urls.join(p, on=url, how="left")
    return j.withColumn("has_page", F.coalesce(F.col("has_page"), F.lit(False)))


def attach_pages_as_of(links: DataFrame, pages: DataFrame, at: str, url: str = "url", fetched_at: str = "fetched_at",
                       page_cols: Sequence[str] = ("html",), bucket: str = "day") -> DataFrame:
    """JON4: to each link the newest page snapshot of its URL not after the link's own time ``at``.

    Links and snapshots of a URL are laid on one time line and each link takes the last snapshot
    before it: a window, no range join. A time line is cut in ``bucket``s (day, hour), so a URL with a
    third of all links is many windows; the snapshot with which a bucket opens comes from a window
    over the URL's buckets. Windows carry the snapshot's time and content hash, never its markup.

    Adds ``fetched_at``, ``page_cols`` (null without a snapshot) and ``has_page``. Of snapshots with equal time
    the one with the larger hash counts. A link without a URL or time keeps its row and has no page; no link is
    repeated. Columns of ``links`` must not be named like the added ones.
    """
    line = Window.partitionBy("_u", "_b")
    cut = (lambda t: F.date_trunc(bucket, t))
    content = F.xxhash64(*page_cols)
    snaps = (pages_for(links, pages, url).select(F.col(url).alias("_u"), F.col(fetched_at).alias("_t"), content.alias("_h"))
             .filter("_t is not null").groupBy("_u", "_t").agg(F.max("_h").alias("_h")))
    both = (links.select(F.col(url).alias("_u"), F.col(at).alias("_t"), F.lit(None).cast("struct<t:timestamp,h:bigint>").alias("_s"),
                         F.struct(*links.columns).alias("_link"))
            .unionByName(snaps.select("_u", "_t", F.struct(F.col("_t").cast("timestamp").alias("t"), F.col("_h").alias("h")).alias("_s")),
                         allowMissingColumns=True)
            .withColumn("_b", cut(F.col("_t"))))
    buckets = both.groupBy("_u", "_b").agg(F.max("_s").alias("_m"))
    opens = buckets.select("_u", "_b", F.last("_m", ignorenulls=True).over(
        Window.partitionBy("_u").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_open"))
    # at equal times the snapshot comes first
    so_far = line.orderBy("_t", F.col("_s").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (both.withColumn("_last", F.last("_s", ignorenulls=True).over(so_far)).filter("_link is not null")
             .join(opens.filter("_open is not null"), ["_u", "_b"], "left")
             .select("_link.*", F.coalesce("_last", "_open").alias("_s")))
    markup = pages.select(F.col(url).alias("_pu"), F.col(fetched_at).cast("timestamp").alias("_pt"), content.alias("_ph"), *page_cols) \
        .dropDuplicates(["_pu", "_pt", "_ph"])
    on = (F.col(f"`{url}`") == F.col("_pu")) & (F.col("_s.t") == F.col("_pt")) & (F.col("_s.h") == F.col("_ph"))
    return (found.join(markup, on, "left").withColumn(fetched_at, F.col("_s.t")).withColumn("has_page", F.col("_s").isNotNull())
            .select(*links.columns, fetched_at, *page_cols, "has_page"))


def resolve_lastmod(article_modified: Column, article_present: Column, og_modified: Column) -> Column:
    """JON5: article.modified_time when an article object exists, else og.modified_time."""
    return F.when(article_present, article_modified).otherwise(og_modified)


def top_up(primary: DataFrame, fallback: DataFrame, key: str, part: str, n: int | None,
           order: Sequence) -> DataFrame:
    """JON6: primary rows first, then fallback rows whose key is not in primary, up to n per part."""
    from .limits import cap_per
    extra = fallback.join(primary.select(key).distinct(), on=key, how="left_anti")
    both = (primary.withColumn("_tier", F.lit(0))
            .unionByName(extra.withColumn("_tier", F.lit(1))))
    return cap_per(both, part, n, ["_tier", *order]).drop("_tier")


def select_sites(sites: DataFrame, names: DataFrame, name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """JON7: (sites whose name was requested, requested names that match no site); case-insensitive."""
    s = sites.withColumn("_k", F.lower(F.col(name_col)))
    n = names.select(F.col(name_col).alias("_req")).withColumn("_k", F.lower(F.col("_req")))
    found = s.join(n, on="_k", how="left_semi").drop("_k")
    unknown = n.join(s.select("_k"), on="_k", how="left_anti").select(F.col("_req").alias(name_col))
    return found, unknown


def attach_site(df: DataFrame, sites: DataFrame, on: str = "site",
                cols: Sequence[str] = ("source", "domain", "max_articles")) -> DataFrame:
    """JON9: site attributes onto records (the registry's size lets the planner broadcast it)."""
    return df.join(sites.select(on, *[c for c in cols if c != on]), on=on, how="left")
