"""XML/robots sources, registry, partitioned sinks and CSV exports."""
import gzip
import os

from pyspark.sql import functions as F

from pressroom.sinks import writers as W
from pressroom.sources import feeds, registry, tables

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>
<item><title><![CDATA[Uno & dos]]></title><link> https://a.es/x/1.html </link><pubDate>Tue, 02 Jan 2024 10:00:00 +0100</pubDate>
<category>Deportes</category><dc:creator>Ana Pérez</dc:creator></item>
<item><title>Dos</title><link>https://a.es/y/2.html</link><pubDate>Wed, 3 Jan 2024 10:00:00 GMT</pubDate></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A1</title><link href="https://b.es/1" rel="alternate"/>
<updated>2024-01-02T10:00:00Z</updated><author><email>luis.gil@b.es</email></author></entry></feed>"""
SITEMAP = """<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">
<url><loc>https://c.es/a/2024/01/02/x.html</loc><lastmod>2024-01-02T10:00:00+01:00</lastmod>
<news:news><news:publication><news:name>C</news:name><news:language>es</news:language></news:publication>
<news:publication_date>2024-01-02T09:00:00Z</news:publication_date><news:title>T &amp; U</news:title></news:news></url>
<url><loc>https://c.es/b</loc></url></urlset>"""
INDEX = """<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>https://c.es/s1.xml</loc></sitemap>
<sitemap><loc>https://c.es/google-news-1.xml</loc></sitemap><sitemap><loc>https://c.es/s3.xml</loc></sitemap>
<sitemap><loc>https://c.es/google-news-2.xml</loc></sitemap></sitemapindex>"""


def test_parse_feed_rss_atom_broken(spark):
    docs = spark.createDataFrame([("a", 0, RSS), ("b", 1, ATOM), ("c", 2, "<rss><channel><item>"), ("d", 3, "")],
                                 "site string, feed_ord int, content string")
    rows = feeds.parse_feed(docs).orderBy("feed_ord", "item_ord").collect()
    assert [(r.site, r.item_ord, r.title, r.link) for r in rows] == [
        ("a", 0, "Uno & dos", "https://a.es/x/1.html"), ("a", 1, "Dos", "https://a.es/y/2.html"),
        ("b", 0, "A1", "https://b.es/1")]
    assert rows[0].authors == ["Ana Pérez"] and rows[0].categories == ["Deportes"]
    assert rows[2].authors == ["Luis Gil"] and rows[2].updated == "2024-01-02T10:00:00Z"


def test_parse_sitemap_and_index(spark):
    docs = spark.createDataFrame([("c", "https://c.es/s.xml", SITEMAP)], "site string, url string, content string")
    rows = feeds.parse_sitemap(docs, keep=["site"]).orderBy("item_ord").collect()
    assert rows[0].loc == "https://c.es/a/2024/01/02/x.html" and rows[0].news_title == "T & U"
    assert rows[0].news_language == "es" and rows[1].lastmod is None
    idx = spark.createDataFrame([("c", "https://c.es/index.xml", INDEX)], "site string, url string, content string")
    plain = [r.child_url for r in feeds.index_children(idx, max_children=2).orderBy("child_ord").collect()]
    assert plain == ["https://c.es/s1.xml", "https://c.es/google-news-1.xml"]
    prio = [r.child_url for r in feeds.index_children(idx, max_children=3, priority_marker="google-news")
            .orderBy("child_ord").collect()]
    assert prio == ["https://c.es/google-news-2.xml", "https://c.es/google-news-1.xml", "https://c.es/s1.xml"]
    children = spark.createDataFrame([("c", "https://c.es/google-news-2.xml", SITEMAP)], "site string, url string, content string")
    ex = feeds.expand_sitemap_index(idx, children, max_children=5, priority_marker="google-news").collect()
    assert len(ex) == 2 and ex[0].index_url == "https://c.es/index.xml"


def test_robots_and_candidates(spark):
    robots = spark.createDataFrame([("c", "User-agent: *\n  Sitemap: https://c.es/a.xml\r\nsitemap:https://c.es/b.xml\n")],
                                   "site string, content string")
    r = feeds.robots_sitemaps(robots).collect()
    assert [x.sitemap_url for x in r] == ["https://c.es/a.xml", "https://c.es/b.xml"]
    sites = spark.createDataFrame([("c", "https://c.es/")], "name string, url string")
    cands = {x.sitemap_url for x in feeds.sitemap_candidates(sites, r and feeds.robots_sitemaps(robots)).collect()}
    assert "https://c.es/sitemap.xml" in cands and "https://c.es/a.xml" in cands and len(cands) == 8


def test_file_sources(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "feed.xml"), "w") as f:
        f.write(RSS)
    with gzip.open(os.path.join(tmp_dir, "sm.xml.gz"), "wt") as f:
        f.write(SITEMAP)
    items = feeds.read_rss_items(spark, os.path.join(tmp_dir, "feed.xml")).collect()
    assert sorted(i.title for i in items) == ["Dos", "Uno & dos"]
    urls = feeds.read_sitemap(spark, os.path.join(tmp_dir, "sm.xml.gz")).collect()
    assert sorted(u.loc for u in urls) == ["https://c.es/a/2024/01/02/x.html", "https://c.es/b"]


def test_registry_plan(spark):
    sites = registry.load_sites(spark)
    assert sites.count() == 14
    plan = registry.feed_plan(sites)
    ep = plan.filter(F.col("site") == "El País").collect()
    assert len(ep) == 28 and {r.kind for r in ep} == {"rss"}
    mundo = plan.filter(F.col("site") == "El Mundo").collect()
    assert [r.kind for r in mundo] == ["sitemap"] * 3
    assert registry.site_by_name(sites, "el país").count() == 1
    chk = {r.name: r.complete for r in registry.registry_check(sites).collect()}
    assert chk["El Mundo"] and not chk["El Confidencial"]


def test_write_hours_dynamic_overwrite(spark, tmp_dir):
    base = os.path.join(tmp_dir, "h")
    a = spark.createDataFrame([("x", "2024", "01", "01", "00"), ("y", "2024", "01", "01", "01")],
                              "v string, year string, month string, day string, hour string")
    W.write_hours(a, base)
    b = spark.createDataFrame([("z", "2024", "01", "01", "01")], "v string, year string, month string, day string, hour string")
    W.write_hours(b, base)
    got = sorted((r.v, r.hour) for r in spark.read.parquet(base).collect())
    assert got == [("x", "00"), ("z", "01")]
    W.write_rejects(b, base + "_err")
    W.write_rejects(b, base + "_err")
    assert spark.read.parquet(base + "_err").count() == 2


def test_export_round_trip(spark, tmp_dir):
    base = os.path.join(tmp_dir, "exp")
    df = spark.createDataFrame([("a^b", "https://x/1", 'q"x', ["A", "", "B"], "El País", "  lead", None)],
                               "title string, url string, summary string, authors array<string>, source string, "
                               "domain string, section string")
    W.write_export(df, base, "2024-01-28 10:00:00")
    back = tables.read_export(spark, base).collect()
    assert len(back) == 1
    r = back[0]
    assert (r.title, r.summary, r.authors, r.domain) == ("a^b", 'q"x', "A, B", "  lead")
    assert r.source_key == "el_país" and str(r.dt) == "2024-01-28"
    W.write_export(df, base, "2024-01-28 12:00:00")      # same day: replaced, not appended
    assert tables.read_export(spark, base).count() == 1
    rep = W.outputs_on(spark, base, "2024-01-28").collect()
    assert rep[0].n_rows == 1
    old = W.partitions_to_drop(spark, base, "2024-02-10 00:00:00", 7).collect()
    assert len(old) == 1


def test_read_hours_missing_and_window(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("v", T.StringType())])
    assert tables.read_hours(spark, os.path.join(tmp_dir, "none"), "2024-01-01 05:00:00", 3, schema).count() == 0


def test_export_dialects(spark, tmp_dir):
    from pressroom.sinks.writers import export_frame, write_export
    df = spark.createDataFrame([('Un "título"\ncon^salto', "https://x/1", None, ["Ana", "Luis"], "El País", "<p>" + "h" * 1200,
                                 "texto  largo", "deportes")],
                               "title string, url string, publish_date string, authors array<string>, source string, "
                               "html string, text string, section string")
    flat = export_frame(df, "2024-01-28 10:00:00", "flat").first()
    assert flat.title == 'Un ""título"" con salto' and flat.authors == "Ana, Luis"
    assert flat.html.endswith("... [TRUNCATED]") and len(flat.html) == 1000 + len("... [TRUNCATED]")
    assert export_frame(df, "2024-01-28 10:00:00", "flat").columns[:6] == \
        ["title", "url", "publish_date", "authors", "text", "html"]
    semi = export_frame(df, "2024-01-28 10:00:00", "semicolon")
    assert semi.columns[:7] == ["title", "url", "publish_date", "authors", "section", "subsection", "text"]
    r = semi.first()
    assert (r.authors, r.text, r.subsection) == ("Ana; Luis", "texto largo", "")
    bom = export_frame(df.withColumn("authors", F.lit(None).cast("array<string>")), "2024-01-28 10:00:00", "bom").first()
    assert (bom.authors, bom.publish_date, bom.source_key) == ("Redacción", "2024-01-28T10:00:00+00:00", "el_país")
    for dialect in ("flat", "semicolon", "bom"):
        write_export(df, os.path.join(tmp_dir, dialect), "2024-01-28 10:00:00", dialect=dialect)
    raw = "".join(open(os.path.join(dp, f), encoding="utf-8").read()
                  for dp, _, fs in os.walk(os.path.join(tmp_dir, "flat")) for f in fs if f.endswith(".csv"))
    assert 'Un ""título"" con salto^https://x/1' in raw


def test_append_dialect_normalises(spark):
    from pressroom.sinks.writers import export_frame
    df = spark.createDataFrame([("Café\r\n  hoy\x07", ["  Ana\tPérez "], "S")], "title string, authors array<string>, source string")
    r = export_frame(df, "2024-01-28 10:00:00", "append").first()
    assert (r.title, r.authors) == ("Café hoy", "Ana Pérez")


def test_write_latest_html(spark, tmp_dir):
    import datetime as dt

    from pressroom.sinks.writers import write_latest_html
    rows = [("2024", "01", "28", "09", "u", "<old>", dt.datetime(2024, 1, 28, 8), dt.datetime(2024, 1, 28, 9)),
            ("2024", "01", "28", "10", "u", "<new>", dt.datetime(2024, 1, 28, 8), dt.datetime(2024, 1, 28, 10)),
            ("2024", "01", "28", "07", "v", "<only-published>", dt.datetime(2024, 1, 28, 7), None)]
    df = spark.createDataFrame(rows, "year string, month string, day string, hour string, og_url string, html string, "
                                     "published_time_tz timestamp, modified_time_tz timestamp")
    base = os.path.join(tmp_dir, "html")
    write_latest_html(df, base)
    got = {r.og_url: (r.html, r.hour) for r in spark.read.parquet(base).collect()}
    assert got == {"u": ("<new>", "10"), "v": ("<only-published>", "07")}
