"""The edge cases FIXTURES.md §2 requires, one group per topic."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import one_col
from pressroom.functions import dates as D
from pressroom.functions import html as H
from pressroom.functions import text as X
from pressroom.functions import urls as U
from pressroom.operators import dedupe, limits, recency, records
from pressroom.sinks.writers import write_export
from pressroom.sources import feeds, tables

AS_OF = "2024-01-28 12:00:00"


def test_dates(spark):
    vals = ["Sun, 28 Jan 2024 13:00:00 +0100", "Sun, 28 Jan 2024 12:00:00 GMT", "28 Jan 2024 12:00:00 +0000",
            "2024-01-28T12:00:00Z", "2024-01-28T13:00:00+01:00", "2024-01-28T12:00:00", "2024-01-28",
            "2024-01-28T12:00:00.250Z", "ayer", None, "2030-01-01T00:00:00Z"]
    got = one_col(spark, vals, D.parse_any)
    noon = dt.datetime(2024, 1, 28, 12)
    assert got[:6] == [noon] * 6
    assert got[6] == dt.datetime(2024, 1, 28) and got[7] == dt.datetime(2024, 1, 28, 12, 0, 0, 250000)
    assert got[8] is None and got[9] is None and got[10] == dt.datetime(2030, 1, 1)
    # exactly on the cut-off is kept; the future is kept by age rules; unknown per rule
    df = spark.createDataFrame([(dt.datetime(2024, 1, 27, 12),), (dt.datetime(2030, 1, 1),), (None,)], "t timestamp")
    age = [r.k for r in df.select(recency.is_recent(F.col("t"), AS_OF, 1, "age").alias("k")).collect()]
    assert age == [True, True, False]
    # 23:30 UTC is the next day in Rome; 30 December stays in its calendar year (no week-year)
    p = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30),), (dt.datetime(2024, 12, 30, 10),)], "t timestamp")
    r = records.hour_columns(p, "t", "Europe/Rome", prefix="x_").collect()
    assert (r[0].x_day, r[0].x_hour) == ("02", "00") and r[1].x_YM == "202412"


def test_urls(spark):
    vals = ["https://a.es/x/y?q=1", "https://a.es/x/y#f", "https://a.es/x/y?q=1#f", "https://a.es/x/y/", "https://a.es",
            "https://a.es/2024/01/02/n.html", "https://a.es/Ñandú/con espacio", "HTTPS://A.ES/UPPER/Case",
            "https://a.es/2023-economia/ab/123456"]
    assert one_col(spark, vals[:4], U.canonical_url) == ["https://a.es/x/y"] * 3 + ["https://a.es/x/y/"]
    assert one_col(spark, vals, U.domain)[:8] == ["a.es"] * 7 + ["A.ES"]
    base = [(r.section, r.subsection) for r in one_col(spark, vals, U.sections_base)]
    assert base[4] == ("General", "") and base[5] == ("N.Html", "")
    assert base[6] == ("Ñandú", "Con Espacio") and base[7] == ("Upper", "Case")
    assert base[8] == ("2023 Economia", "")                          # 'ab' too short, digits dropped
    nodate = [(r.section, r.subsection) for r in one_col(spark, vals, U.sections_nodate)]
    assert nodate[5] == ("01", "02") and nodate[8] == ("Ab", "123456")      # only pieces starting "20" go
    assert one_col(spark, [vals[5], "https://a.es/x/2024/02/31/y"], D.url_date) == [dt.datetime(2024, 1, 2), None]


def test_ordering_caps(spark):
    entries = spark.createDataFrame([("u", 0, 0, "feed0"), ("u", 1, 0, "feed1"), ("v", 1, 1, "only")],
                                    "url string, feed_ord int, item_ord int, title string")
    first = {r.url: r.title for r in dedupe.first_seen(entries, "url", ["feed_ord", "item_ord"]).collect()}
    assert first == {"u": "feed0", "v": "only"}
    rows = [("s", f, i) for f in range(2) for i in range(4)]
    df = spark.createDataFrame(rows, "site string, feed_ord int, item_ord int")
    per_feed = limits.head_of_each(df, "item_ord", 3)                   # LIM4 before any filter
    capped = limits.cap_sequential(per_feed, "site", 5).collect()        # quota reached inside feed 1
    assert sorted((r.feed_ord, r.item_ord) for r in capped) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_xml_cases(spark):
    docs = spark.createDataFrame([
        (1, '<rss><channel><item><title>sin ns</title><link>https://a/1</link></item></channel></rss>'),
        (2, '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>&lt;b&gt; &amp; co</title>'
            '<link href="https://a/2"/></entry></feed>'),
        (3, '<rss><channel><item><title><![CDATA[<i>cd</i>]]></title></item></channel></rss>'),
        (4, '<rss><channel></channel></rss>'), (5, '<rss><channel><item>'), (6, None)],
        "d int, content string")
    got = {(r.d, r.title) for r in feeds.parse_feed(docs).collect()}
    assert got == {(1, "sin ns"), (2, "<b> & co"), (3, "<i>cd</i>")}


def test_text_cases(spark):
    nfd = "Café"
    vals = [nfd, "a\x00b\x1fc", "a b", "l1\r\nl2\rl3", None]
    assert one_col(spark, vals, X.normalize_text) == ["Café", "abc", "a b", "l1 l2 l3", ""]
    assert one_col(spark, [nfd], X.nfc) == ["Café"]


def test_export_special_characters(spark, tmp_dir):
    base = os.path.join(tmp_dir, "e")
    df = spark.createDataFrame([('a^b "q" c\\d', "https://x/1", "S")], "title string, url string, source string")
    for dialect in ("default", "append"):
        write_export(df, base + dialect, AS_OF, dialect=dialect)
    assert tables.read_export(spark, base + "default").first().title == 'a^b "q" c\\d'
    raw = "".join(open(os.path.join(dp, f), encoding="utf-8").read()
                  for dp, _, fs in os.walk(base + "append") for f in fs if f.endswith(".csv"))
    assert '\\"q\\"' in raw                                              # backslash-escaped quotes


def test_html_cases(spark):
    pages = [
        '<h1 itemprop="headline">Second selector</h1><h1>plain</h1>',
        '<script type="application/ld+json">{"author": {"name": "Obj Author"}}</script>',
        '<script type="application/ld+json">{"author": "Str Author"}</script>',
        '<meta name="author" content="Meta Only">',
        '<div><b>malformed<p>no article',
        '<article><nav><p>Paragraph inside navigation that is long</p></nav>'
        '<p>' + "x" * 30 + '</p><p>' + "y" * 31 + '</p></article>',
    ]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    r = df.select("i", H.page_title("html").alias("t"), H.jsonld_authors("html").alias("a"),
                  H.meta_authors("html").alias("m"), H.main_text("html").alias("x")).orderBy("i").collect()
    assert r[0].t == "Second selector" and r[1].a == ["Obj Author"] and r[2].a == ["Str Author"]
    assert r[3].m == ["Meta Only"] and r[4].t is None and r[4].x == ""
    assert r[5].x == "y" * 31                      # the paragraph inside nav and the short one are left out


def test_merge_cases(spark):
    m = dt.datetime(2024, 1, 28, 9)
    old = spark.createDataFrame([("u", m, "a1", "old"), ("w", None, "a1", "nullmod"), ("t", m, "a1", "tie-b")],
                                "og_url string, modified_time_tz timestamp, audit_time string, v string")
    new = spark.createDataFrame([("u", m, "a2", "newer"), ("u", dt.datetime(2024, 1, 28, 8), "a0", "other-time"),
                                 ("w", None, "a2", "nullmod-new"), ("t", m, "a1", "tie-a")],
                                "og_url string, modified_time_tz timestamp, audit_time string, v string")
    got = {(r.og_url, r.modified_time_tz): r.v for r in
           dedupe.merge_latest(new, old, ["modified_time_tz", "og_url"], ["audit_time", "v"]).collect()}
    assert got[("u", m)] == "newer" and got[("u", dt.datetime(2024, 1, 28, 8))] == "other-time"
    assert got[("w", None)] == "nullmod-new"                            # null times form one group
    assert got[("t", m)] == "tie-b"                                     # tie on audit: explicit tie-break
    assert dedupe.merge_latest(new, None, ["modified_time_tz", "og_url"], ["audit_time", "v"]).count() == 4


def test_rule_specific_parsers(spark):
    vals = ["2024-01-28T10:00:00+01:00", "2024-01-28T10:00:00Z", "2024-01-28T10:00:00", "2024-01-28",
            "2024-01-28T10:00:00-05:00", "2024-01-28T10:00:00.5", "28/01/2024"]
    conv = one_col(spark, vals, D.parse_sitemap_lastmod)
    wall = one_col(spark, vals, lambda c: D.parse_sitemap_lastmod(c, keep_zone=False))
    ten = dt.datetime(2024, 1, 28, 10)
    assert conv == [dt.datetime(2024, 1, 28, 9), ten, ten, dt.datetime(2024, 1, 28), None, None, None]
    assert wall[:2] == [ten, ten]                                        # B16 compat: zone dropped
    got = one_col(spark, ["2024-01-28 12:00:00+02:00", "2024-01-28 12:00:00+0200", "2024-01-28", "x"],
                  D.parse_20min_date)
    assert got == [dt.datetime(2024, 1, 28, 10)] * 2 + [dt.datetime(2024, 1, 28), None]


def test_rfc822_zone_names(spark):
    vals = ["Sun, 28 Jan 2024 07:00:00 EST", "Sun, 28 Jan 2024 05:00:00 PDT", "Sun, 28 Jan 2024 12:00:00 CET",
            "Sun, 28 Jan 2024 12:00:00 UT"]
    assert one_col(spark, vals, D.parse_rfc822) == [dt.datetime(2024, 1, 28, 12)] * 4


def test_title_rules(spark):
    pages = ['<h1 class="title"></h1><h1>Otro</h1>', '<h1>Uno</h1><h1 class="entry-title">Dos</h1>',
             '<h1 class="ue-c-article__title"> </h1><h1>Fallback</h1>']
    assert one_col(spark, pages, lambda c: H.page_title(c, rule="okdiario")) == ["", "Dos", ""]   # first h1 found
    assert one_col(spark, pages, H.page_title) == [None, "Uno", None]     # only the first h1 is read


def test_absolute_url_like_urljoin(spark):
    from urllib.parse import urljoin
    pairs = [("https://a.es/x/", "y.html"), ("https://a.es/x", "y.html"), ("https://a.es", "y.html"),
             ("https://a.es/x/p?q=1#f", "z/w.html"), ("https://a.es/x/", "/root.html"), ("https://a.es/x", "//cdn.es/i"),
             ("http://a.es/x", "https://b.es/")]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = [r.a for r in df.select(U.absolute_url("b", "h").alias("a")).collect()]
    assert got == [urljoin(b, h) for b, h in pairs]
