"""HTML/JSON extraction on fixture pages, and the hourly job end to end."""
import datetime as dt

from pyspark.sql import functions as F

from pressroom.functions import html as H
from pressroom.operators import records

PAGE = """<html><head><title>T</title>
<meta property="og:url" content="https://s.es/deportes/futbol/gol.html"/>
<meta content="2024-01-28T10:00:00Z" property="article:published_time">
<meta name="author" content="Ana Pérez"><meta name="description" content="Desc &amp; más">
<script type="application/ld+json">{"@type":"NewsArticle","headline":"H1","author":[{"name":"Ana Pérez"},{"name":"Luis Gil"}],"datePublished":"2024-01-28T09:00:00Z"}</script>
<script type="application/ld+json">{"author":"Solo Autor"}</script>
</head><body><ol class="breadcrumb"><li>Inicio</li><li><a>Deportes</a></li></ol>
<h1 class="ue-c-article__headline">  Gran   gol </h1><time datetime="2024-01-28T08:00:00Z">hoy</time>
<article><p>corto</p><p>Este párrafo tiene bastante más de treinta caracteres.<p>Otro párrafo largo que no se cerró nunca bien</article>
<a href="/noticias/a.html">a</a><a class="x" href="https://o.es/b">b</a> isAccessibleForFree": false</body></html>"""


def test_column_extractors(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    r = df.select(H.page_title("html").alias("t"), H.meta_map("html").alias("m"),
                  H.jsonld_authors("html").alias("a"), H.jsonld_authors("html", every_item=False).alias("a1"),
                  H.jsonld_field("html", "$.headline").alias("hl"), H.time_datetime("html").alias("tm"),
                  H.breadcrumb_second("html").alias("bc"), H.links("html").alias("l"),
                  H.paywall_flag("html").alias("p"), H.main_text("html").alias("txt"),
                  H.meta_authors("html").alias("ma")).first()
    assert r.t == "Gran gol"
    assert r.m["og:url"] == "https://s.es/deportes/futbol/gol.html" and r.m["description"] == "Desc & más"
    assert r.a == ["Ana Pérez", "Luis Gil", "Solo Autor"]
    assert r.a1 == ["Ana Pérez", "Luis Gil", "Solo Autor"]      # item 0 of each block, appended
    assert r.hl == "H1" and r.tm == "2024-01-28T08:00:00Z" and r.bc == "Deportes"
    assert r.l == ["/noticias/a.html", "https://o.es/b"] and r.p == "LOCKED"
    assert r.txt == ("Este párrafo tiene bastante más de treinta caracteres. "
                     "Otro párrafo largo que no se cerró nunca bien")
    assert r.ma == ["Ana Pérez"]


def test_project_paths_and_records(spark):
    df = spark.createDataFrame([('{"og": {"url": "u", "n": 3}, "a": null}',), ("not json",)], "data string")
    out = records.rename_dotted(records.project_paths(df, "data", ["og.url", "og.n", "a.b"])).collect()
    assert (out[0].og_url, out[0].og_n, out[0].a_b) == ("u", "3", None)
    assert out[1].og_url is None
    rec = records.record_from_url(spark.createDataFrame([("https://x.es/deportes/futbol/gran-gol-hoy/",)], "url string"),
                                  "2024-01-28 10:00:00").first()
    assert (rec.title, rec.section, rec.subsection, rec.domain) == ("Gran Gol Hoy", "Futbol", "Deportes", "x.es")


def _feed(items):
    body = "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate></item>" for t, u, d in items)
    return f"<rss><channel>{body}</channel></rss>"


def _page(url, pub, mod, title):
    return (f'<html><head><meta property="og:url" content="{url}"><meta property="og:title" content="{title}">'
            f'<meta property="article:published_time" content="{pub}">'
            f'<meta property="article:modified_time" content="{mod}"></head>'
            f'<body><article><p>Un texto suficientemente largo para ser un párrafo.</p></article></body></html>')


def test_hourly_job_idempotent(spark, tmp_dir):
    from pressroom.plans.medallion import run_hour
    feed = spark.createDataFrame([("s", 0, _feed([
        ("A", "https://s.es/a/1.html", "Sun, 28 Jan 2024 08:10:00 +0000"),
        ("B", "https://s.es/b/2.html", "Sun, 28 Jan 2024 09:20:00 +0000"),
        ("Old", "https://s.es/c/3.html", "Sun, 21 Jan 2024 09:20:00 +0000")]))],
        "site string, feed_ord int, content string")
    pages = spark.createDataFrame([
        ("https://s.es/a/1.html", _page("https://s.es/a/1.html", "2024-01-28T08:10:00Z", "2024-01-28T08:30:00Z", "A")),
        ("https://s.es/b/2.html", _page("https://s.es/b/2.html", "2024-01-28T09:20:00Z", "2024-01-28T09:25:00Z", "B"))],
        "url string, html string")
    as_of = dt.datetime(2024, 1, 28, 11)
    paths = run_hour(spark, feed, None, pages, tmp_dir + "/out", as_of, 6)
    pub = spark.read.parquet(paths["published"])
    rows = sorted(r.og_url for r in pub.collect())
    assert rows == ["https://s.es/a/1.html", "https://s.es/b/2.html"]
    r = pub.filter(F.col("og_url") == "https://s.es/a/1.html").first()
    assert (r.category, r.isAccessibleForFree, r.day_of_week, r.is_weekend) == ("a", "FREE", "Sunday", True)
    assert (r.year, r.month, r.day, r.hour) == ("2024", "01", "28", "09")    # modified 08:30Z in Rome
    run_hour(spark, feed, None, pages, tmp_dir + "/out", as_of, 6)
    assert spark.read.parquet(paths["published"]).count() == 2
    assert spark.read.parquet(paths["feed_rss"]).count() == 2
    assert spark.read.parquet(paths["published_html"]).count() == 2


def test_assemble_article(spark):
    df = spark.createDataFrame([("https://s.es/deportes/futbol/gol.html", PAGE), ("https://s.es/x", "<html></html>")],
                               "url string, html string")
    rows = {r.url: r for r in records.assemble_article(df, "2024-01-28 10:00:00").collect()}
    a = rows["https://s.es/deportes/futbol/gol.html"]
    assert (a.title, a.section, a.subsection, a.domain) == ("Gran gol", "Deportes", "Futbol", "s.es")
    assert a.publish_date == "2024-01-28T08:00:00+00:00" and a.summary == "Desc & más"
    assert a.authors == ["Ana Pérez", "Luis Gil", "Solo Autor"]     # JSON-LD wins over the meta author
    b = rows["https://s.es/x"]
    assert (b.title, b.authors, b.summary, b.publish_date) == ("Sin título", ["Redacción"], "...",
                                                              "2024-01-28T10:00:00+00:00")


def test_payload_key_collision(spark):
    from pressroom.plans.medallion import page_payload
    links = spark.createDataFrame([("https://s.es/a", "2024", "01", "28", "09")],
                                  "link string, year string, month string, day string, hour string")
    pages = spark.createDataFrame([("https://s.es/a", '<meta name="html" content="x"><meta name="og:url" content="u">')],
                                  "url string, html string")
    row = page_payload(links, pages).first()
    assert '"og:url":"u"' in row.data and row.data.count('"html"') == 1


def test_curated_sitemap_lastmod_resolution(spark):
    from pressroom.plans.medallion import curated_sitemap_rows
    sm = ('<urlset xmlns:news="n">'
          '<url><loc>https://s.es/a</loc><lastmod>2024-01-28T08:00:00Z</lastmod></url>'
          '<url><loc>https://s.es/b</loc><news:news><news:publication_date>2024-01-28T07:00:00Z'
          '</news:publication_date></news:news></url>'
          '<url><loc>https://s.es/c</loc><news:news><news:publication_date>2024-01-28T07:30:00Z'
          '</news:publication_date></news:news></url>'
          '<url><loc>https://s.es/d</loc><news:news><news:publication_date>2024-01-28T06:00:00Z'
          '</news:publication_date></news:news></url>'
          '<url><loc>https://s.es/late</loc><news:news><news:publication_date>2024-01-28T12:30:00Z'
          '</news:publication_date></news:news></url></urlset>')
    docs = spark.createDataFrame([("s", sm)], "site string, content string")
    pages = spark.createDataFrame([
        ("https://s.es/b", '<meta property="article:modified_time" content="2024-01-28T09:00:00Z">'
                           '<meta property="og:modified_time" content="2024-01-28T05:00:00Z">'),
        ("https://s.es/c", '<meta property="og:modified_time" content="2024-01-28T09:30:00Z">'),
        ("https://s.es/d", '<meta property="article:section" content="x">'
                           '<meta property="og:modified_time" content="2024-01-28T05:00:00Z">')],
        "url string, html string")
    rows = {r.loc: r for r in curated_sitemap_rows(docs, "2024-01-28 11:00:00", 6, pages).collect()}
    assert rows["https://s.es/a"].lastmod == "2024-01-28T08:00:00Z"
    assert rows["https://s.es/b"].lastmod == "2024-01-28T09:00:00Z"      # article:modified_time wins
    assert rows["https://s.es/c"].lastmod == "2024-01-28T09:30:00Z"      # no article meta: og
    # article meta present but no modified time: null, then the publication date is used
    assert rows["https://s.es/d"].lastmod == "2024-01-28T06:00:00Z"
    assert "https://s.es/late" not in rows                                 # published after the run hour
    assert (rows["https://s.es/b"].day, rows["https://s.es/b"].hour) == ("28", "10")   # Rome


def test_hourly_job_rejects(spark, tmp_dir):
    from pressroom.plans.medallion import run_hour
    feed = spark.createDataFrame([("s", 0, _feed([
        ("A", "https://s.es/a/1.html", "Sun, 28 Jan 2024 08:10:00 +0000"),
        ("Missing", "https://s.es/m/9.html", "Sun, 28 Jan 2024 09:10:00 +0000")]))],
        "site string, feed_ord int, content string")
    pages = spark.createDataFrame([
        ("https://s.es/a/1.html", _page("https://s.es/a/1.html", "2024-01-28T08:10:00Z", "2024-01-28T08:30:00Z", "A"))],
        "url string, html string")
    paths = run_hour(spark, feed, None, pages, tmp_dir + "/out", dt.datetime(2024, 1, 28, 11), 6)
    errors = spark.read.parquet(paths["errors"]).collect()
    assert [r.link for r in errors] == ["https://s.es/m/9.html"] and "error_url_report" in errors[0].data
    assert [r.og_url for r in spark.read.parquet(paths["published"]).collect()] == ["https://s.es/a/1.html"]
