"""Multi-site plan: registry rules applied per site in one plan."""

from pressroom.plans.sites import run_report, run_sites
from pressroom.sources.registry import load_sites


def _rss(items):
    body = "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate><author>{a}</author></item>"
                   for t, u, d, a in items)
    return f"<rss><channel>{body}</channel></rss>"


def test_run_sites(spark):
    sites = load_sites(spark)
    ep_feed = "https://feeds.elpais.com/mrss-s/pages/ep/site/elpais.com/portada"
    mundo_sm = "https://www.elmundo.es/sitemaps/noticia_news_ahcoupiaCazadei7kae6theepho5no7o.xml"
    docs = spark.createDataFrame([
        (ep_feed, _rss([("Uno", "https://elpais.com/espana/2024-01-28/uno.html?x=1", "Sun, 28 Jan 2024 08:00:00 GMT",
                         "Por Ana Pérez, Madrid"),
                        ("Viejo", "https://elpais.com/espana/2024-01-20/viejo.html", "Sat, 20 Jan 2024 08:00:00 GMT", ""),
                        ("Dup", "https://elpais.com/espana/2024-01-28/uno.html", "Sun, 28 Jan 2024 09:00:00 GMT", "")])),
        (mundo_sm, '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://www.elmundo.es/'
                   'espana/2024/01/28/abc.html</loc><lastmod>2024-01-28T07:00:00Z</lastmod></url></urlset>'),
    ], "url string, content string")
    out, report = run_sites(sites, docs, "2024-01-28 12:00:00", days=1)
    rows = {r.url: r for r in out.collect()}
    assert set(rows) == {"https://elpais.com/espana/2024-01-28/uno.html",
                         "https://www.elmundo.es/espana/2024/01/28/abc.html"}
    ep = rows["https://elpais.com/espana/2024-01-28/uno.html"]
    assert (ep.title, ep.section, ep.authors, ep.source) == ("Uno", "Espana", "Ana Pérez", "El País")
    em = rows["https://www.elmundo.es/espana/2024/01/28/abc.html"]
    assert em.section == "España" and em.title == "Abc.Html"
    rep = {(r.site, r.feed_ord): (r.n_found, r.n_recent) for r in report.collect()}
    assert rep[("El País", 0)] == (3, 2)
    rr = {r.name: r.ok for r in run_report(sites, out).collect()}
    assert rr["El País"] and not rr["ABC"]


def test_okdiario_flow(spark):
    from pressroom.plans.sites import okdiario_urls
    idx = spark.createDataFrame([("OKDiario", "https://okdiario.com/sitemap_index.xml",
        '<sitemapindex><sitemap><loc>https://okdiario.com/s1.xml</loc></sitemap>'
        '<sitemap><loc>https://okdiario.com/google-news.xml</loc></sitemap></sitemapindex>')],
        "site string, url string, content string")
    docs = spark.createDataFrame([
        ("https://okdiario.com/google-news.xml", '<urlset><url><loc>https://okdiario.com/n1</loc>'
         '<lastmod>2024-01-28T08:00:00+01:00</lastmod></url><url><loc>https://okdiario.com/old</loc>'
         '<lastmod>2024-01-20T08:00:00Z</lastmod></url><url><loc>https://okdiario.com/nodate</loc></url></urlset>'),
        ("https://okdiario.com/s1.xml", '<urlset><url><loc>https://okdiario.com/s1a</loc></url></urlset>')],
        "url string, content string")
    rss = spark.createDataFrame([("OKDiario", 0, 0, "https://okdiario.com/n1", "Sun, 28 Jan 2024 08:00:00 GMT"),
                                 ("OKDiario", 0, 1, "https://okdiario.com/r1", "Sun, 28 Jan 2024 09:00:00 GMT"),
                                 ("OKDiario", 0, 2, "https://okdiario.com/r2", "Sun, 28 Jan 2024 10:00:00 GMT")],
                                "site string, feed_ord int, item_ord int, url string, published string")
    got = okdiario_urls(idx, docs, rss, "2024-01-28 12:00:00", days=1, max_articles=4).collect()
    # google-news sitemap first (old entry dropped, undated kept), then s1, then the RSS top-up
    assert {r.url for r in got} == {"https://okdiario.com/n1", "https://okdiario.com/nodate",
                                    "https://okdiario.com/s1a", "https://okdiario.com/r1"}
    two = okdiario_urls(idx, docs, rss, "2024-01-28 12:00:00", days=1, max_articles=2).collect()
    assert {r.url for r in two} == {"https://okdiario.com/n1", "https://okdiario.com/nodate"}


def test_el_mundo_fill(spark):
    from pressroom.plans.sites import el_mundo_enrich
    recs = spark.createDataFrame([("https://www.elmundo.es/espana/2024/01/28/x.html", "Slug Title", "", "2024-01-28", "", "")],
                                 "url string, title string, authors string, publish_date string, section string, subsection string")
    pages = spark.createDataFrame([("https://www.elmundo.es/espana/2024/01/28/x.html",
        '<h1>Titular</h1><a class="ue-c-article__byline-name">Luis Gil</a><span itemprop="author">Ana Ruiz</span>'
        '<time datetime="2024-01-28T08:00:00Z">hoy</time>')], "url string, html string")
    r = el_mundo_enrich(recs, pages).first()
    assert (r.title, r.authors, r.publish_date, r.section, r.subsection) == (
        "Slug Title", "Ana Ruiz, Luis Gil", "2024-01-28", "España", "01")    # year second -> piece 3


def test_el_pais_flow(spark):
    from pressroom.plans.sites import el_pais_records

    def feed(items):
        return "<rss><channel>" + "".join(
            f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate>{a}{c}</item>" for t, u, d, a, c in items
        ) + "</channel></rss>"
    f0 = feed([("Uno", "https://elpais.com/espana/2024-01-28/uno.html?utm=x", "Sun, 28 Jan 2024 10:00:00 GMT",
                "<author>Por Ana Pérez, Madrid</author>", ""),
               ("Viejo", "https://elpais.com/espana/2024-01-20/viejo.html", "Sat, 20 Jan 2024 10:00:00 GMT", "", ""),
               ("Sin fecha", "https://elpais.com/espana/x.html", "", "", ""),
               ("Tag", "https://elpais.com/2024-01-28/solo.html", "Sun, 28 Jan 2024 11:00:00 GMT", "",
                "<category>Cultura</category>")])
    f1 = feed([("Dup", "https://elpais.com/espana/2024-01-28/uno.html", "Sun, 28 Jan 2024 10:00:00 GMT", "", ""),
               ("Página", "https://elpais.com/deportes/2024-01-28/p.html", "Sun, 28 Jan 2024 09:00:00 GMT", "", "")])
    docs = spark.createDataFrame([(0, f0), (1, f1)], "feed_ord int, content string")
    pages = spark.createDataFrame([("https://elpais.com/deportes/2024-01-28/p.html",
                                    '<div class="firma">Luis Gil</div>')], "url string, html string")
    rows = {r.url: r for r in el_pais_records(docs, "2024-01-28 12:00:00", 1, pages=pages).collect()}
    assert set(rows) == {"https://elpais.com/espana/2024-01-28/uno.html", "https://elpais.com/2024-01-28/solo.html",
                         "https://elpais.com/deportes/2024-01-28/p.html"}
    uno = rows["https://elpais.com/espana/2024-01-28/uno.html"]
    assert (uno.title, uno.authors, uno.section, uno.publish_date) == ("Uno", "Ana Pérez", "Espana",
                                                                       "2024-01-28T10:00:00+00:00")
    assert rows["https://elpais.com/2024-01-28/solo.html"].section == "Solo.Html"
    assert rows["https://elpais.com/deportes/2024-01-28/p.html"].authors == "Luis Gil"


def test_sitemap_overlay_modes(spark):
    from pressroom.plans.sites import sitemap_overlay_records
    page = '<h1>Titular de página</h1><meta name="author" content="Ana Pérez">'
    pages = spark.createDataFrame([("https://x.es/politica/congreso/a.html", page),
                                   ("https://x.es/economia/b.html", page)], "url string, html string")
    sm = spark.createDataFrame([(
        '<urlset xmlns:news="n"><url><loc>https://x.es/politica/congreso/a.html</loc><news:news>'
        '<news:publication><news:name>Diario X</news:name></news:publication>'
        '<news:publication_date>2024-01-28T09:00:00Z</news:publication_date></news:news></url>'
        '<url><loc>https://x.es/economia/b.html</loc><news:news><news:title>Del sitemap</news:title>'
        '<news:publication><news:language>ca</news:language></news:publication></news:news></url></urlset>',)],
        "content string")
    allm = {r.url: r for r in sitemap_overlay_records(pages, sm, "2024-01-28 12:00:00", "all", "Público").collect()}
    a = allm["https://x.es/politica/congreso/a.html"]
    assert (a.title, a.publish_date, a.section, a.authors) == ("Sin título", "2024-01-28T09:00:00+00:00",
                                                               "Politica", ["Ana Pérez"])
    assert allm["https://x.es/economia/b.html"].title == "Del sitemap"
    nn = {r.url: r for r in sitemap_overlay_records(pages, sm, "2024-01-28 12:00:00", "nonnull", "El Español").collect()}
    a = nn["https://x.es/politica/congreso/a.html"]
    assert (a.title, a.source, a.language) == ("Titular de página", "Diario X", "es")
    b = nn["https://x.es/economia/b.html"]
    assert (b.title, b.source, b.language) == ("Del sitemap", "El Español", "ca")


def test_jsonld_sites(spark):
    from pressroom.plans.sites import capped_site_urls, jsonld_site_records
    sm = spark.createDataFrame([("Infobae", 0, i, u) for i, u in enumerate(
        ["https://i.com/a", "https://i.com/b", "https://i.com/a"])], "site string, feed_ord int, item_ord int, loc string")
    front = spark.createDataFrame([("Infobae", "https://i.com/espana", 0, "/noticias/x.html"),
                                   ("Infobae", "https://i.com/espana", 1, "/otra/y.html")],
                                  "site string, base_url string, pos int, href string")
    urls = [r.url for r in capped_site_urls(sm, front, 3).orderBy("tier", "item_ord").collect()]
    assert urls == ["https://i.com/a", "https://i.com/b", "https://i.com/noticias/x.html"]
    page = ('<script type="application/ld+json">[{"author": [{"name": "Redacción"}, "Ana Ruiz"], '
            '"datePublished": "2024-01-28T09:00:00Z", "description": "uno"}]</script>'
            '<script type="application/ld+json">{"author": {"name": "Luis Gil"}, "description": "dos"}</script>'
            '<ol class="breadcrumb"><li>Inicio</li><li>Mundo</li></ol><title>T</title>')
    pages = spark.createDataFrame([("https://i.com/america/x", page), ("https://i.com/deportes/y", "<p>x</p>")],
                                  "url string, html string")
    rows = {r.url: r for r in jsonld_site_records(pages, "2024-01-28 12:00:00", "Infobae").collect()}
    a = rows["https://i.com/america/x"]
    assert (a.authors, a.summary, a.section, a.publish_date, a.title) == (
        ["Ana Ruiz", "Luis Gil"], "dos", "Mundo", "2024-01-28T09:00:00+00:00", "T")
    b = rows["https://i.com/deportes/y"]
    assert (b.authors, b.section, b.publish_date) == (["Redacción Infobae"], "Deportes", None)


def test_feed_page_records(spark):
    from pressroom.plans.sites import feed_page_records
    entries = spark.createDataFrame([
        ("EC", 0, 0, "https://ec.com/espana/a.html", "Sun, 28 Jan 2024 10:00:00 GMT"),
        ("EC", 0, 1, "https://ec.com/espana/old.html", "Sat, 20 Jan 2024 10:00:00 GMT"),
        ("EC", 1, 0, "https://ec.com/mundo/b.html", None),
        ("EC", 1, 1, "https://ec.com/espana/a.html", "Sun, 28 Jan 2024 10:00:00 GMT")],
        "site string, feed_ord int, item_ord int, url string, published string")
    pages = spark.createDataFrame([
        ("https://ec.com/espana/a.html", '<h1> Uno </h1><meta name="author" content="Ana Pérez, redactora">'
                                         '<time datetime="2024-01-28 10:00:00+01:00">x</time>'),
        ("https://ec.com/mundo/b.html", '<h1>Dos</h1><meta name="author" content="Laura Martín y Pablo Ruiz">'
                                        '<time datetime="2024-01-10">x</time>')], "url string, html string")
    ec = feed_page_records(entries, pages, "2024-01-28 12:00:00", 1, "el_confidencial", max_articles=3,
                           source="El Confidencial").collect()
    # this path does not dedupe across feeds: the repeated URL is exported twice (ranks 1 and 3)
    assert sorted((r.url, r.rank) for r in ec) == [("https://ec.com/espana/a.html", 1), ("https://ec.com/espana/a.html", 3),
                                                   ("https://ec.com/mundo/b.html", 2)]
    a = [r for r in ec if r.url.endswith("a.html")][0]
    assert (a.title, a.authors, a.section) == ("Uno", ["Redacción"], "Espana")
    tm = feed_page_records(entries, pages, "2024-01-28 12:00:00", 1, "20minutos").collect()
    assert [(r.url, r.authors) for r in tm] == [("https://ec.com/espana/a.html", ["Ana Pérez"])]
    assert tm[0].publish_date == "2024-01-28T09:00:00+00:00" and "text" in tm[0].asDict()


def test_sitemap_then_rss(spark):
    from pressroom.plans.sites import sitemap_then_rss_records
    docs = spark.createDataFrame([
        ("LD", 0, "sitemap", "<urlset><url><loc>https://ld.com/espana/a.html</loc></url>"
                             "<url><loc>https://ld.com/b.html</loc></url></urlset>"),
        ("LD", 1, "rss", "<rss><channel><item><link>https://ld.com/espana/a.html</link></item>"
                         "<item><link>https://ld.com/c.html</link></item><item><link>https://ld.com/d</link></item>"
                         "</channel></rss>")], "site string, src_ord int, kind string, content string")
    pages = spark.createDataFrame([("https://ld.com/espana/a.html", '<h1>A</h1><meta name="author" content="Ana">'
                                    '<meta name="description" content="resumen"><time datetime="2024-01-28T10:00:00Z">')],
                                  "url string, html string")
    rows = sitemap_then_rss_records(docs, pages, max_articles=4, source="Libertad Digital").orderBy("rank").collect()
    assert [r.url for r in rows] == ["https://ld.com/espana/a.html", "https://ld.com/b.html",
                                     "https://ld.com/espana/a.html", "https://ld.com/c.html"]
    a = rows[0]
    assert (a.title, a.authors, a.section, a.summary, a.publish_date) == (
        "A", ["Ana"], "espana", "resumen", "2024-01-28T10:00:00+00:00")
    assert rows[1].section == "b.html" and rows[1].title is None


def test_run_sites_with_pages(spark):
    sites = load_sites(spark)
    feed = "https://rss.elconfidencial.com/espana/"
    docs = spark.createDataFrame([(feed, _rss([("Feed title", "https://www.elconfidencial.com/espana/2024-01-28/n_1/",
                                                "Sun, 28 Jan 2024 08:00:00 GMT", "")]))], "url string, content string")
    pages = spark.createDataFrame([("https://www.elconfidencial.com/espana/2024-01-28/n_1/",
                                    '<h1>Page title</h1><meta name="author" content="Ana Pérez">'),
                                   ("https://other/x", "<h1>unrelated</h1>")], "url string, html string")
    out, _ = run_sites(sites, docs, "2024-01-28 12:00:00", days=1, pages=pages)
    r = out.collect()
    assert len(r) == 1 and (r[0].title, r[0].authors, r[0].source) == ("Page title", "Ana Pérez", "El Confidencial")
