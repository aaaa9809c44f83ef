"""Record projections: defaults, error records, superset, reshape, export projection, hour lists."""
import datetime as dt

from pyspark.sql import functions as F

from pressroom.functions.dates import window_hours
from pressroom.operators import records
from pressroom.sinks.writers import export_frame, retention_filter


def test_fill_required_and_clean(spark):
    df = spark.createDataFrame([("  Hola   mundo ", None, None), (None, "2024-01-02T10:00:00Z", ["Ana Pérez", "redacción"])],
                               "title string, publish_date string, authors array<string>")
    out = records.clean_record(records.fill_required(df, "2024-01-28 10:00:00"), "2024-01-28 10:00:00").collect()
    assert out[0].title == "Hola mundo" and out[0].authors == ["Redacción"]
    assert out[0].publish_date == "2024-01-28T10:00:00+00:00" and out[0].section == "general"
    assert out[1].title == "Sin título" and out[1].authors == ["Ana Pérez"]
    assert out[1].publish_date == "2024-01-02T10:00:00+00:00"


def test_error_record_and_snippets(spark):
    df = spark.createDataFrame([("t", "timeout"), ("ok", None)], "title string, err string")
    r = records.error_record(df, "err", "2024-01-28 10:00:00").orderBy("title").collect()
    assert r[0].title == "Error al extraer el artículo" and r[0].authors == ["Error"] and r[0].is_error
    assert r[1].title == "ok" and not r[1].is_error


def test_superset_reshape_export(spark):
    a = spark.createDataFrame([("u", "x")], "url string, b string")
    b = spark.createDataFrame([("v", 1)], "url string, a int")
    s = records.superset([a, b], preferred=["url"])
    assert s.columns == ["url", "a", "b"] and s.count() == 2
    r = records.reshape_20min(spark.createDataFrame([("u", "2024-01-01")], "url string, publish_date string"))
    assert r.columns == ["url", "title", "publish_date", "section", "authors", "summary", "text"]
    e = export_frame(spark.createDataFrame([("T", ["A", "B"], "El País")], "title string, authors array<string>, source string"),
                     "2024-01-28 10:00:00", dialect="semicolon").first()
    assert e.authors == "A; B" and e.source_key == "el_país" and e.url == ""
    try:
        records.assert_same_columns(a, b)
        raise AssertionError("expected drift error")
    except ValueError:
        pass


def test_window_hours_and_retention(spark):
    r = spark.range(1).select(window_hours("2024-01-28 03:30:00", 3).alias("h"),
                              retention_filter(F.to_date(F.lit("2024-01-21")), "2024-01-28 10:00:00", 7).alias("k"),
                              records.category_from_url(F.lit("https://s.es/pwa/deportes/x")).alias("c")).first()
    assert r.h == [dt.datetime(2024, 1, 28, 0), dt.datetime(2024, 1, 28, 1), dt.datetime(2024, 1, 28, 2)]
    assert r.k and r.c == "deportes"


def test_small_date_author_rules(spark):
    from pressroom.functions import authors as A
    from pressroom.functions import dates as D
    from pressroom.functions import html as H
    from pressroom.operators import enrich, limits
    df = spark.createDataFrame([("2024-01-02T10:00:00Z", "2024-01-02 10:00:00", '<meta name="author" content="Ana Ruiz">')],
                               "z string, nz string, html string")
    r = df.select(D.strict_z("z", "2024-01-28 00:00:00").alias("a"), D.strict_z("nz", "2024-01-28 00:00:00").alias("b"),
                  D.relative_bound("2024-01-28 00:00:00", 1).alias("c"), H.meta_author_single("html").alias("d"),
                  A.author_precedence(F.array().cast("array<string>"), H.meta_authors("html"), F.lit(None)).alias("e"),
                  A.author_precedence(F.array().cast("array<string>"), F.array(F.lit("staff")),
                                      F.lit("Por Luis Gil")).alias("f")).first()
    assert r.a == dt.datetime(2024, 1, 2, 10) and r.b == dt.datetime(2024, 1, 28) and r.c == dt.datetime(2024, 1, 27)
    assert r.d == ["Ana Ruiz"] and r.e == ["Ana Ruiz"] and r.f == ["Redacción"]
    pos = spark.createDataFrame([(i, u) for i, u in enumerate(["a", "gn-1", "b", "gn-2"])], "pos int, u string")
    order = limits.priority_rank(F.col("u").startswith("gn"), F.col("pos"))
    assert [x.u for x in pos.orderBy(*order).collect()] == ["gn-2", "gn-1", "a", "b"]
    recs = spark.createDataFrame([("r1", "El País")], "id string, site string")
    sites = spark.createDataFrame([("El País", "elpais.com", 50)], "site string, domain string, max_articles int")
    j = enrich.attach_site(recs, sites, cols=("domain", "max_articles")).first()
    assert (j.domain, j.max_articles) == ("elpais.com", 50)


def test_library_surface(spark, tmp_path):
    from pressroom.functions import html as H
    from pressroom.functions import text as X
    from pressroom.operators import dedupe
    from pressroom.sources.tables import read_pages
    e = spark.createDataFrame([("https://x.es/a/2024/01/28/gran-gol.html", None, "2024-01-28T09:00:00Z", "s" * 600),
                               ("https://x.es/b", "Título", None, None)],
                              "url string, news_title string, published string, summary string")
    r = records.record_from_entry(e, "2024-01-28 12:00:00").orderBy("url").collect()
    assert (r[0].title, r[0].publish_date) == ("Gran Gol.Html", "2024-01-28T09:00:00+00:00")
    assert (r[1].title, r[1].publish_date, r[1].summary) == ("Título", "2024-01-28T12:00:00+00:00", "")
    one = spark.createDataFrame([(["  a ", None, "b\n"], " ", '<meta name="og:title" content="T">')],
                                "l array<string>, s string, h string").select(
        X.clean_text_list("l").alias("l"), X.nullif_blank("s").alias("s"), H.meta_json("h").alias("j"),
        records.feed_summary(F.lit("x" * 600)).alias("f")).first()
    assert (one.l, one.s, one.j, len(one.f)) == ("a b", None, '{"og:title":"T"}', 500)
    dup = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, v string")
    assert dedupe.distinct_rows(dup).count() == 2
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", "<p>x</p>", "extra")], "page_id long, url string, html string, other string") \
        .write.parquet(path)
    assert read_pages(spark, path).columns == ["page_id", "url", "html"]
