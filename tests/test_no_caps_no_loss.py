"""No cap without an argument, and no row lost by a merge."""
import datetime as dt

from pyspark.sql import functions as F

from pressroom.functions import html as H
from pressroom.plans.medallion import candidate_links, merge_curated_into, merge_published_into, page_payload
from pressroom.plans.sites import run_sites
from pressroom.sources.feeds import index_children, parse_feed, parse_sitemap
from pressroom.sources.registry import load_sites

AS_OF = "2024-01-28 12:00:00"


def test_every_item_of_a_feed_is_kept_and_counted(spark):
    sites = load_sites(spark)
    abc = sites.filter("name = 'ABC'").select(F.explode("rss_feeds").alias("u")).first().u
    body = "".join(f"<item><title>t{i}</title><link>https://www.abc.es/e/{i}.html</link>"
                   f"<pubDate>Sun, 28 Jan 2024 08:00:00 GMT</pubDate></item>" for i in range(150))
    docs = spark.createDataFrame([(abc, f"<rss><channel>{body}</channel></rss>")], "url string, content string")
    free = sites.withColumns({"max_articles": F.lit(None).cast("int"), "max_articles_per_feed": F.lit(None).cast("int")})
    out, report = run_sites(free, docs, AS_OF)
    assert out.count() == 150 and out.filter("rank is not null").count() == 0
    out, report = run_sites(free, docs, AS_OF, default_cap=20)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 21))
    assert [r.n_found for r in report.collect()] == [150]


def test_sitemaps_and_indexes_are_read_whole(spark):
    entries = "".join(f"<url><loc>https://x/{i}</loc></url>" for i in range(300))
    sm = spark.createDataFrame([(f"<urlset>{entries}</urlset>",)], "content string")
    assert parse_sitemap(sm).count() == 300
    idx = "".join(f"<sitemap><loc>https://x/s{i}.xml</loc></sitemap>" for i in range(8))
    ix = spark.createDataFrame([(f"<sitemapindex>{idx}</sitemapindex>",)], "content string")
    assert index_children(ix).count() == 8 and index_children(ix, max_children=5).count() == 5
    first = index_children(ix, priority_marker="s3").orderBy("child_ord").first()
    assert first.child_url.endswith("s3.xml")


def test_merges_keep_hours_outside_the_window(spark, tmp_dir):
    schema = "link string, v int, year string, month string, day string, hour string"
    for v in (1, 2):
        merge_curated_into(spark.createDataFrame([(f"l{v}", v, "2020", "01", "02", "03")], schema), tmp_dir + "/c")
    assert spark.read.parquet(tmp_dir + "/c").count() == 2
    pub = "og_url string, modified_time_tz timestamp, audit_time string, year string, month string, day string, hour string"
    for u in ("a", "b", "a"):
        row = (u, dt.datetime(2020, 1, 2, 3), "t" + u, "2020", "01", "02", "03")
        merge_published_into(spark.createDataFrame([row], pub), tmp_dir + "/p")
    assert sorted(r.og_url for r in spark.read.parquet(tmp_dir + "/p").collect()) == ["a", "b"]


def test_links_are_found_with_partition_inference(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        row = [("l", "2024", "01", "05", "03")]
        (spark.createDataFrame(row, "link string, year string, month string, day string, hour string")
         .write.partitionBy("year", "month", "day", "hour").parquet(tmp_dir + "/f"))
        got = candidate_links(tmp_dir + "/f", tmp_dir + "/none", spark, "2024-01-05 04:00:00", 6).collect()
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert [tuple(r) for r in got] == [("l", "2024", "01", "05", "03")]


def test_snapshots_after_the_run_are_not_used(spark):
    links = spark.createDataFrame([("u", "2024", "01", "05", "03")], "link string, year string, month string, day string, hour string")
    pages = spark.createDataFrame([("u", "<p>old</p>", dt.datetime(2024, 1, 5, 2)), ("u", "<p>late</p>", dt.datetime(2024, 2, 5))],
                                  "url string, html string, fetched_at timestamp")
    assert "old" in page_payload(links, pages, "2024-01-05 04:00:00").first().data


def test_feed_and_markup_variants(spark):
    rdf = ('<rdf:RDF xmlns:rdf="r" xmlns:content="c"><channel><title>c</title></channel><item><title>A</title><link>https://x/a</link>'
           '<date>2024-01-28T08:00:00Z</date><content:encoded>body</content:encoded></item></rdf:RDF>')
    r = parse_feed(spark.createDataFrame([(rdf,)], "content string")).first()
    assert (r.title, r.link, r.dc_date, r.summary) == ("A", "https://x/a", "2024-01-28T08:00:00Z", "body")
    html = "<a href='/x.html'>1</a><a class=c href=/y.html>2</a><time datetime='2024-01-01'>t</time><p>Espa&ntilde;a &#8217;&#x41;&nope;</p>"
    row = spark.createDataFrame([(html,)], "html string").select(
        H.links("html").alias("l"), H.time_datetime("html").alias("t"), H.tag_text(H.first_tag_inner("html", "p")).alias("p")).first()
    assert (row.l, row.t, row.p) == (["/x.html", "/y.html"], "2024-01-01", "España ’A&nope;")
    assert load_sites(spark).filter("name = '20minutos' and size(rss_feeds) = 1").count() == 1
