"""The hourly job parses each landed document once a run, however often its rows are named."""
from pyspark.sql import functions as F

from pressroom.functions import html as H
from pressroom.plans import medallion
from pressroom.sources.feeds import parse_feed, parse_sitemap

WHEN = "2024-01-28 11:00:00"
RSS = ("<rss><channel><item><title>t{0}</title><link>https://s.es/a/{0}.html</link>"
       "<pubDate>Sun, 28 Jan 2024 0{0}:10:00 +0000</pubDate></item></channel></rss>")
MAP = "<urlset><url><loc>https://s.es/m/{0}.html</loc><lastmod>2024-01-28T0{0}:10:00Z</lastmod></url></urlset>"


def _docs(spark, form, numbers):
    rows = [("s", form.format(i)) for i in numbers] + [("s", "<rss><channel>"), ("s", None)]
    return spark.createDataFrame(rows, "site string, content string").repartition(2)


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(")


def test_each_document_is_parsed_once(spark):
    feed, entries = parse_feed(_docs(spark, RSS, [7, 8])), parse_sitemap(_docs(spark, MAP, [7]))
    assert _parses(feed) == 1 and _parses(entries) == 1
    assert sorted(r.link for r in feed.collect()) == ["https://s.es/a/7.html", "https://s.es/a/8.html"]
    assert [r.loc for r in entries.collect()] == ["https://s.es/m/7.html"]


def test_second_run_reads_its_own_rows_once(spark, tmp_dir, monkeypatch):
    """The hours a run touches come from its stored rows, not from parsing its documents again."""
    seen, real = [], medallion._read_history
    monkeypatch.setattr(medallion, "_read_history", lambda s, base, new, *a: (seen.append(_parses(new)), real(s, base, new, *a))[1])
    for run in ([7, 8], [8, 9]):
        medallion.merge_curated_into(medallion.curated_feed_rows(_docs(spark, RSS, run), medallion._dt.datetime.fromisoformat(WHEN), 6), tmp_dir + "/f")
    assert seen == [0, 0]
    assert sorted(r.link[-6] for r in spark.read.parquet(tmp_dir + "/f").collect()) == ["7", "8", "9"]


def test_near_window_loses_no_hour(spark):
    """The coarse test keeps every instant whose Rome hour lies in the run's window, and no unknown one."""
    t = spark.range(-60, 61).select((F.lit(WHEN).cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"), F.lit(59))).alias("_t"))
    rows = medallion.records.hour_columns(t.union(spark.sql("SELECT CAST(NULL AS timestamp)")), "_t", medallion.TZ)
    window = medallion.recency.in_hour_window(WHEN, 6)
    assert rows.filter(window).count() == 7 == rows.filter(medallion._near_window("_t", WHEN, 6) & window).count()


def test_values_without_references_stay(spark):
    page = '<meta name="a" content="x; y"><meta name="b" content="1 &lt; 2 &amp;eacute; &eacute;"><meta name="a" content="z">'
    row = spark.createDataFrame([(page,), (None,)], "html string").select(H.meta_map("html").alias("m"), H.unescape("html").alias("u")).collect()
    assert row[0].m == {"a": "x; y", "b": "1 < 2 &eacute; é"} and row[1].m is None and row[1].u is None
