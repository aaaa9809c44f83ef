"""As-of page joins, schema drift of stored hours, replayed batches, export dialect bytes, retention, relative bounds, author elements."""
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import one_col
from pressroom.functions import dates as D
from pressroom.functions import html as H
from pressroom.operators import enrich
from pressroom.plans import medallion
from pressroom.session import scratch_path
from pressroom.sinks import writers as W
from pressroom.sources import feeds, tables
from pressroom.streaming import streams as S

T = dt.datetime


def test_as_of_join(spark):
    pages = spark.createDataFrame(
        [("u", T(2024, 1, 1, 8), "a"), ("u", T(2024, 1, 3, 8), "b"), ("u", T(2024, 1, 3, 8), "b"), ("u", None, "never"), ("x", T(2024, 1, 1), "x")],
        "url string, fetched_at timestamp, html string")
    links = spark.createDataFrame(
        [(1, "u", T(2024, 1, 1, 7)), (2, "u", T(2024, 1, 1, 8)), (3, "u", T(2024, 1, 2)), (4, "u", T(2024, 1, 3, 8)), (5, "u", T(2024, 2, 1)),
         (6, "none", T(2024, 2, 1)), (7, None, T(2024, 2, 1)), (8, "u", None), (3, "u", T(2024, 1, 2))], "id int, url string, at timestamp")
    for bucket in ("hour", "day", "year"):
        got = enrich.attach_pages_as_of(links, pages, "at", bucket=bucket)
        assert got.columns == ["id", "url", "at", "fetched_at", "html", "has_page"]
        assert sorted((r.id, r.html, r.has_page) for r in got.collect()) == [
            (1, None, False), (2, "a", True), (3, "a", True), (3, "a", True), (4, "b", True), (5, "b", True),
            (6, None, False), (7, None, False), (8, None, False)]
    assert enrich.attach_pages_as_of(links.limit(0), pages, "at").count() == 0
    assert enrich.attach_pages_as_of(links, pages.limit(0), "at").filter("has_page").count() == 0


def test_as_of_join_against_brute_force(spark):
    pages = [(f"u{i % 5}", T(2024, 1, 1) + dt.timedelta(hours=i * 7 % 400), f"h{i}") for i in range(60)]
    links = [(i, f"u{i % 6}", T(2024, 1, 1) + dt.timedelta(hours=i * 13 % 500, minutes=i % 3)) for i in range(300)]
    got = enrich.attach_pages_as_of(spark.createDataFrame(links, "id int, url string, at timestamp"),
                                    spark.createDataFrame(pages, "url string, fetched_at timestamp, html string"), "at")
    for r in got.collect():
        times = [p[1] for p in pages if p[0] == r.url and p[1] <= r.at]
        assert r.fetched_at == max(times, default=None)
        assert r.html is None if not times else (r.url, r.fetched_at, r.html) in pages


def test_schema_drift(spark, tmp_dir):
    base = os.path.join(tmp_dir, "hours")
    old = spark.createDataFrame([("a", "2024", "01", "02", "03")], "v string, year string, month string, day string, hour string")
    W.write_hours(old, base)
    hours = [("2024", "01", "02", "03"), ("2024", "01", "02", "04")]
    assert tables.read_touched_hours(spark, base, hours[1:], ["v"]) is None
    assert [tuple(r) for r in tables.read_touched_hours(spark, base, hours, ["v"]).collect()] == [("a", "2024", "01", "02", "03")]
    with pytest.raises(ValueError, match="only new .'w'."):
        tables.read_touched_hours(spark, base, hours, ["v", "w"])
    with pytest.raises(ValueError):
        tables.read_touched_hours(spark, base, hours, ["v"], drift="guess")
    wide = tables.read_touched_hours(spark, base, hours, ["v", "w"], drift="widen").first()
    assert (wide.v, wide.w) == ("a", None)
    with pytest.raises(ValueError, match="only stored .'v'."):           # nothing is written by a refused merge
        medallion.merge_curated_into(old.withColumnRenamed("v", "other"), base)
    assert spark.read.parquet(base).columns[0] == "v"


def test_replayed_batches_change_nothing(spark, tmp_dir):
    schema = "og_url string, modified_time_tz timestamp, audit_time string, v string, year string, month string, day string, hour string"
    m = T(2024, 1, 28, 9)
    src, base = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "pub")
    merged = S.BatchLedger(spark, scratch_path(spark, "ledger"), "a")
    for k, v in enumerate(["one", "two"]):
        row = ("u1", m, f"2024-01-28 1{k}:00:00", v, "2024", "01", "28", "10")
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{src}/f={k}")
    stream = (lambda: S.read_stream_files(spark, f"{src}/*", spark.createDataFrame([], schema).schema, max_files=1))
    S.stream_published(stream(), base, scratch_path(spark, "chk"), merged)
    assert [r.v for r in spark.read.parquet(base).collect()] == ["two"]
    assert merged.done(0) and merged.done(1) and not merged.done(2)
    files = sorted(glob.glob(f"{base}/**/*.parquet", recursive=True))
    S.stream_published(stream(), base, scratch_path(spark, "chk"), merged)      # an empty checkpoint: every batch comes again
    assert sorted(glob.glob(f"{base}/**/*.parquet", recursive=True)) == files and not merged.done(2)
    other = S.BatchLedger(spark, merged.folder.rsplit("/", 1)[0], "b")
    assert not other.done(0)


def test_dialect_files(spark, tmp_dir):
    df = spark.createDataFrame([('t^1', 'q"x\nnext \\ line', ["A"], "El País")], "title string, summary string, authors array<string>, source string")
    heads = {}
    for dialect in ("default", "bom"):
        base = os.path.join(tmp_dir, dialect)
        W.write_export(df, base, "2024-01-28 10:00:00", dialect=dialect)
        file, = glob.glob(f"{base}/source_key=*/dt=*/*.csv")
        heads[dialect] = open(file, "rb").read(8)
        back = tables.read_export(spark, base, dialect).first()
        assert (back.title, back.summary) == ("t^1", 'q"x\nnext \\ line')
    assert heads == {"default": b"title^ur", "bom": b"\xef\xbb\xbftitle"}
    day = W.outputs_on(spark, os.path.join(tmp_dir, "bom"), "2024-01-28").collect()
    assert [(r.source_key, r.n_rows, r.n_files) for r in day] == [("el_país", 1, 1)] and day[0].n_bytes > 20


def test_retention_drops_once(spark, tmp_dir):
    base = os.path.join(tmp_dir, "exp")
    df = spark.createDataFrame([("t", "s")], "title string, source string")
    for day in (1, 9, 10):
        W.write_export(df, base, f"2024-01-{day:02d} 10:00:00")
    dry = W.apply_retention(spark, base, "2024-01-10 12:00:00", 7, dry_run=True)
    assert dry == [("s", "2024-01-01")] and tables.read_export(spark, base).count() == 3
    assert W.apply_retention(spark, base, "2024-01-10 12:00:00", 7) == dry
    assert sorted(str(r.dt) for r in tables.read_export(spark, base).collect()) == ["2024-01-09", "2024-01-10"]
    assert W.apply_retention(spark, base, "2024-01-10 12:00:00", 7) == []
    assert W.outputs_on(spark, base, "2024-01-09").first().n_rows == 1


def test_relative_instant(spark):
    got = one_col(spark, ["now", " NOW-1d ", "now+6h", "now-90m", "now-d", "now-1w", "", None, "2024-01-01", "now-1d now"],
                  lambda c: F.date_format(D.relative_instant(c, "2024-01-28 12:00:00"), "dd HH:mm"))
    assert got == ["28 12:00", "27 12:00", "28 18:00", "28 10:30"] + [None] * 6


def test_sitemap_scan(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "s.xml"), "w") as f:
        f.write('<?xml version="1.0"?><urlset xmlns:news="n"><url id="1"><loc> https://a/1 </loc><news:news><news:title>A &amp; B</news:title>'
                "</news:news></url>\n<url>\n<loc>https://a/2</loc><lastmod>2024-01-01</lastmod></url><url><loc>open</urlset>")
    rows = feeds.read_sitemap(spark, tmp_dir).collect()
    assert sorted((r["loc"] or "", r.news_title, r.lastmod) for r in rows)[-2:] == [
        ("https://a/1", "A & B", None), ("https://a/2", None, "2024-01-01")]


def test_author_elements(spark):
    page = ("<a rel=author>by Ana Gil</a><span class='firma'>Comentar aquí</span><p class=\"x byline y\">" + "z" * 101 + "</p>"
            "<div itemprop='author'>Luis <b>Mora</b></div><span class=autor>Publicado</span><span class=autor>Eva Ruiz | ed</span>")
    one = (lambda rule: one_col(spark, [page], lambda c: H.flat_authors(c, rule))[0])
    assert one("el_pais") == ["Ana Gil", "Luis Mora"]
    assert one("okdiario") == ["by Ana Gil", "Comentar aquí", "z" * 101, "Luis Mora", "Eva Ruiz"]
    assert one("el_mundo") == ["by Ana Gil", "Luis Mora"]       # no author classes here
