"""Recency rules, dedupe/latest, caps and joins on small hand-checked inputs."""
import datetime as dt

from pyspark.sql import functions as F

from pressroom.operators import dedupe, enrich, limits, recency

AS_OF = "2024-01-28 13:45:00"
TS = [dt.datetime(2024, 1, 25, 0, 0), dt.datetime(2024, 1, 24, 23, 59), dt.datetime(2024, 1, 25, 13, 45),
      dt.datetime(2024, 1, 25, 13, 44), dt.datetime(2024, 2, 1), None]


def _flags(spark, rule, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TS)], "i int, t timestamp")
    return [r.k for r in df.select("i", recency.is_recent(F.col("t"), AS_OF, 3, rule, **kw).alias("k"))
            .orderBy("i").collect()]


def test_recency_rules(spark):
    assert _flags(spark, "midnight") == [True, False, True, True, True, True]
    assert _flags(spark, "age") == [False, False, True, False, True, False]
    assert _flags(spark, "calendar") == [True, False, True, True, True, False]
    assert _flags(spark, "age_or_now") == [False, False, True, False, True, True]
    # floor((as_of - ts)/1d) <= 3 keeps up to 4 days minus a tick
    assert _flags(spark, "days_floor") == [True, True, True, True, True, True]
    assert _flags(spark, "days_floor", keep_unknown=False)[-1] is False


def test_lastmod_or_url(spark):
    df = spark.createDataFrame([("2024-01-27", "https://x/2020/01/01/a"), ("garbage", "https://x/2024/01/28/a"),
                                (None, "https://x/2024/01/28/a"), ("", "https://x/nodate")], "l string, u string")
    r = df.select(recency.is_recent(F.col("l"), AS_OF, 3, "lastmod_or_url", url=F.col("u")).alias("k")).collect()
    assert [x.k for x in r] == [True, False, True, False]


def test_hour_window_and_today(spark):
    df = spark.createDataFrame([("2024", "01", "28", "13"), ("2024", "01", "27", "07"), ("2024", "01", "27", "06"),
                                ("2024", "01", "28", "14")], "year string, month string, day string, hour string")
    got = recency.hour_window(df, "2024-01-28 13:00:00", 30).collect()
    assert sorted(r.hour for r in got) == ["07", "13"]


def test_first_seen_latest_and_ties(spark):
    df = spark.createDataFrame([("u1", 2, "b", 5), ("u1", 1, "a", 5), ("u2", 3, "c", None), ("u2", 4, "d", 1),
                                ("u3", 5, "e", 7), ("u3", 6, "f", 7)], "url string, ord int, v string, t int")
    fs = {r.url: r.v for r in dedupe.first_seen(df, "url", ["ord"]).collect()}
    assert fs == {"u1": "a", "u2": "c", "u3": "e"}
    lt = {r.url: r.v for r in dedupe.latest_by(df, "url", ["t", "ord"]).collect()}
    assert lt == {"u1": "b", "u2": "d", "u3": "f"}


def test_ci_distinct_and_distinct_authors(spark):
    df = spark.createDataFrame([(["Ana", "ANA", "Luis", "ana", "Luis"], ["Zoe", "", None])], "a array<string>, b array<string>")
    r = df.select(dedupe.ci_distinct("a").alias("x"), dedupe.distinct_authors("a", "b").alias("y")).first()
    assert r.x == ["Ana", "Luis"]
    assert r.y == ["ANA", "Ana", "Luis", "Zoe", "ana"]


def test_merge_idempotent(spark):
    old = spark.createDataFrame([("u", 1, "2024-01-01"), ("v", 1, "2024-01-01")], "k string, m int, audit string")
    new = spark.createDataFrame([("u", 1, "2024-01-02"), ("w", 2, "2024-01-02")], "k string, m int, audit string")
    once = dedupe.merge_latest(new, old, ["k", "m"], ["audit"])
    twice = dedupe.merge_latest(new, once, ["k", "m"], ["audit"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.audit for r in once.collect()} == {"u": "2024-01-02", "v": "2024-01-01", "w": "2024-01-02"}
    d1 = dedupe.merge_distinct(new, old)
    assert sorted(dedupe.merge_distinct(new, d1).collect()) == sorted(d1.collect())


def test_caps_and_priority(spark):
    df = spark.createDataFrame([("s", f, i, f"u{f}{i}") for f in range(2) for i in range(3)] + [("t", 0, 0, "x")],
                               "site string, feed_ord int, item_ord int, url string")
    got = limits.cap_sequential(df, "site", 4, valid=F.col("url") != "u01").collect()
    assert sorted(r.url for r in got if r.site == "s") == ["u00", "u02", "u10", "u11"]
    assert [r.url for r in limits.head_of_each(df, "item_ord", 1).filter("site='s'").orderBy("feed_ord").collect()] \
        == ["u00", "u10"]
    plan = limits.cap_per(df, "site", 2, ["feed_ord", "item_ord"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_joins(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "", "x"), (3, "c", "y")], "k int, t string, s string")
    right = spark.createDataFrame([(1, "A", None), (2, "B", "Z"), (2, "B2", "Z2")], "k int, t string, s string")
    r_all = {r.k: (r.t, r.s) for r in enrich.overlay(left, right, "k", ["t", "s"], "all", right_order=["t"]).collect()}
    assert r_all == {1: ("A", None), 2: ("B", "Z"), 3: ("c", "y")}
    r_nn = {r.k: (r.t, r.s) for r in enrich.overlay(left, right, "k", ["t", "s"], "nonnull", right_order=["t"]).collect()}
    assert r_nn == {1: ("A", None), 2: ("B", "Z"), 3: ("c", "y")}
    fm = {r.k: r.t for r in enrich.fill_missing(left, right.dropDuplicates(["k"]).filter("t != 'B2'"), "k", ["t"]).collect()}
    assert fm == {1: "a", 2: "B", 3: "c"}
    urls = spark.createDataFrame([("u1", "old"), ("u2", "keep")], "url string, title string")
    entries = spark.createDataFrame([("u1", 0, 1, "first", None, None), ("u1", 0, 0, "zero", None, None)],
                                    "url string, feed_ord int, item_ord int, title string, publish_date string, summary string")
    ef = {r.url: r.title for r in enrich.enrich_from_feed(urls, entries).collect()}
    assert ef == {"u1": "zero", "u2": "keep"}
    prim = spark.createDataFrame([(1, "s"), (5, "s")], "id int, site string")
    fb = spark.createDataFrame([(1, "s"), (2, "s"), (3, "s")], "id int, site string")
    assert sorted(r.id for r in enrich.top_up(prim, fb, "id", "site", 3, ["id"]).collect()) == [1, 2, 5]
    sites = spark.createDataFrame([("El País",), ("ABC",)], "name string")
    found, unknown = enrich.select_sites(sites, spark.createDataFrame([("el país",), ("nope",)], "name string"))
    assert [r.name for r in found.collect()] == ["El País"] and [r.name for r in unknown.collect()] == ["nope"]


def test_full_order_tie_break(spark):
    df = spark.createDataFrame([("k", "a1", "x", {"m": "1"}), ("k", "a1", "y", {"m": "2"})],
                               "k string, audit string, v string, props map<string,string>")
    order = dedupe.full_order(df, ["audit"], exclude=["k"])
    assert [str(o) for o in order[1:]] == [str(F.col("`v`"))]          # map column is not orderable
    for _ in range(3):
        assert dedupe.latest_by(df.repartition(2), "k", order).first().v == "y"
