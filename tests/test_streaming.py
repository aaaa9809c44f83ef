"""Streaming: watermarked dedupe/hourly counts equal the batch result; streaming upsert is idempotent."""
import datetime as dt
import os

from pyspark.sql import functions as F

from pressroom.session import scratch_path
from pressroom.sources.tables import read_hours
from pressroom.streaming import streams as S


def _published(spark, rows):
    return spark.createDataFrame(rows, "og_url string, modified_time_tz timestamp, audit_time string, v string, "
                                       "year string, month string, day string, hour string")


def test_stream_matches_batch(spark, tmp_dir):
    ev = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i % 5, i), f"t{i % 3}") for i in range(40)],
                               "id int, ts timestamp_ntz, k string")
    src = os.path.join(tmp_dir, "src")
    ev.write.parquet(src)
    s = S.with_event_time(S.read_stream_files(spark, src, ev.schema), "ts")
    out, chk = scratch_path(spark, "t-h"), scratch_path(spark, "t-h-chk")
    S.run_to_parquet(S.stream_hourly(s, "event_time", "2 hours", "k"), out, chk, "complete")
    got = {(str(r.window_start), r.k): r.n for r in spark.read.parquet(out).collect()}
    want = {(str(r.h), r.k): r.n for r in ev.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h"), "k")
            .count().withColumnRenamed("count", "n").collect()}
    assert got == want
    out2, chk2 = scratch_path(spark, "t-d"), scratch_path(spark, "t-d-chk")
    S.run_to_parquet(S.stream_curated(s, "k", "event_time", "2 hours").select("k"), out2, chk2, "append")
    assert sorted(r.k for r in spark.read.parquet(out2).collect()) == ["t0", "t1", "t2"]


def test_stream_published_upsert(spark, tmp_dir):
    base = os.path.join(tmp_dir, "pub")
    m = dt.datetime(2024, 1, 28, 9)
    first = _published(spark, [("u1", m, "2024-01-28 10:00:00", "old", "2024", "01", "28", "10")])
    src = os.path.join(tmp_dir, "new")
    first.write.parquet(src)
    stream = spark.readStream.schema(first.schema).parquet(src)
    chk = scratch_path(spark, "pub-chk")
    S.stream_published(stream, base, chk)
    newer = _published(spark, [("u1", m, "2024-01-28 11:00:00", "new", "2024", "01", "28", "10")])
    newer.write.mode("append").parquet(src)
    S.stream_published(stream, base, chk)
    rows = spark.read.parquet(base).collect()
    assert [(r.og_url, r.v) for r in rows] == [("u1", "new")]
    hist = read_hours(spark, base, "2024-01-28 12:00:00", 6, first.drop("year", "month", "day", "hour").schema)
    assert hist.count() == 1
    assert read_hours(spark, base, "2024-01-29 12:00:00", 6, first.drop("year", "month", "day", "hour").schema).count() == 0


def test_late_rows_and_append_mode(spark, tmp_dir):
    """STM4: in append mode only windows closed by the watermark are emitted; a row later than
    the delay is not counted once its window is closed (complete mode would keep every group)."""
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 10), "a"), (2, dt.datetime(2024, 1, 1, 5, 0), "a")],
                                  "id int, ts timestamp_ntz, k string")
    src = os.path.join(tmp_dir, "late")
    first.write.parquet(src + "/b1")
    s = S.with_event_time(S.read_stream_files(spark, src + "/*", first.schema, max_files=1), "ts")
    out, chk = scratch_path(spark, "late-h"), scratch_path(spark, "late-h-chk")
    agg = S.stream_hourly(s, "event_time", "1 hour", "k")
    S.run_to_parquet(agg, out, chk, "append")
    late = spark.createDataFrame([(3, dt.datetime(2024, 1, 1, 0, 20), "a"), (4, dt.datetime(2024, 1, 1, 6, 30), "a")],
                                 "id int, ts timestamp_ntz, k string")
    late.write.parquet(src + "/b2")
    S.run_to_parquet(agg, out, chk, "append")
    got = {(str(r.window_start), r.n) for r in spark.read.parquet(out).collect()}
    assert ("2024-01-01 00:00:00", 1) in got                     # the 00:20 row arrived after 00:00 closed
    assert all(not w.startswith("2024-01-01 06") for w, _ in got)  # 06:00 is still open
