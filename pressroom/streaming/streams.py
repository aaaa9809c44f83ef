"""Structured Streaming versions of the hourly job (STM2-STM4).

The reference's "hour partition + N hours of look-back" is an event-time
watermark: rows later than the delay are not waited for.  Every stream here
runs with ``trigger(availableNow=True)`` so a scheduled run processes what has
landed and stops; state and progress live in the checkpoint folder, so a lost
executor or a restarted run resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import to_instant
from ..session import path_exists, touch_path

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, incremental checkpoints) instead of the JVM heap.

    Deduplication and window state grow with the number of keys; at cluster scale this is the
    provider to use.  It must be set before a query first starts on a checkpoint.  It is not the
    default here because its native start-up dominates the small local runs.
    """
    spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """``use_rocksdb_state`` for the streams started inside; the session's own setting comes back."""
    before = spark.conf.get(STATE_PROVIDER, None)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


def read_stream_files(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None,
                      fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """File source with an explicit schema; ``glob`` picks files of a folder (e.g. one table)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def with_event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Event time as ``timestamp`` (a watermark on ``timestamp_ntz`` is rejected)."""
    return df.withColumn(out, to_instant(ts))


def stream_curated(df: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """STM2: drop repeated keys within the watermark delay (streaming dedupe)."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_hours(df: DataFrame, keys: list[str], event_time: str, delay: str, hour: str = "hour") -> DataFrame:
    """STM2 by hour partition: one row per ``keys`` and event hour, over any number of micro-batches.

    The hour is the watermark column and part of the key, so state lives exactly as long as its hour
    can still get rows: a repeat is dropped by its state or, later, by the watermark, and a row later
    than ``delay`` is dropped. What comes out doesn't depend on how rows are dealt to batches, as
    long as no row comes late.
    """
    return (df.withColumn(hour, F.date_trunc("hour", event_time)).withWatermark(hour, delay)
            .dropDuplicates([*keys, hour]))


def stream_hourly(df: DataFrame, event_time: str, delay: str, by: str) -> DataFrame:
    """STM4: rows per (1-hour tumbling window, group) accepting late rows up to ``delay``."""
    agg = (df.withWatermark(event_time, delay)
           .groupBy(F.window(event_time, "1 hour").alias("w"), F.col(by))
           .agg(F.count(F.lit(1)).alias("n")))
    return agg.select(F.col("w.start").alias("window_start"), by, "n")


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream to completion of the available input, writing Parquet.

    append   -> file sink (exactly-once through the sink's metadata log)
    complete -> foreachBatch that overwrites ``out`` with the full result of each batch
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").outputMode("append").start(out)
    else:
        def sink(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(out)
        q = w.outputMode(mode).foreachBatch(sink).start()
    q.awaitTermination()


def run_counts(df: DataFrame, out: str, checkpoint: str, by: str) -> None:
    """Run a windowed count in update mode: a micro-batch carries only the counts that changed.

    They replace their (window_start, ``by``) rows in the days they touch; other days are not read
    or written. The watermark drops late rows and old state, so state is bounded by the delay.
    """
    from ..session import drop_path, scratch_path

    def sink(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
        both = new
        if path_exists(spark, out):
            old = spark.read.schema(new.schema).parquet(out).join(new.select("day").distinct(), "day", "left_semi")
            both = new.unionByName(old.join(new.select("window_start", by), ["window_start", by], "left_anti"))
        staged = scratch_path(spark, "counts")            # a dataset is not overwritten while it is read
        both.write.parquet(staged)
        (spark.read.schema(new.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(out))
        drop_path(spark, staged)
    q = (df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("update")
         .foreachBatch(sink).start())
    q.awaitTermination()


class BatchLedger:
    """The batches of one stream that have been merged: an empty file per batch under a shared folder.

    A batch is marked after its merge. A batch that comes again (a restart before the checkpoint was
    written, a replay from an older checkpoint) is known by its id and changes nothing; one that was merged
    but not yet marked is merged again, which the merge allows. Batches may come in any order.
    """

    def __init__(self, spark: SparkSession, folder: str, stream: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/{stream}"

    def done(self, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self.folder}/{batch_id}")

    def mark(self, batch_id: int) -> None:
        touch_path(self.spark, f"{self.folder}/{batch_id}")


def stream_published(new_stream: DataFrame, base: str, checkpoint: str, ledger: BatchLedger | None = None) -> None:
    """STM3: streaming upsert of the latest version: each micro-batch runs the batch merge (WIN3),
    which is idempotent (dynamic partition overwrite). With a ledger a replayed batch isn't merged again."""
    from ..plans.medallion import merge_published_into

    def sink(batch: DataFrame, batch_id: int) -> None:
        if ledger is not None and ledger.done(batch_id):
            return
        merge_published_into(batch, base)
        if ledger is not None:
            ledger.mark(batch_id)
    q = (new_stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(sink).start())
    q.awaitTermination()
