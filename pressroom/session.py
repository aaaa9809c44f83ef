"""Session helpers: the configuration every job in this package assumes.

The library never creates a session behind the caller's back; ``get_session``
exists for tests, ``bench.py`` and command-line use.  On a cluster the caller
passes its own session and the settings below are only applied where unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on for repeatable results (UTC session clock,
# dynamic partition overwrite, no partition type inference) and for scale
# (AQE coalescing and skew handling).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# The subset of REQUIRED_CONF that results depend on (the rest is performance).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def ensure_semantics(spark: SparkSession) -> None:
    """Apply the settings results depend on to a session created elsewhere (e.g. by a driver)."""
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pressroom") -> SparkSession:
    """Build (or reuse) a session with the package's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if master and master.startswith("local"):
        # local mode: the driver JVM is the executor; its heap is fixed at JVM start
        builder = builder.config("spark.driver.memory", os.environ.get("PRESSROOM_DRIVER_MEMORY", "8g"))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _local_master(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is.
    Only when it is unset on a local master (tests, bench) a folder is created
    for it; elsewhere executors would not see that folder, so it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not _local_master(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="pressroom-chk-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
    except Exception:          # no SparkContext on this client (Spark Connect): the conf is enough
        pass
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder.

    Used to stage intermediate tables (e.g. read-then-overwrite merges) so that
    lineage is cut by a written table that survives executor loss.
    """
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """(FileSystem, Path) of a location, for whatever store it names (a bare path means the default one)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem, so it works for any store."""
    fs, hpath = _hadoop(spark, path)
    return bool(fs.exists(hpath))


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern names, from the store's listing."""
    fs, hpath = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hpath) or [])


def touch_path(spark: SparkSession, path: str) -> None:
    """Create an empty file (and its folder); an existing one stays."""
    fs, hpath = _hadoop(spark, path)
    fs.createNewFile(hpath)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)
