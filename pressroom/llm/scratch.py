"""Tables written between the steps of an operator.

An iterative operator cuts its lineage by writing a step's rows as Parquet under the
folder that ``spark.checkpoint.dir`` names and reading them back: the rows survive the
loss of an executor, and the next step plans with the table's real size.
"""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession

from pressroom.session import drop_path, scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list[tuple[SparkSession, str]] = []


@atexit.register
def _drop_open() -> None:
    for spark, path in _open:
        with contextlib.suppress(Exception):      # the session has ended: the folder's owner clears it
            drop_path(spark, path)


class Scratch:
    """Staged tables of one operator call.

    ``save`` writes and rereads; ``drop`` deletes a table that no later step reads. What the
    operator's lazy result still reads stays until the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n, self.paths = spark, scratch_path(spark, name), 0, {}

    def save(self, df: DataFrame, free: bool = False) -> DataFrame:
        """``free``: the job's shuffle files go when it ends, so disks hold one step's at a time."""
        self.n += 1
        path = f"{self.base}-{self.n}"
        _open.append((self.spark, path))
        before = self.spark.conf.get(_CLEANUP, "false")
        try:
            if free:
                self.spark.conf.set(_CLEANUP, "true")
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if free:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            _, path = self.paths.pop(id(df))
            drop_path(self.spark, path)
            _open.remove((self.spark, path))
