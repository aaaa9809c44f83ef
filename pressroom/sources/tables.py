"""Table sources: hour-partitioned history, pages, exports (SRC10-SRC12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.recency import in_hour_window
from ..schemas import ARTICLE_EXPORT, PAGES
from ..session import path_exists

HOUR_FIELDS = [T.StructField(p, T.StringType()) for p in ("year", "month", "day", "hour")]


def read_hours(spark: SparkSession, base: str, as_of, delay_hours: int, schema: T.StructType) -> DataFrame:
    """SRC10: history rows of the run window; an absent dataset reads as empty.

    The window is a predicate on the partition columns, so Spark lists the
    directories and reads only the matching hours (``PartitionFilters``).
    """
    names = {f.name for f in schema.fields}
    full = T.StructType(list(schema.fields) + [f for f in HOUR_FIELDS if f.name not in names])
    if not path_exists(spark, base):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(base)
    return df.filter(in_hour_window(as_of, delay_hours))


def read_touched_hours(spark: SparkSession, base: str, hours: Sequence[tuple[str, ...]], columns: Sequence[str],
                       drift: str = "refuse") -> DataFrame | None:
    """PRJ16: the stored rows of some (year, month, day, hour) partitions, their file schemas compared first.

    The schemas in all files of these hours are merged by a Spark job that reads footers only.
    ``refuse``: a merged schema with other columns than ``columns`` is a ValueError that names them.
    ``widen``: the result has the stored columns and ``columns``; an hour without one gives nulls, a column of two types
    that don't merge is an error. Hours that aren't stored are left out; without any the result is None.
    """
    root, parts = base.rstrip("/"), [k.name for k in HOUR_FIELDS]
    stored = [path for h in sorted(set(hours))
              if path_exists(spark, path := root + "".join(f"/{k}={v}" for k, v in zip(parts, h)))]
    if not stored:
        return None
    if drift not in ("refuse", "widen"):
        raise ValueError(f"unknown drift {drift!r}; expected refuse or widen")
    fields = [f for f in spark.read.option("mergeSchema", True).parquet(*stored).schema.fields if f.name not in parts]
    found, wanted = {f.name for f in fields}, set(columns)
    if drift == "refuse" and found != wanted:
        raise ValueError(f"column sets differ: only new {sorted(wanted - found)}, only stored {sorted(found - wanted)}")
    out = spark.read.schema(T.StructType([*fields, *HOUR_FIELDS])).option("basePath", root).parquet(*stored)
    return out.withColumns({c: F.lit(None).cast("string") for c in columns if c not in found})


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: fetched pages (stand-in for downloads)."""
    df = spark.read.parquet(path)
    return df if "fetched_at" in df.columns else df.select(*[f.name for f in PAGES.fields])


def read_export(spark: SparkSession, path: str, dialect: str = "default", columns: Sequence[str] | None = None) -> DataFrame:
    """SRC12: '^'-separated exports of a dialect read back, every column a string (``columns``: where the dialect has no
    fixed ones)."""
    from ..sinks.writers import DIALECTS
    d = DIALECTS[dialect]
    names = list(columns or d["columns"] or ARTICLE_EXPORT.fieldNames())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return (spark.read.schema(schema).option("sep", "^").option("quote", d["quote"]).option("escape", d["escape"])
            .option("multiLine", d["quote"] != "").option("header", True).csv(path))
