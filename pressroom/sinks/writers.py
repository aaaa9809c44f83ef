"""Sinks (SNK1-SNK7): hour-partitioned Parquet, rejects, latest HTML, '^' exports,
retention and the outputs-of-the-day report.

All writes are partitioned and, where they replace data, use dynamic partition
overwrite: only the partitions present in the written DataFrame are replaced,
so a rerun of the same hour/day is idempotent and other partitions are kept.
Before writing, rows are clustered by the partition columns so each task writes
few files per partition (no small-file explosion at scale).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_of_lit
from ..functions.urls import source_key
from ..schemas import EXPORT_COLUMNS
from ..session import drop_path, list_paths

HOUR_PARTS = ["year", "month", "day", "hour"]


def _clustered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Cluster rows by the output partition columns before writing.

    ``rebalance`` (not ``repartition``): rows of one partition value go to the
    same task so few files are written per partition, and AQE splits a
    partition value that holds a large share of the rows (a hot source or hour)
    across several tasks instead of writing it from one.
    """
    return df.hint("rebalance", *parts)


def write_hours(df: DataFrame, base: str, parts: Sequence[str] = HOUR_PARTS) -> None:
    """SNK1: Parquet partitioned by year/month/day/hour; replaces only the touched hours."""
    (_clustered(df, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(base))


def write_rejects(df: DataFrame, base: str, parts: Sequence[str] = HOUR_PARTS) -> None:
    """SNK2: append rejected rows (error payloads) to the errors dataset."""
    _clustered(df, parts).write.mode("append").partitionBy(*parts).parquet(base)


def write_latest_html(df: DataFrame, base: str, key: str = "og_url",
                      order: Sequence = ("modified_time_tz", "published_time_tz")) -> None:
    """SNK3: the latest HTML per URL (WIN1), hour-partitioned."""
    from ..operators.dedupe import full_order, latest_by
    cols = [*HOUR_PARTS, key, "html", *order]
    slim = df.select(*cols)
    ordc = F.coalesce(*[F.col(o) for o in order])
    slim = slim.withColumn("_eff", ordc)
    latest = latest_by(slim, key, full_order(slim, ["_eff"], exclude=[key])).drop("_eff", *order)
    write_hours(latest, base)


# Export dialects (SNK4): columns, list joining, quoting and escaping of each variant.
FLAT_PREFERRED = ["title", "url", "publish_date", "authors", "summary", "text", "keywords", "images", "html"]
SEMICOLON_COLUMNS = ["title", "url", "publish_date", "authors", "section", "subsection", "text"]
DIALECTS = {
    "default": dict(columns=EXPORT_COLUMNS, list_sep=", ", escape='"', quote='"'),
    "bom": dict(columns=EXPORT_COLUMNS, list_sep=", ", escape='"', quote='"', defaults=True, bom=True),
    "append": dict(columns=EXPORT_COLUMNS, list_sep=", ", escape="\\", quote='"', normalize=True),  # B13
    "flat": dict(columns=None, list_sep=", ", escape="\\", quote="", html_cut=1000),
    "semicolon": dict(columns=SEMICOLON_COLUMNS, list_sep="; ", escape='"', quote='"'),
}


def _flat_value(c: Column, dtype, name: str, cut: int) -> Column:
    """flat: lists joined ', ' of cleaned items, scalars cleaned (STR2), html cut, then no
    newline, carriage return or '^' left."""
    from pyspark.sql import types as T
    from ..functions.text import csv_flat
    if isinstance(dtype, T.ArrayType):
        v = F.array_join(F.transform(c.cast("array<string>"), lambda x: csv_flat(x)), ", ")
    else:
        v = csv_flat(c.cast("string"))
    if name == "html":
        v = F.when(F.length(v) > cut, F.concat(F.substring(v, 1, cut), F.lit("... [TRUNCATED]"))).otherwise(v)
    v = F.replace(F.replace(F.replace(v, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")), F.lit("^"), F.lit(" "))
    return F.coalesce(v, F.lit(""))


def export_frame(df: DataFrame, as_of, dialect: str = "default", site: str = "source") -> DataFrame:
    """SNK4/SNK5 projection of one dialect plus the partition keys (source_key, dt)."""
    from ..functions.text import clean_text
    from ..operators.records import to_export
    d = DIALECTS[dialect]
    keys = {"source_key": source_key(F.col(site) if site in df.columns else F.lit("")),
            "dt": F.to_date(as_of_lit(as_of))}
    if dialect == "flat":
        cols = [c for c in FLAT_PREFERRED if c in df.columns] + sorted(c for c in df.columns if c not in FLAT_PREFERRED)
        vals = [_flat_value(F.col(c), df.schema[c].dataType, c, d["html_cut"]).alias(c) for c in cols]
        return df.select(*vals, *[v.alias(k) for k, v in keys.items()])
    if dialect == "semicolon":
        out = []
        for c in d["columns"]:
            if c == "authors" and c in df.columns:
                a = F.col(c)
                v = F.array_join(a, "; ") if df.schema[c].dataType.simpleString().startswith("array") else a
            elif c in df.columns:
                v = clean_text(F.col(c).cast("string"))
            else:
                v = F.lit("")
            out.append(F.coalesce(v, F.lit("")).alias(c))
        return df.select(*out, *[v.alias(k) for k, v in keys.items()])
    defaults = dict(as_of=as_of, default_authors="Redacción") if d.get("defaults") else {}
    if d.get("normalize"):
        # B13: the normalised record (STR3 on every string and every list item) is what is written
        from pyspark.sql import types as T
        from ..functions.text import normalize_text
        norm = {}
        for f in df.schema.fields:
            if f.name in EXPORT_COLUMNS and isinstance(f.dataType, T.StringType):
                norm[f.name] = F.when(F.col(f.name).isNotNull(), normalize_text(F.col(f.name)))
            elif f.name in EXPORT_COLUMNS and f.dataType.simpleString() == "array<string>":
                norm[f.name] = F.transform(f.name, lambda x: F.when(x.isNotNull(), normalize_text(x)))
        df = df.withColumns(norm)
    with_site = df.withColumn("_site", F.col(site) if site in df.columns else F.lit(""))
    out = to_export(with_site, list_sep=d["list_sep"], keep=["_site"], **defaults)
    return out.withColumns({"source_key": source_key(F.col("_site")), "dt": keys["dt"]}).drop("_site")


BOM = "\ufeff"
#: Rows of each (dt, source_key) of an export, written beside it; readers of the export skip the folder.
COUNTS = "_counts"


def write_export(df: DataFrame, base: str, as_of, dialect: str = "default", site: str = "source") -> None:
    """SNK4: one '^'-separated export per (source_key, dt); a rerun replaces that day only.

    Every file starts with the header. The ``bom`` dialect puts the byte-order mark before the header's first name,
    so it is the first thing in each file. The rows of each part are counted into ``COUNTS``, from the
    key columns alone.
    """
    d = DIALECTS[dialect]
    out = export_frame(df, as_of, dialect, site)
    counts = out.groupBy("dt", "source_key").agg(F.count(F.lit(1)).alias("n_rows"))
    if d.get("bom"):
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    (_clustered(out, ["source_key", "dt"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source_key", "dt")
     .option("sep", "^").option("header", True).option("quote", d["quote"]).option("escape", d["escape"])
     .option("quoteAll", False).option("escapeQuotes", d["quote"] != "")
     .option("emptyValue", "").option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base))
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "source_key")
     .parquet(f"{base.rstrip('/')}/{COUNTS}"))


def retention_filter(dt_col: Column, as_of, days: int = 7) -> Column:
    """SNK6: rows to keep: partition date within the last ``days`` days of as_of."""
    return dt_col >= F.date_sub(F.to_date(as_of_lit(as_of)), days)


def partitions_to_drop(spark: SparkSession, base: str, as_of, days: int = 7) -> DataFrame:
    """SNK6: the (source_key, dt) partitions older than the retention window (partition listing only)."""
    rows = [(p[-2].split("=", 1)[1], p[-1].split("=", 1)[1]) for p in
            (path.split("/") for path in list_paths(spark, f"{base.rstrip('/')}/source_key=*/dt=*"))]
    df = spark.createDataFrame(rows, "source_key string, dt string")
    return df.select("source_key", F.col("dt").cast("date").alias("dt")).filter(~retention_filter(F.col("dt"), as_of, days))


def apply_retention(spark: SparkSession, base: str, as_of, days: int = 7, dry_run: bool = False) -> list[tuple[str, str]]:
    """SNK6: drop the (source_key, dt) partitions older than the retention window, their counts too.

    Returns the dropped partitions; with ``dry_run`` the list alone. Partitions are folders, so nothing
    is read or rewritten; a rerun finds nothing left to drop.
    """
    old = sorted((r.source_key, str(r.dt)) for r in partitions_to_drop(spark, base, as_of, days).collect())
    if not dry_run:
        root = base.rstrip("/")
        for key, dt in old:
            drop_path(spark, f"{root}/source_key={key}/dt={dt}")
            drop_path(spark, f"{root}/{COUNTS}/dt={dt}/source_key={key}")
    return old


def outputs_on(spark: SparkSession, base: str, date: str) -> DataFrame:
    """SNK7: rows, files and bytes written per source on a day.

    Rows come from the counts beside the export, files and bytes from the listing of the day's
    folders: no export file is opened.
    """
    root = base.rstrip("/")
    files = spark.read.format("binaryFile").load(f"{root}/source_key=*/dt={date}").select("path", "length")
    by_source = files.groupBy(F.regexp_extract("path", "/source_key=([^/]*)/", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    rows = spark.read.schema("n_rows long, dt string, source_key string").parquet(f"{root}/{COUNTS}").filter(F.col("dt") == date)
    return rows.join(by_source.withColumn("source_key", F.url_decode(F.replace("folder", F.lit("+"), F.lit("%2B")))), "source_key") \
        .select("source_key", "n_rows", "n_files", "n_bytes")
