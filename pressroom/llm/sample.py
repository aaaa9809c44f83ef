"""A bounded, repeatable sample of rows to train on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressroom.llm.names import unused
from pressroom.llm.scratch import Scratch


def smallest(df: DataFrame, n: int, per: str | None = None) -> DataFrame:
    """At most ``n`` distinct rows (of each value of ``per``): the ones with the smallest hash of their values.

    The hashes alone are ranked, so what a task receives doesn't grow with the texts; the rows
    are fetched by the n hashes, whose number bounds the broadcast.
    """
    scratch, (key,) = Scratch(df.sparkSession, "sample"), unused(df, "_key")
    keyed = df.withColumn(key, F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))
    if per is None:
        chosen = keyed.select(key).orderBy(key).limit(n)
    else:
        rank = F.row_number().over(Window.partitionBy(per).orderBy(key))
        chosen = keyed.select(per, key).withColumn("_rank", rank).filter(F.col("_rank") <= n).select(key)
    chosen = scratch.save(chosen.distinct())
    return keyed.join(F.broadcast(chosen), key, "left_semi").dropDuplicates([key]).drop(key)
