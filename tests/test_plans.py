"""Scale properties of the physical plans, asserted on the driver tables."""
import __spark_entry__ as E
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pressroom.operators import dedupe


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen_is_partially_aggregated(spark):
    p = _plan(E.queries()["latest_per_key"](spark, SF_SMALL))
    assert "partial_max_by" in p                      # hot keys reduced map-side before the shuffle
    assert "Window" not in p


def test_caps_limit_before_shuffle(spark):
    p = _plan(E.queries()["cap_per_source"](spark, SF_SMALL))
    i, j = p.find("WindowGroupLimit"), p.rfind("WindowGroupLimit")
    assert i != -1 and i != j and "Partial" in p and "Final" in p


def test_page_attach_does_not_shuffle_pages_for_the_join(spark):
    p = _plan(E.queries()["page_attach"](spark, SF_SMALL))
    assert "LeftSemi" in p and "BroadcastExchange" in p


def test_pushdown_and_pruning(spark):
    p = _plan(E.queries()["hour_window"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p
    p2 = _plan(E.queries()["url_sections_base"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p2      # no html read


def test_partitioned_writes_rebalance(spark):
    from pressroom.sinks.writers import _clustered
    df = spark.range(10).select(F.lit("2024").alias("year"), F.col("id").cast("string").alias("hour"))
    assert "RebalancePartitions" in _clustered(df, ["year", "hour"])._jdf.queryExecution().optimizedPlan().toString()


def test_merge_is_aggregation_not_sort_of_hot_key(spark):
    df = spark.createDataFrame([("hot", i, i) for i in range(50)] + [("cold", 1, 1)], "k string, o int, v int")
    p = _plan(dedupe.latest_by(df, "k", ["o"]))
    assert "partial_max_by" in p
