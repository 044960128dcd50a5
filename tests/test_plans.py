"""Plan shapes: pushdown, column pruning, group limits, no Python and no gathering where none is needed."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import joins
from tidemark.plans.skew import broadcast_if_small, hot_keys, salted_join

QUERIES = entry.queries()

# Queries whose point is Python: user functions, model scoring, greedy chains.
PYTHON = {"udf_scalar", "udtf_json_rows", "batch_score", "rising_trend_alert", "delta_trigger_max", "sink_batched"}


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["filter_behavior"](spark, sf_dir))
    assert re.search(r"PushedFilters: .*EqualTo\(event_type,view\)", text)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text
    hot = plan(QUERIES["hot_items_topn"](spark, sf_dir))
    assert "EqualTo(event_type,view)" in hot
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>", hot)


@pytest.mark.parametrize("name", ["hot_items_topn", "window_group_topn", "global_group_topn", "blacklist_filter"])
def test_rankings_limit_groups_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sort_limit_is_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["sort_limit"](spark, sf_dir), "simple")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in (
    "hot", "pv", "window", "uv", "pattern", "login", "blacklist", "order", "interval", "asof", "lookup", "dim", "offline"
) and not n.endswith("_stream")))
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    if name in PYTHON:
        pytest.skip("Python by design")
    text = plan(QUERIES[name](spark, sf_dir), "simple")
    for bad in ("Python", "ArrowEval", "CartesianProduct"):
        assert bad not in text


def test_interval_join_uses_time_slots_as_key(spark, sf_dir):
    text = plan(QUERIES["interval_join"](spark, sf_dir), "simple")
    join = next(line for line in text.splitlines() if "Join [" in line)
    assert "user_id" in join and "_slot" in join


def test_broadcast_is_measured(spark):
    small = spark.range(10)
    assert "broadcast" in plan(broadcast_if_small(small, 10), "extended").lower()
    assert "broadcast" not in plan(broadcast_if_small(small, 9), "extended").lower()
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 100).alias("s"))
    assert "broadcast" not in plan(broadcast_if_small(wide, 10, 500), "extended").lower()


def test_salted_join_equals_join_and_finds_hot_keys(spark):
    fact = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    assert [r["k"] for r in hot_keys(fact, ["k"], 0.2).collect()] == [7]
    for how in ("inner", "left"):
        plain_rows = fact.join(dim, "k", how).select("k", "id", "d").collect()
        salted = salted_join(fact, dim, ["k"], how, salts=4, share=0.2).select("k", "id", "d").collect()
        key = lambda r: (r["id"], r["k"], r["d"] or -1)
        assert sorted(plain_rows, key=key) == sorted(salted, key=key)


def test_interval_bounds_are_inclusive(spark):
    at = lambda s: F.timestamp_seconds(F.lit(s))
    left = spark.range(1).select(F.lit(1).alias("k"), at(100).alias("lt"))
    right = spark.createDataFrame([(1, s) for s in (94, 95, 100, 105, 106)], "k int, s long").select(
        "k", F.timestamp_seconds("s").alias("rt"), "s")
    got = joins.interval_join(left, right, ["k"], "lt", "rt", "-5 seconds", "5 seconds")
    assert sorted(r["s"] for r in got.collect()) == [95, 100, 105]
