import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as a
from tidemark.operators.joins import lookup_fresh
from tidemark.operators.models import iterate_frontier
from tidemark.session import scratch_dir
from tidemark.sinks.upsert import KeyedTable

DDL = "k long, name string, version long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts_replace_their_keys_and_replays_change_nothing(spark):
    table = KeyedTable(spark, scratch_dir(spark, "t-upsert"), DDL, ["k"], "version", buckets=3)
    assert rows(table.read()) == []
    rng, state = random.Random(3), {}
    batches = []
    for batch in range(4):
        own = [(rng.choice([None, *range(9)]), f"b{batch}-{n}", rng.randint(0, 5)) for n in range(6)]
        batches.append(own)
        table.upsert(spark.createDataFrame(own, DDL), batch)
        for k, name, version in sorted(own, key=lambda r: (r[2], r[1])):
            if k not in state or version >= state[k][0]:
                state[k] = (version, name)
        want = sorted([(k, name, version) for k, (version, name) in state.items()], key=str)
        assert rows(table.read()) == want
        table.upsert(spark.createDataFrame(own, DDL), batch)
        assert rows(table.read()) == want
    table.upsert(spark.createDataFrame([], DDL), 9)
    assert rows(table.read()) == want


def test_an_unfinished_version_is_not_read(spark):
    path = scratch_dir(spark, "t-unfinished")
    table = KeyedTable(spark, path, DDL, ["k"], "version", buckets=2)
    table.upsert(spark.createDataFrame([(1, "a", 1)], DDL), 0)
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=1/_bucket=0")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(root)
    assert rows(table.read()) == [(1, "a", 1)]


def test_frontier_reports_every_row(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, 1), (4, 300)], "id long, x long")
    out = iterate_frontier(df, lambda r: r.withColumn("x", F.col("x") * 2), ["x"], F.col("x") < 100, 6)
    assert sorted(tuple(r) for r in out.select("id", "x", "outcome", "rounds").collect()) == [
        (1, 160, "done", 5), (2, 0, "fixed", 1), (3, 64, "open", 6), (4, 600, "done", 1)]
    assert iterate_frontier(df.limit(0), lambda r: r, ["x"], F.lit(True), 3).collect() == []


@pytest.mark.parametrize("shift,within", [(0, True), (400, False)])
def test_quantile_check_tells_good_from_bad(spark, shift, within):
    values = spark.range(1000).select(F.lit("d").alias("day"), F.col("id").alias("v"))
    estimates = spark.createDataFrame([("d", 1000, 500 + shift)], "day string, n long, p50 long")
    got = a.quantiles_checked(values, estimates, ["day"], "v", {"p50": 0.5}).first()
    assert (got.n, got.p50_within) == (1000, within)


def test_lookup_takes_nothing_too_old(spark):
    fact = spark.createDataFrame([(1, 10, 1), (1, 21, 2), (1, 60, 3), (2, 5, 4), (None, 12, 5)], "k long, pos long, id long")
    history = spark.createDataFrame([(1, 10, "a", 0), (1, 20, "b", 0), (2, 6, "c", 0), (None, 11, None, 0)],
                                    "k long, valid long, name string, id long")
    got = lookup_fresh(fact, history, ["k"], ["pos", "id"], "valid", ["name"], 30)
    assert sorted((r.id, r.name, r.lookup) for r in got.collect()) == [
        (1, "a", "hit"), (2, "b", "hit"), (3, None, "stale"), (4, None, "miss"), (5, None, "hit")]


def test_merged_aggregate_equals_the_plain_one(spark):
    from tidemark.functions.user import latest, latest_merged

    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, *range(5)]), rng.choice([None, 1, 2, 3])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k long, at long, status long").withColumn("at", F.timestamp_seconds("at"))
    want = df.filter("at IS NOT NULL AND status IS NOT NULL").groupBy("k").agg(latest(F.col("at"), F.col("status")))
    assert sorted(map(tuple, latest_merged(df, ["k"], "at", "status", 3).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
