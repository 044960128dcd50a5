"""Cases the driver's tables do not hold: unknown events, negative integers, null keys and tied positions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, automaton, detection, joins
from tidemark.plans.ordered import asof_latest
from tidemark.sources.records import little_endian_int, to_little_endian
from tidemark.streaming import rules


@pytest.mark.parametrize("chunk", [2000, 2])
def test_unknown_events_alert_and_keep_the_state(spark, chunk):
    rows = [("k", 1, "a"), ("k", 2, "q"), ("k", 3, "b"), ("k", 4, "e"), ("k", 5, None), ("k", 6, "g"), ("n", 1, "z"), ("n", 2, "c")]
    df = spark.createDataFrame(rows, "k string, pos long, ev string")
    got = sorted((r["k"], r["pos"], r["ev"], r["state"]) for r in automaton.alerts(df, ["k"], ["pos"], "ev", chunk=chunk).collect())
    assert [(k, p, e) for k, p, e, _ in got] == [("k", 2, "q"), ("k", 5, None), ("n", 1, "z")]
    assert got[0][3] == "W" and got[1][3] == "Z"


def test_signed_integers_round_trip(spark):
    values = [0, 1, -1, -5, 255, 256, 2**31 - 1, -2**31]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select("v", little_endian_int(to_little_endian(F.col("v")), 0).alias("back")).collect()
    assert all(r["v"] == r["back"] for r in got)


ORDER = ["pos", "id"]


def test_null_keys_form_one_chain(spark):
    big = 2**60 + 1  # beside a null, pandas would hold this key as a float
    rows = [(k, 10 * i, i, 1 + i) for k in (None, big, big + 1) for i in range(9)]
    df = spark.createDataFrame(rows, "k long, pos long, id long, v long")
    found = detection.rising_trends(df, ["k"], ORDER, "v", 25).select("k", "pos").collect()
    want = [(k, p) for k in (None, big, big + 1) for p in (10, 40)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_delta_trigger_sees_no_later_row_of_its_position(spark):
    rows = [("k", 0, 0, 0, 0), ("k", 10, 1, 5, 50), ("k", 10, 2, 9, 51), (None, 0, 3, 0, 0), (None, 10, 4, 1, 50), (None, 20, 5, 2, 90)]
    df = spark.createDataFrame(rows, "k string, pos long, id long, speed long, dist long")
    found = detection.delta_trigger(df, ["k"], ORDER, "dist", 30, "speed", 100).collect()
    assert sorted((r["id"], r["best_id"]) for r in found) == [(1, 1), (4, 4), (5, 5)]


def test_fail_timer_names_the_first_of_tied_failures(spark):
    rows = [("k", 10, i) for i in (7, 3, 5)]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "k string, pos long, id long").coalesce(1)
        found = detection.fails_at_timer(df, ["k"], "pos", F.lit(True), F.lit(False), 60, ties=["id"]).collect()
        assert [(r["id"], r["fails"]) for r in found] == [(3, 3)]


def test_match_streams_keeps_repeated_records(spark):
    at = lambda df, name: df.withColumn(name, F.timestamp_seconds(name))
    left = at(spark.createDataFrame([("k", 1), ("k", 100)], "k string, lt long"), "lt")
    right = at(spark.createDataFrame([("k", 101)], "k string, rt long"), "rt")
    got = joins.match_streams(left, right, ["k"], "lt", "rt", "5 seconds").select(
        "status", F.unix_seconds("lt"), F.unix_seconds("rt")).collect()
    assert sorted(map(tuple, got)) == [("matched", 100, 101), ("only_left", 1, None)]


@pytest.mark.parametrize("per_bucket", ["5", "100000"])
def test_match_streams_equals_its_stream_rule(spark, per_bucket):
    draw = random.Random(4)
    events = [(draw.choice(["a", "a", "a", "b", None]), draw.randrange(120), i, draw.choice(["left", "right"])) for i in range(160)]
    rule, want = rules.MatchStreams(3 * 1_000_000), []
    for key in ("a", "b", None):
        memo = dict.fromkeys(name for name, _ in rule.memo)
        for _, second, i, side in sorted((e for e in events if e[0] == key), key=lambda e: e[1:3]):
            pos = second * 1_000_000
            if memo["side"] is not None and rule.due(memo) < pos:
                want += [(key, *out) for out in rule.on_timer(memo, rule.due(memo))]
            want += [(key, *out) for out in rule.on_event(memo, {"pos": pos, "event_id": i, "event_type": side})]
        if memo["side"] is not None:
            want += [(key, *out) for out in rule.on_timer(memo, rule.due(memo))]
    df = spark.createDataFrame(events, "k string, s long, id long, side string").withColumn("ts", F.timestamp_seconds("s"))
    of = lambda side: df.filter(F.col("side") == side).select(
        "k", F.col("id").alias(f"{side}_id"), F.col("ts").alias(f"{side}_ts"))
    before = spark.conf.get("tidemark.rowsPerBucket")
    spark.conf.set("tidemark.rowsPerBucket", per_bucket)
    try:
        got = joins.match_streams(of("left"), of("right"), ["k"], "left_ts", "right_ts", "3 seconds",
                                  ties=[("left_id", "right_id")]).select("k", "left_id", "right_id", "status").collect()
    finally:
        spark.conf.set("tidemark.rowsPerBucket", before)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r["status"] for r in got} == {"matched", "only_left", "only_right"}


def test_asof_cuts_a_long_right_side(spark):
    left = spark.range(50).selectExpr("'k' as k", "id * 100 + 50 as pos", "id")
    right = spark.range(5000).selectExpr("'k' as k", "id as at", "id * 2 as v")
    out = asof_latest(left, right, ["k"], ["pos", "id"], "at", ["v"])
    assert "_bucket" in out._jdf.queryExecution().toString()
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [(i, 2 * (100 * i + 50)) for i in range(50)]


@pytest.mark.parametrize("per_bucket", [2_000_000, 20_000])
def test_percentiles_are_exact_at_any_number_of_values(spark, per_bucket):
    rows, before = 300_000, spark.conf.get("tidemark.rowsPerBucket")
    value = F.when(F.col("id") % 1000 != 0, F.col("id") * 7919 % 1_000_003)
    df = spark.range(rows).select(F.timestamp_seconds(F.col("id") % 86_400 + F.when(F.col("id") < 5, 86_400).otherwise(0)).alias("ts"), value.alias("v"))
    spark.conf.set("tidemark.rowsPerBucket", str(per_bucket))
    try:
        got = aggregates.rate_and_distribution(df, "ts", "1 day", "v", 86_400).orderBy("window").select("n", "p50", "p99").collect()
    finally:
        spark.conf.set("tidemark.rowsPerBucket", before)
    want = []
    for ids in (range(5, rows), range(5)):
        known = sorted(i * 7919 % 1_000_003 for i in ids if i % 1000)
        want.append((len(ids), *(known[math.ceil(p * len(known)) - 1] for p in (0.5, 0.99))))
    assert [tuple(r) for r in got] == want
