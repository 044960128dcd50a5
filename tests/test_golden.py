"""Small cases with known results."""

import re

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import distinct, joins, models, ranking, routing
from tidemark.plans.timing import window_end

# Start pairs and the number of steps each takes.
STEPS = """
(1,40) 3  (24,41) 2  (3,16) 5  (1,1) 10  (17,15) 4  (29,38) 2  (7,33) 3  (23,36) 3  (10,6) 6
(7,9) 5  (11,15) 4  (20,2) 5  (15,23) 4  (21,5) 5  (17,39) 3  (11,5) 6  (28,13) 4  (14,36) 3
"""


def test_iteration_steps(spark):
    want = [tuple(map(int, m)) for m in re.findall(r"\((\d+),(\d+)\) (\d+)", STEPS)]
    assert len(want) == 18
    df = spark.createDataFrame([(a, b) for a, b, _ in want], "a long, b long")
    got = df.select("a", "b", models.steps_to_bound(F.col("a"), F.col("b")).alias("n")).collect()
    assert [tuple(r) for r in got] == want


def test_iteration_over_frames_agrees(spark):
    want = [tuple(map(int, m)) for m in re.findall(r"\((\d+),(\d+)\) (\d+)", STEPS)]
    df = spark.createDataFrame([(a, b, a, b, 0) for a, b, _ in want], "a long, b long, x long, y long, n int")
    step = lambda d: d.select("a", "b", F.col("y").alias("x"), (F.col("x") + F.col("y")).alias("y"), (F.col("n") + 1).alias("n"))
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    out = models.iterate_until(df, step, (F.col("x") < 100) & (F.col("y") < 100), 20, checkpoint_every=5)
    assert sorted((r["a"], r["b"], r["n"]) for r in out.collect()) == sorted(want)


def test_daily_visitors_carry_over_windows_but_not_days(spark):
    rows = [("u1", "index1", "2019-08-09 23:31:00"), ("u2", "index1", "2019-08-09 23:32:00"),
            ("u1", "index1", "2019-08-09 23:41:00"), ("u3", "index1", "2019-08-09 23:42:00"),
            ("u1", "index1", "2019-08-10 00:01:00"), ("u2", "index1", "2019-08-10 00:02:00"),
            ("u1", "index2", "2019-08-10 00:03:00")]
    df = spark.createDataFrame(rows, "user string, url string, at string").withColumn("ts", F.to_timestamp("at"))
    out = distinct.cumulative_uv(df, ["url"], "user", F.date_format("ts", "yyyyMMdd"), window_end("ts", "10 minutes"))
    got = sorted((r["period"], r["url"], r["uv"]) for r in out.collect())
    assert got == [("20190809", "index1", 2), ("20190809", "index1", 3), ("20190810", "index1", 2), ("20190810", "index2", 1)]


def test_epoch_text(spark):
    df = spark.range(1).select(
        scalar.stamp_to_date(F.lit(1511658000000 + 8 * 3600 * 1000)).alias("text"),
        scalar.date_to_stamp(F.lit("2017-11-26 09:00:00")).alias("ms"),
        scalar.date_to_stamp(F.lit("broken")).alias("bad"))
    row = df.first()
    assert row["text"] == "2017-11-26 09:00:00" and row["ms"] == 1511658000000 + 8 * 3600 * 1000 and row["bad"] is None


def test_map_lookup(spark):
    entries = spark.createDataFrame([("python", 18), ("java", 17), ("scala", 20)], "k string, v int")
    words = spark.createDataFrame([("python",), ("java",), ("java",), ("kafka",), ("scala",), ("redis",)], "k string")
    got = sorted((r["k"], r["v"] or 0) for r in joins.map_lookup(words, entries, "k", "v").collect())
    assert got == [("java", 17), ("java", 17), ("kafka", 0), ("python", 18), ("redis", 0), ("scala", 20)]


def test_partition_halves(spark):
    df = spark.createDataFrame([(i, "a1" if i % 3 else "abc") for i in range(60)], "id long, v string")
    placed = routing.partition_halves(df, "v", 4).select("v", F.spark_partition_id().alias("p")).collect()
    assert all((r["p"] < 2) == (r["v"] == "a1") for r in placed)
    assert len({r["p"] for r in placed}) == 4  # one frequent key uses all slots of its half


def test_two_stage_top(spark):
    line = "ab,ab,ab,ac,ac,ad,bb,bb，bb,cc,cc,cc,cc"
    words = routing.tokens(spark.createDataFrame([(line,)], "text string"), "text", ",")
    counts = words.groupBy("word").agg(F.count("*").alias("cnt"))
    top = ranking.two_stage_top_n(counts, "word", "cnt", F.substring("word", 1, 1), 2, 2)
    assert [(r["word"], r["cnt"]) for r in top.collect()] == [("cc", 4), ("ab", 3)]


def test_top_n_with_fewer_rows_and_close_amounts(spark):
    df = spark.createDataFrame([("x", "a", 1.5), ("x", "b", 1.25), ("y", "c", 9.0)], "g string, id string, v double")
    got = ranking.top_n(df, ["g"], [F.desc("v"), "id"], 10).collect()
    assert sorted((r["g"], r["id"], r["rank"]) for r in got) == [("x", "a", 1), ("x", "b", 2), ("y", "c", 1)]


def test_bitmap_counts_hash_collisions_once(spark):
    df = spark.createDataFrame([(str(i),) for i in range(500)], "u string").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    out = distinct.bitmap_uv(df, "ts", "1 day", "u").first()

    def text_hash(text):
        h = 0
        for ch in text:
            h = h * 61 + ord(ch)
        return h & ((1 << 29) - 1)

    assert out["uv"] == len({text_hash(str(i)) for i in range(500)})


def test_match_streams_pairs_once_and_reports_the_rest(spark):
    left = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-01 00:00:00")], "k long, s string")
    right = spark.createDataFrame([(1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:06"), (4, "2024-01-01 00:00:00")], "k long, s string")
    left = left.select("k", F.to_timestamp("s").alias("lt"))
    right = right.select("k", F.to_timestamp("s").alias("rt"))
    got = sorted((r["k"], r["status"]) for r in joins.match_streams(left, right, ["k"], "lt", "rt", "5 seconds").collect())
    assert got == [(1, "matched"), (2, "only_left"), (2, "only_right"), (3, "only_left"), (4, "only_right")]


def test_top_n_beyond_the_group_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    got = ranking.top_n(df, ["g"], [F.desc("id")], 1500).groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    assert sorted(map(tuple, got.collect())) == [(0, 1500, 2000), (1, 1500, 2001)]


def test_sessions_split_exactly_at_the_gap(spark):
    from tidemark.operators.windows import sessions

    df = spark.createDataFrame([(1, s) for s in (0, 9, 18, 28, 37, 100)], "k long, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    got = sessions(df, "ts", "10 seconds", ["k"], n=F.count("*")).select(
        F.unix_seconds("window.start").alias("a"), F.unix_seconds("window.end").alias("b"), "n").collect()
    assert sorted(map(tuple, got)) == [(0, 28, 3), (28, 47, 2), (100, 110, 1)]
