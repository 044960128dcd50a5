"""Streams fed file by file: equal to the batch operators, restartable, late rows visible."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import detection, windows
from tidemark.plans.timing import position
from tidemark.session import scratch_dir
from tidemark.streaming import rules
from tidemark.streaming.ordered import apply_rule
from tidemark.streaming.run import to_batches, to_table, use_rocksdb
from tidemark.streaming.state import route_late_stream

SECOND = 1_000_000
DDL = "user_id long, event_id long, event_type string, value long, pos long"


def make_events(seed, kinds, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = 1_704_067_200 * SECOND + i * SECOND
        rows.append((0 if rng.random() < 0.4 else rng.randrange(1, 5), i, rng.choice(kinds), rng.randrange(6), at))
    return rows


def write_files(spark, rows, files, shuffle=0):
    """Rows in time order over several files, locally shuffled to arrive out of order."""
    path, size = scratch_dir(spark, "feed"), -(-len(rows) // files)
    order = sorted(rows, key=lambda r: r[4] + random.Random(r[1]).randrange(0, shuffle + 1))
    for n in range(files):
        spark.createDataFrame(order[n * size:(n + 1) * size], DDL).coalesce(1).write.mode("append").parquet(path)
    return path


def feed(spark, path, delay="5 seconds"):
    use_rocksdb(spark)
    df = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(path)
    return df.withColumn("ts", F.timestamp_micros("pos")).withWatermark("ts", delay)


def flushed(rows, kinds):
    """A last row far in the future moves the watermark past everything else."""
    return [*rows, (99, 10_000, kinds[0], 0, rows[-1][4] + 3600 * SECOND)]


def batch(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("ts", F.timestamp_micros("pos"))


def test_windowed_counts_equal_batch_on_closed_windows(spark):
    rows = flushed(make_events(1, ["view"]), ["view"])
    count = lambda df: windows.flatten_window(windows.tumbling(df, "ts", "10 seconds", ["user_id"], n=F.count("*")))
    streamed = to_table(count(feed(spark, write_files(spark, rows, 4, 3 * SECOND))), "t-count")
    expected = count(batch(spark, rows)).filter("user_id <> 99")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, expected.collect()))


def test_sliding_panes_equal_batch(spark):
    rows = flushed(make_events(2, ["view"]), ["view"])
    count = lambda df: windows.flatten_window(windows.sliding(df, "ts", "20 seconds", "5 seconds", ["user_id"], n=F.count("*")))
    streamed = to_table(count(feed(spark, write_files(spark, rows, 3, 3 * SECOND))), "t-slide")
    expected = count(batch(spark, rows)).filter("user_id <> 99")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, expected.collect()))


def test_restart_continues_from_checkpoint(spark):
    rows = flushed(make_events(3, ["view"]), ["view"])
    head, tail = rows[:90], rows[90:]
    path = write_files(spark, head, 2)
    out, ckpt = scratch_dir(spark, "t-restart"), scratch_dir(spark, "t-restart-ckpt")
    count = lambda df: windows.flatten_window(windows.tumbling(df, "ts", "10 seconds", ["user_id"], n=F.count("*")))
    first = to_table(count(feed(spark, path)), "t", checkpoint=ckpt, path=out).count()
    for part in (tail[:40], tail[40:]):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(path)
    second = to_table(count(feed(spark, path)), "t", checkpoint=ckpt, path=out)
    expected = count(batch(spark, rows)).filter("user_id <> 99")
    assert first < second.count()
    assert sorted(map(tuple, second.collect())) == sorted(map(tuple, expected.collect()))


def run_rule(spark, rows, rule, keys=("user_id",), kinds=("x",)):
    path = write_files(spark, flushed(rows, kinds), 3, 3 * SECOND)
    out = to_table(apply_rule(feed(spark, path), list(keys), rule), "t-rule")
    return out.filter(f"{keys[0]} <> 99").collect()


def test_fail_timer_equals_batch(spark):
    rows = make_events(4, ["fail", "fail", "ok"])
    got = {(r["event_id"], r["fails"]) for r in run_rule(spark, rows, rules.FailTimer("fail", "ok", 8 * SECOND), kinds=("ok",))}
    out = detection.fails_at_timer(batch(spark, rows), ["user_id"], "pos", F.col("event_type") == "fail",
                                   F.col("event_type") == "ok", "8 seconds")
    assert got == {(r["event_id"], r["fails"]) for r in out.collect()} and got


def test_rising_trend_equals_batch(spark):
    rows = make_events(5, ["x"])
    got = {(r["user_id"], r["rise_pos"]) for r in run_rule(spark, rows, rules.RisingTrend(6 * SECOND))}
    # The batch run ends at the last real event, the stream one hour later.
    end = flushed(rows, ["x"])
    out = detection.rising_trends(batch(spark, end), ["user_id"], ["pos", "event_id"], "value", "6 seconds")
    assert got == {(r["user_id"], r["pos"]) for r in out.collect()} and got


def test_payment_timeout(spark):
    at = lambda s: 1_704_067_200 * SECOND + s * SECOND
    rows = [(1, 1, "create", 0, at(0)), (1, 2, "pay", 0, at(4)), (2, 3, "create", 0, at(1)),
            (3, 4, "pay", 0, at(2)), (4, 5, "create", 0, at(3)), (4, 6, "pay", 0, at(13))]
    rows.sort(key=lambda r: r[4])
    got = {(r["event_id"], r["outcome"]) for r in
           run_rule(spark, rows, rules.PaymentTimeout("create", "pay", 10 * SECOND), kinds=("other",))}
    assert got == {(1, detection.PAID), (3, detection.UNPAID), (4, detection.NO_CREATE), (5, detection.PAID_LATE)}


def test_two_sources_matched_or_reported(spark):
    at = lambda s: 1_704_067_200 * SECOND + s * SECOND
    rows = [(1, 1, "left", 0, at(0)), (1, 2, "right", 0, at(3)), (2, 3, "right", 0, at(1)), (3, 4, "left", 0, at(2)),
            (3, 5, "right", 0, at(9))]
    rows.sort(key=lambda r: r[4])
    got = {(r["left_id"], r["right_id"], r["status"]) for r in run_rule(spark, rows, rules.MatchStreams(5 * SECOND), kinds=("left",))}
    assert got == {(1, 2, "matched"), (None, 3, "only_right"), (4, None, "only_left"), (None, 5, "only_right")}


@pytest.mark.parametrize("name", ["jump", "changelog", "delta", "model", "count"])
def test_simple_rules(spark, name):
    rows = make_events(6, ["x"], 60)
    seen = {}
    for row in rows:
        seen.setdefault(row[0], []).append(row)
    if name == "jump":
        got = {r["event_id"] for r in run_rule(spark, rows, rules.ValueJump(2))}
        want = {b[1] for s in seen.values() for a, b in zip(s, s[1:]) if a[3] and abs(a[3] - b[3]) > 2}
    elif name == "changelog":
        got = {(r["event_id"], r["op"], r["cnt"]) for r in run_rule(spark, rows, rules.Changelog())}
        want = {(r[1], "+", i + 1) for s in seen.values() for i, r in enumerate(s)}
        want |= {(r[1], "-", i) for s in seen.values() for i, r in enumerate(s) if i}
    elif name == "model":
        rows = make_events(6, ["model", "data", "data"], 60)
        got = {(r["event_id"], r["model_id"]) for r in run_rule(spark, rows, rules.LatestModel())}
        want, newest = set(), {}
        for row in rows:
            if row[2] == "model":
                newest[row[0]] = row[1]
            else:
                want.add((row[1], newest.get(row[0])))
    elif name == "count":
        got = {(r["user_id"], r["window_no"], r["total"], r["last_event_id"]) for r in run_rule(spark, rows, rules.CountWindow(4))}
        want = {(k, i // 4, sum(r[3] for r in s[i:i + 4]), s[i + 3][1])
                for k, s in seen.items() for i in range(0, len(s) - 3, 4)}
    else:
        total, moved = {}, []
        for row in rows:
            total[row[0]] = total.get(row[0], 0) + row[3]
            moved.append((row[0], row[1], str(total[row[0]]), row[3], row[4]))
        path = write_files(spark, flushed(moved, ["0"]), 2)
        df = feed(spark, path).select("user_id", "ts", "pos", "event_id", F.col("event_type").cast("long").alias("progress"),
                                      F.col("value").alias("measure"))
        out = to_table(apply_rule(df, ["user_id"], rules.DeltaTrigger(4, 20 * SECOND)), "t-delta").filter("user_id <> 99")
        got = {(r["event_id"], r["best_event_id"]) for r in out.collect()}
        flat = spark.createDataFrame([(m[0], m[1], m[4], int(m[2]), m[3]) for m in moved],
                                     "user_id long, event_id long, pos long, dist long, speed long")
        ref = detection.delta_trigger(flat, ["user_id"], ["pos", "event_id"], "dist", 4, "speed", "20 seconds")
        want = {(r["event_id"], r["best_event_id"]) for r in ref.collect()}
    assert got == want and want


def test_late_rows_are_routed_not_lost(spark):
    at = lambda s: 1_704_067_200 * SECOND + s * SECOND
    path = scratch_dir(spark, "late")
    for part in ([(1, 1, "x", 0, at(5)), (1, 2, "x", 0, at(100))],   # watermark 95 afterwards
                 [(1, 3, "x", 0, at(101))],                          # sees 95
                 [(1, 4, "x", 0, at(6)), (1, 5, "x", 0, at(88)), (1, 6, "x", 0, at(99))]):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(path)
    out = to_table(route_late_stream(feed(spark, path), "pos", "10 seconds", "20 seconds"), "t-late")
    got = {r["event_id"]: r["route"] for r in out.collect()}
    assert got == {1: "on_time", 2: "on_time", 3: "on_time", 4: "late", 5: "late_accepted", 6: "on_time"}


def test_replayed_batch_replaces_its_output(spark):
    from tidemark.sinks.batched import keyed_batches

    out = scratch_dir(spark, "replay")
    save = keyed_batches(out)
    df = spark.range(5)
    for _ in range(2):
        save(df, 0)
    save(df, 1)
    assert spark.read.parquet(out).count() == 10


def test_observed_metrics_of_a_stream(spark):
    rows = make_events(7, ["ok", "bad"], 40)
    df = feed(spark, write_files(spark, rows, 2)).observe(
        "parse", F.count_if(F.col("event_type") == "ok").alias("parsed"), F.count_if(F.col("event_type") == "bad").alias("failed"))
    q = df.writeStream.format("noop").option("checkpointLocation", scratch_dir(spark, "obs")).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p.observedMetrics["parse"] for p in q.recentProgress if "parse" in p.observedMetrics]
    assert sum(m["parsed"] for m in seen) == sum(r[2] == "ok" for r in rows)
    assert sum(m["failed"] for m in seen) == sum(r[2] == "bad" for r in rows)


def test_position_is_microseconds(spark):
    assert spark.range(1).select(position(F.timestamp_micros(F.lit(12345))).alias("p")).first()["p"] == 12345


def test_batches_keep_their_id(spark):
    rows = make_events(9, ["x"], 20)
    out = to_batches(feed(spark, write_files(spark, rows, 2)), "t-b", lambda b, _: b.drop("ts"), "append")
    assert out.count() == 20 and out.select("batch").distinct().count() == 2


def test_state_rows_are_not_counted(spark):
    use_rocksdb(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
