"""Detection rules as streams of several deliveries; each gives what its batch form gives.

Events are delivered in order, ten days a file, and a flush row at the end lets every timer go off.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.detection import ORDER
from tidemark.jobs.late import FILE, timed
from tidemark.jobs.registry import DAY, EVENTS, HOUR, ORACLES, events, query
from tidemark.plans.ordered import running
from tidemark.plans.timing import floor_div, instant, plain
from tidemark.streaming import rules
from tidemark.streaming.ordered import apply_rule
from tidemark.streaming.replay import Replay

NEVER = 9_000_000_000_000_000_000


def ruled(spark, name: str, rows, rule: rules.Rule):
    """What a rule puts out per user for ``rows`` (``user_id, pos, event_id, ...``) in deliveries."""
    file = floor_div("pos", FILE)
    first, last, end = rows.agg(F.min(file), F.max(file), F.max("pos")).first()
    steps = 0 if first is None else last - first + 2
    stepped = rows.withColumn("step", (file - F.lit(first)).cast("int"))
    flush = spark.createDataFrame([(NEVER if end is None else end + 3650 * DAY, steps - 1)], "pos long, step int").select(
        *[F.col(f.name) if f.name in ("pos", "step") else F.lit(None).cast(f.dataType).alias(f.name) for f in stepped.schema.fields])
    all_rows = stepped.unionByName(flush) if steps else stepped
    replay = Replay(spark, name, steps, {"events": all_rows.withColumn("ts", instant("pos"))})
    return replay.to_table(apply_rule(timed(replay), ["user_id"], rule))


@query("value_jump_stream", ORACLES["value_jump_alert"])
def value_jump_stream(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", *ORDER, F.col("cents").alias("value"))
    return ruled(spark, "jumps", rows, rules.ValueJump(3000)).select(
        "user_id", "event_id", F.col("prev_value").alias("prev_cents"), F.col("value").alias("cents"))


@query("fail_timer_stream", ORACLES["login_fail_timer"])
def fail_timer_stream(spark, sf_dir):
    rows = events(spark, sf_dir).filter("event_type IN ('error', 'signup')").select("user_id", *ORDER, "event_type")
    return ruled(spark, "fails", rows, rules.FailTimer("error", "signup", 6 * HOUR)).select(
        "user_id", "event_id", "fails", plain(instant("alert_pos")).alias("alert_at"))


@query("rising_trend_stream", ORACLES["rising_trend_alert"].replace("(SELECT max(pos) + 1 FROM ev)", str(NEVER)))
def rising_trend_stream(spark, sf_dir):
    """As in batch, but a rise that lasts to the end is reported too: time goes on behind the last event."""
    rows = events(spark, sf_dir).select("user_id", *ORDER, F.col("cents").alias("value"))
    return ruled(spark, "rises", rows, rules.RisingTrend(4 * HOUR)).select(
        "user_id", plain(instant("rise_pos")).alias("rise_at"), plain(instant("alert_pos")).alias("alert_at"))


@query("delta_trigger_stream", ORACLES["delta_trigger_max"])
def delta_trigger_stream(spark, sf_dir):
    moved = running(events(spark, sf_dir).select("user_id", *ORDER, "cents"), ["user_id"], ORDER, {"progress": ("cents", "sum")})
    rows = moved.withColumnRenamed("cents", "measure")
    return ruled(spark, "deltas", rows, rules.DeltaTrigger(8000, DAY)).select(
        "user_id", "event_id", F.col("progress").alias("distance"), "best_event_id", F.col("best").alias("best_cents"))


@query("count_window_stream", f"""
WITH {EVENTS},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos, event_id) - 1 AS rn FROM ev)
SELECT user_id, (rn // 10)::BIGINT AS window_no, sum(cents)::BIGINT AS total, arg_max(event_id, rn) AS last_event_id
FROM n GROUP BY user_id, rn // 10 HAVING count(*) = 10""")
def count_window_stream(spark, sf_dir):
    """Every ten events of a user; an incomplete window stays open."""
    rows = events(spark, sf_dir).select("user_id", *ORDER, F.col("cents").alias("value"))
    return ruled(spark, "tens", rows, rules.CountWindow(10))


@query("latest_model_stream", f"""
WITH {EVENTS}, m AS (SELECT * FROM ev WHERE event_type = 'signup')
SELECT d.user_id, d.event_id, m.event_id AS model_id, m.cents AS model
FROM (SELECT * FROM ev WHERE event_type <> 'signup') d ASOF LEFT JOIN m ON m.user_id = d.user_id AND d.pos >= m.pos""")
def latest_model_stream(spark, sf_dir):
    """Each row with the user's newest model before it; sign-ups stand for models."""
    kind = F.when(F.col("event_type") == "signup", "model").otherwise("data").alias("event_type")
    rows = events(spark, sf_dir).select("user_id", *ORDER, kind, F.col("cents").alias("value"))
    return ruled(spark, "models", rows, rules.LatestModel())
