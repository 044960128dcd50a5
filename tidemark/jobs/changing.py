"""Rules that change during a run, and state that is forgotten, on streams of several deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.late import BEHIND, DELAY, FILE, delivered, timed
from tidemark.jobs.registry import DAY, EVENTS, HOUR, events, query
from tidemark.operators import aggregates as a
from tidemark.operators import distinct as d
from tidemark.operators import windows as w
from tidemark.plans.timing import floor_div, instant, plain
from tidemark.session import scratch_dir
from tidemark.sinks.upsert import KeyedTable
from tidemark.streaming import rules
from tidemark.streaming.changing import apply_changing_rules, filter_by_newest_keyword
from tidemark.streaming.expiring import expiring_uv
from tidemark.streaming.ordered import apply_rule
from tidemark.streaming.replay import Replay

# Where the watermark of two sides ends up: an hour behind the side that is behind.
BOTH_SQL = f"""
w AS (SELECT least(max(pos) FILTER (event_type = 'purchase') // 1000, max(pos) FILTER (event_type = 'signup') // 1000) * 1000
             - {HOUR} AS mark FROM ev)"""


def two_sides(spark, sf_dir, name: str, code: str, rule_text: str, row_text: str):
    """Purchases as rows and sign-ups as rule versions, which are delivered up to two files after their time."""
    all_rows = events(spark, sf_dir)
    file = floor_div("pos", FILE)
    first, last = all_rows.agg(F.min(file), F.max(file)).first()
    stepped = all_rows.withColumn("step", (file - F.lit(first) + F.expr(BEHIND)).cast("int")).withColumn("code", F.expr(code))
    replay = Replay(spark, name, 0 if first is None else last - first + 3, {
        "rows": stepped.filter("event_type = 'purchase'").select("event_id", "ts", "code", F.expr(row_text).alias("text"), "step"),
        "rules": stepped.filter("event_type = 'signup'").select("ts", "code", F.expr(rule_text).alias("text"), "step")})
    return replay, lambda table: replay.stream(table).withWatermark("ts", DELAY)


@query("changing_rules_stream", f"""
WITH {EVENTS}, {BOTH_SQL},
rules AS (SELECT user_id % 10 AS code, pos, 'v' || event_id AS text FROM ev WHERE event_type = 'signup'),
best AS (SELECT code, pos, max(text) AS text FROM rules GROUP BY ALL),
rows AS (SELECT user_id % 10 AS code, pos, event_id FROM ev, w WHERE event_type = 'purchase' AND pos < mark)
SELECT r.code, r.event_id, coalesce(b.text, 'code ' || r.code) AS name, b.text IS NOT NULL AS ruled
FROM rows r ASOF LEFT JOIN best b ON b.code = r.code AND b.pos <= r.pos""")
def changing_rules_stream(spark, sf_dir):
    """Codes replaced by the name valid at the time of the row; names change, and new ones arrive late."""
    replay, side = two_sides(spark, sf_dir, "changing", "user_id % 10", "concat('v', event_id)", "concat('code ', user_id % 10)")
    return replay.to_table(apply_changing_rules(side("rows"), side("rules"), "ts", "code", "event_id", "text")).select(
        "code", F.col("row_id").alias("event_id"), F.col("text").alias("name"), "ruled")


@query("changing_keyword_stream", f"""
WITH {EVENTS}, {BOTH_SQL},
words AS (SELECT pos, max(CAST(item % 10 AS VARCHAR)) AS keyword FROM ev WHERE event_type = 'signup' GROUP BY pos),
rows AS (SELECT event_id, pos, props FROM ev JOIN events USING (event_id), w WHERE ev.event_type = 'purchase' AND pos < mark)
SELECT r.event_id, coalesce(k.keyword, 'k') AS keyword
FROM rows r ASOF LEFT JOIN words k ON k.pos <= r.pos WHERE contains(r.props, coalesce(k.keyword, 'k'))""")
def changing_keyword_stream(spark, sf_dir):
    """Rows that hold the keyword that was newest at their time; the first one is given."""
    replay, side = two_sides(spark, sf_dir, "keyword", "0", "cast(item % 10 AS string)", "props")
    return replay.to_table(filter_by_newest_keyword(side("rows"), side("rules"), "ts", "event_id", "text", "k")).select(
        F.col("row_id").alias("event_id"), "keyword")


@query("uv_expiring_stream", f"""
WITH {EVENTS},
d AS (SELECT *, pos // {FILE} + {BEHIND} AS step FROM ev),
s AS (SELECT event_type, step, count(DISTINCT user_id) AS n FROM d GROUP BY ALL)
SELECT event_type, count(DISTINCT user_id) AS uv_kept,
       (SELECT sum(n)::BIGINT FROM s WHERE s.event_type = d.event_type) AS uv_forgotten
FROM d GROUP BY event_type""")
def uv_expiring_stream(spark, sf_dir):
    """Distinct users with a state that lives for a day, and with one that is gone before the next delivery."""
    def counted(name: str, ttl_ms: int):
        replay = delivered(spark, sf_dir, name, idle_batches=False)
        batches = replay.to_batches(expiring_uv(replay.stream("events"), ["event_type"], "user_id", ttl_ms),
                                    lambda batch, _: batch, "update")
        return batches.groupBy("event_type").agg(F.sum("fresh").alias(name))

    return counted("uv_kept", 86_400_000).join(counted("uv_forgotten", 1), "event_type")


@query("idle_count_stream", f"""
WITH {EVENTS},
w AS (SELECT (max(pos) // 1000) * 1000 - {HOUR} AS mark FROM ev),
g AS (SELECT user_id, event_id, pos,
             CASE WHEN pos > lag(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) + {DAY} THEN 1 ELSE 0 END AS fresh
      FROM ev, w WHERE pos < mark),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS run FROM g)
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, run ORDER BY pos, event_id) AS cnt FROM n""")
def idle_count_stream(spark, sf_dir):
    """Running counts per user that begin anew after a day without events: the state is forgotten in event time."""
    ordered = events(spark, sf_dir)
    file = floor_div("pos", FILE)
    first, last = ordered.agg(F.min(file), F.max(file)).first()
    replay = Replay(spark, "idle", 0 if first is None else last - first + 1, {
        "events": ordered.select("user_id", "ts", "pos", "event_id", "event_type", (file - F.lit(first)).cast("int").alias("step"))})
    out = replay.to_table(apply_rule(timed(replay), ["user_id"], rules.Changelog(), idle="1 day"))
    return out.filter("op = '+'").select("user_id", "event_id", "cnt")


@query("sketches_stream", f"""
WITH {EVENTS},
w AS (SELECT (max(pos) // 1000) * 1000 - {HOUR} AS mark FROM ev),
c AS (SELECT * FROM ev, w WHERE (pos // {HOUR} + 1) * {HOUR} <= mark)
SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS uv, TRUE AS uv_within, count(cents) AS n,
       TRUE AS p50_within, TRUE AS p99_within FROM c GROUP BY ALL""")
def sketches_stream(spark, sf_dir):
    """Hourly sketches of users and values from a stream, rolled up to days and checked against exact figures."""
    ordered = events(spark, sf_dir)
    file = floor_div("pos", FILE)
    first, last = ordered.agg(F.min(file), F.max(file)).first()
    replay = Replay(spark, "sketches", 0 if first is None else last - first + 1, {
        "events": ordered.select("user_id", "ts", "pos", "cents", (file - F.lit(first)).cast("int").alias("step"))})
    hours = replay.to_table(w.tumbling(timed(replay), "ts", "1 hour", [], users=F.hll_sketch_agg("user_id", F.lit(14)),
                                       sketch=F.kll_sketch_agg_bigint("cents", F.lit(800))))
    day = F.date_format("window.start", "yyyy-MM-dd").alias("day")
    closed = ordered.join(hours.select(F.unix_micros("window.start").alias("_hour")), floor_div("pos", HOUR) * HOUR == F.col("_hour")).withColumn(
        "day", F.date_format("ts", "yyyy-MM-dd"))
    users = d.hll_checked(d.hll_rollup(hours.withColumn("sketch", F.col("users")), day),
                          closed.groupBy("day").agg(F.countDistinct("user_id").alias("uv")), ["day"])
    ranks = {"p50": 0.5, "p99": 0.99}
    values = a.quantiles_checked(closed, a.merged_quantiles(hours, [day], ranks), ["day"], "cents", ranks)
    return users.withColumnRenamed("within", "uv_within").join(values, "day")


@query("keyed_upsert_stream", f"""
WITH {EVENTS}
SELECT event_type, make_timestamp(pos // {DAY} * {DAY}) AS window_start, count(*) AS pv, sum(cents)::BIGINT AS total
FROM ev GROUP BY ALL""")
def keyed_upsert_stream(spark, sf_dir):
    """Daily totals put into a result table by key with every batch; late rows change the rows that are there."""
    replay = delivered(spark, sf_dir, "upserts")
    totals = replay.stream("events").groupBy("event_type", (floor_div("pos", DAY) * DAY).alias("day")).agg(
        F.count(F.lit(1)).alias("pv"), F.sum("cents").alias("total"))
    result = KeyedTable(spark, scratch_dir(spark, "upserted"), "event_type string, day long, pv long, total long",
                        ["event_type", "day"], order="pv", buckets=8)
    replay.run(totals.writeStream.foreachBatch(result.upsert).outputMode("update"))
    return result.read().select("event_type", plain(instant("day")).alias("window_start"), "pv", "total")
