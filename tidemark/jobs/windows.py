"""Queries over event-time windows, triggers and late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, MINUTE, events, query, tumble_sql
from tidemark.operators import windows as w
from tidemark.plans.timing import plain


def sliding_starts(size: int, slide: int) -> str:
    """SQL list of the starts of all sliding windows that hold a row at ``pos``."""
    return (f"generate_series((pos // {slide}) * {slide} - {size - slide}, "
            f"(pos // {slide}) * {slide}, {slide})")


@query("window_count_by_key", f"""
SELECT {tumble_sql(HOUR)} AS window_start, {tumble_sql(HOUR)} + INTERVAL 1 HOUR AS window_end,
       user_id, count(*) AS cnt
FROM events GROUP BY ALL""")
def window_count_by_key(spark, sf_dir):
    out = w.tumbling(events(spark, sf_dir), "ts", "1 hour", ["user_id"], cnt=F.count(F.lit(1)))
    return w.flatten_window(out)


@query("pv_tumbling", f"""
SELECT {tumble_sql(HOUR)} AS window_start, {tumble_sql(HOUR)} + INTERVAL 1 HOUR AS window_end,
       'pv' AS kind, count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY ALL""")
def pv_tumbling(spark, sf_dir):
    views = events(spark, sf_dir).filter("event_type = 'view'")
    out = w.tumbling(views.withColumn("kind", F.lit("pv")).withColumn("one", F.lit(1).cast("long")),
                     "ts", "1 hour", ["kind"], pv=F.sum("one"))
    return w.flatten_window(out)


@query("pv_sliding", f"""
WITH {EVENTS},
s AS (SELECT unnest({sliding_starts(HOUR, 10 * MINUTE)}) AS st FROM ev WHERE event_type = 'view')
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end, count(*) AS pv
FROM s GROUP BY st""")
def pv_sliding(spark, sf_dir):
    views = events(spark, sf_dir).filter("event_type = 'view'")
    return w.flatten_window(w.sliding(views, "ts", "1 hour", "10 minutes", pv=F.count(F.lit(1))))


@query("window_offset", f"""
SELECT make_timestamp(((epoch_us(ts) - {15 * MINUTE}) // {HOUR}) * {HOUR} + {15 * MINUTE}) AS window_start,
       make_timestamp(((epoch_us(ts) - {15 * MINUTE}) // {HOUR}) * {HOUR} + {75 * MINUTE}) AS window_end,
       event_type, count(*) AS cnt
FROM events GROUP BY ALL""")
def window_offset(spark, sf_dir):
    out = w.tumbling(events(spark, sf_dir), "ts", "1 hour", ["event_type"], offset="15 minutes",
                     cnt=F.count(F.lit(1)))
    return w.flatten_window(out)


SESSION_SQL = f"""
WITH {EVENTS},
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) < {2 * HOUR}
                     THEN 0 ELSE 1 END AS fresh FROM ev),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS no FROM g)
SELECT make_timestamp(min(pos)) AS window_start, make_timestamp(max(pos) + {2 * HOUR}) AS window_end,
       user_id, count(*) AS cnt
FROM n GROUP BY user_id, no"""


@query("session_window_count", SESSION_SQL)
def session_window_count(spark, sf_dir):
    out = w.sessions(events(spark, sf_dir), "ts", "2 hours", ["user_id"], cnt=F.count(F.lit(1)))
    return w.flatten_window(out)


@query("count_window", f"""
WITH {EVENTS}, n AS (SELECT *, (row_number() OVER (ORDER BY pos, event_id) - 1) // 100 AS window_no FROM ev)
SELECT window_no, count(*) AS n, sum(cents)::BIGINT AS cents, min(event_id) AS first_id, max(event_id) AS last_id
FROM n GROUP BY window_no""")
def count_window(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "pos", "cents")
    return w.count_windows(rows, ["pos", "event_id"], 100).groupBy("window_no").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"),
        F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("early_fire_running_sum", f"""
WITH {EVENTS},
p AS (SELECT (pos // {DAY}) * {DAY} AS w, event_type, (pos // {HOUR} + 1) * {HOUR} AS mark, sum(cents) AS s
      FROM ev GROUP BY ALL),
f AS (SELECT w, event_type, unnest(generate_series(min(mark), w + {DAY}, {HOUR})) AS fire
      FROM p GROUP BY w, event_type)
SELECT make_timestamp(f.w) AS window_start, f.event_type, make_timestamp(f.fire) AS fire_at,
       sum(p.s)::BIGINT AS running_sum
FROM f JOIN p ON p.w = f.w AND p.event_type = f.event_type AND p.mark <= f.fire
GROUP BY f.w, f.event_type, f.fire""")
def early_fire_running_sum(spark, sf_dir):
    fired = w.early_fire_sums(events(spark, sf_dir), "ts", ["event_type"], "cents", "1 day", "1 hour")
    return fired.select(plain("window.start").alias("window_start"), "event_type",
                        plain("fire_at").alias("fire_at"), "running_sum")


@query("metric_rate_and_percentiles", f"""
WITH {EVENTS},
q AS (SELECT pos // {DAY} AS d, cents, row_number() OVER (PARTITION BY pos // {DAY} ORDER BY cents) AS rn,
             count(*) OVER (PARTITION BY pos // {DAY}) AS n FROM ev)
SELECT make_timestamp(d * {DAY}) AS window_start, make_timestamp((d + 1) * {DAY}) AS window_end,
       max(n) AS n, max(n) / 86400.0::DOUBLE AS rate_per_second, min(cents) AS min_value, max(cents) AS max_value,
       sum(cents)::BIGINT AS total,
       min(CASE WHEN rn >= ceil(0.5::DOUBLE * n) THEN cents END) AS p50,
       min(CASE WHEN rn >= ceil(0.99::DOUBLE * n) THEN cents END) AS p99
FROM q GROUP BY d""")
def metric_rate_and_percentiles(spark, sf_dir):
    from tidemark.operators.aggregates import rate_and_distribution

    return w.flatten_window(rate_and_distribution(events(spark, sf_dir), "ts", "1 day", "cents", 86400))
