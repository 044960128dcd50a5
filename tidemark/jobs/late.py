"""Late data and repeated firings, on streams of several deliveries.

The event table is delivered in files of ten days each.  Two kinds of events come late: ``error`` events one delivery
after their time, ``signup`` events two.  The watermark is Spark's own, one hour behind the largest time seen; windows
are a day long and take late rows for twelve days, so some late rows change a window that has fired and others go to the
side output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, events, query
from tidemark.operators import ranking as r
from tidemark.plans.timing import floor_div, instant, plain
from tidemark.session import scratch_dir
from tidemark.sinks.batched import keyed_batches
from tidemark.streaming.firing import WINDOW, firing_windows
from tidemark.streaming.replay import Replay
from tidemark.streaming.run import BATCH
from tidemark.streaming.state import route_late_stream

FILE, DELAY, SIZE, LATENESS = 10 * DAY, "1 hour", "1 day", "12 days"
BEHIND = "CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END"


def delivered(spark, sf_dir, name: str, idle_batches: bool = True) -> Replay:
    rows = events(spark, sf_dir)
    file = floor_div("pos", FILE)
    first, last = rows.agg(F.min(file), F.max(file)).first()
    steps = 0 if first is None else last - first + 3
    stepped = rows.withColumn("step", (file - F.lit(first) + F.expr(BEHIND)).cast("int"))
    return Replay(spark, name, steps, {"events": stepped.select(
        "event_id", "ts", "pos", "user_id", "event_type", "item", "cents", "step")}, idle_batches=idle_batches)


def timed(replay: Replay):
    return replay.stream("events").withWatermark("ts", DELAY)


# Deliveries, the watermark after each (and before each) of them, and the route of every row.
STEPS_SQL = f"""
d AS (SELECT *, pos // {DAY} * {DAY} AS win,
             pos // {FILE} - min(pos // {FILE}) OVER () + {BEHIND} AS step FROM ev),
k AS (SELECT unnest(generate_series(0, max(step))) AS step FROM d),
m AS (SELECT k.step, coalesce((max(max(pos)) OVER (ORDER BY k.step) // 1000) * 1000 - {HOUR}, 0) AS mark
      FROM k LEFT JOIN d ON d.step = k.step GROUP BY k.step),
routed AS (SELECT d.*, CASE WHEN win + {DAY} > coalesce(b.mark, 0) THEN 'on_time'
                            WHEN win + {13 * DAY} > coalesce(b.mark, 0) THEN 'late_accepted' ELSE 'late' END AS route
           FROM d LEFT JOIN m b ON b.step = d.step - 1)"""


@query("late_data_split", f"""
WITH {EVENTS}, {STEPS_SQL}
SELECT event_id, event_type, route FROM routed""")
def late_data_split(spark, sf_dir):
    """Every row with the route that the watermark of its batch gives it."""
    replay = delivered(spark, sf_dir, "late-split")
    return replay.to_table(route_late_stream(timed(replay), "pos", SIZE, LATENESS)).select(
        "event_id", "event_type", "route")


def firings_sql(key: str, value: str) -> str:
    """All firings of the windows of ``key``: at the close, and for each later delivery with accepted rows."""
    return f"""
g AS (SELECT {key} AS key, win, step, count(*) AS n, sum({value}) AS total FROM routed WHERE route <> 'late' GROUP BY ALL),
closes AS (SELECT win, min(m.step) AS closed FROM (SELECT DISTINCT win FROM g) JOIN m ON m.mark >= win + {DAY} GROUP BY win),
sums AS (SELECT g.key, g.win, g.step, closed, sum(n) OVER o AS n, sum(total) OVER o AS total
         FROM g LEFT JOIN closes USING (win) WINDOW o AS (PARTITION BY g.key, g.win ORDER BY g.step)),
fired AS (
  SELECT key, win, greatest(step, closed) AS step, max_by(n, step) AS n, max_by(total, step) AS total
  FROM sums WHERE closed IS NOT NULL GROUP BY key, win, greatest(step, closed)),
versions AS (SELECT *, row_number() OVER (PARTITION BY key, win ORDER BY step) AS version FROM fired)"""


@query("late_window_firings", f"""
WITH {EVENTS}, {STEPS_SQL}, {firings_sql("user_id", "cents")}
SELECT 'window' AS kind, key AS user_id, make_timestamp(win) AS window_start, version::BIGINT AS version, n::BIGINT AS n,
       total::BIGINT AS total, NULL::BIGINT AS event_id FROM versions
UNION ALL
SELECT 'late', user_id, make_timestamp(win), NULL, NULL, NULL, event_id FROM routed WHERE route = 'late'""")
def late_window_firings(spark, sf_dir):
    """Firings of daily windows per user, again for accepted late rows; later rows in the side output."""
    replay = delivered(spark, sf_dir, "late-firings")
    fired = replay.to_table(firing_windows(timed(replay), "ts", SIZE, ["user_id"], "cents", "event_id", LATENESS))
    return fired.select("kind", "user_id", plain(instant("window_start")).alias("window_start"), "version", "n", "total",
                        F.col("row_id").alias("event_id"))


@query("early_firings", f"""
WITH {EVENTS}, {STEPS_SQL}, {firings_sql("event_type", "cents")},
opened AS (SELECT event_type AS key, win, min(step) AS step, arg_min(route, step) AS route FROM routed WHERE route <> 'late' GROUP BY ALL),
firsts AS (SELECT o.key, o.win, o.step, min(r.pos) // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS tick
           FROM opened o JOIN routed r ON r.event_type = o.key AND r.win = o.win AND r.step = o.step
           WHERE o.route = 'on_time' GROUP BY ALL),
ticks AS (SELECT key, win, step, unnest(generate_series(tick, win + {DAY} - 1, {6 * HOUR})) AS fire FROM firsts),
passed AS (SELECT t.key, t.win, t.fire, min(m.step) AS step FROM ticks t JOIN m ON m.mark >= t.fire AND m.step >= t.step GROUP BY ALL),
early AS (SELECT p.key, p.win, p.step, p.fire, max_by(s.n, s.step) AS n, max_by(s.total, s.step) AS total
          FROM passed p JOIN sums s ON s.key = p.key AND s.win = p.win AND s.step <= p.step GROUP BY ALL)
SELECT key AS event_type, make_timestamp(win) AS window_start, make_timestamp(fire) AS fire_at,
       row_number() OVER (PARTITION BY key, win ORDER BY step, fire) AS version, n::BIGINT AS n, total::BIGINT AS total
FROM (SELECT * FROM early UNION ALL SELECT key, win, step, win + {DAY}, n, total FROM fired)""")
def early_firings(spark, sf_dir):
    """Every firing of daily windows that also fire on each six-hour mark the watermark passes."""
    replay = delivered(spark, sf_dir, "early-firings")
    fired = replay.to_table(firing_windows(
        timed(replay), "ts", SIZE, ["event_type"], "cents", "event_id", LATENESS, every="6 hours"))
    return fired.filter(F.col("kind") == WINDOW).select(
        "event_type", plain(instant("window_start")).alias("window_start"), plain(instant("fire_at")).alias("fire_at"),
        "version", "n", "total")


@query("fire_and_purge", f"""
WITH {EVENTS}, {STEPS_SQL}
SELECT user_id, make_timestamp(win) AS window_start,
       row_number() OVER (PARTITION BY user_id, win ORDER BY step) AS version, count(*) AS n, sum(cents)::BIGINT AS total
FROM routed WHERE route <> 'late' GROUP BY user_id, win, step""")
def fire_and_purge(spark, sf_dir):
    """A window fires with each batch's rows alone and forgets them; the versions of a window add up to its total."""
    replay = delivered(spark, sf_dir, "purge")
    fired = replay.to_table(firing_windows(
        timed(replay), "ts", SIZE, ["user_id"], "cents", "event_id", LATENESS, purge=True))
    return fired.filter(F.col("kind") == WINDOW).select(
        "user_id", plain(instant("window_start")).alias("window_start"), "version", "n", "total")


@query("hot_urls_topn_late", f"""
WITH {EVENTS}, {STEPS_SQL}, {firings_sql("item", "cents")},
lists AS (SELECT win, step, dense_rank() OVER (PARTITION BY win ORDER BY step) AS version FROM (SELECT DISTINCT win, step FROM fired)),
held AS (SELECT l.win, l.version, f.key AS item, max_by(f.n, f.step) AS cnt
         FROM lists l JOIN fired f ON f.win = l.win AND f.step <= l.step GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY win, version ORDER BY cnt DESC, item) AS rank FROM held)
SELECT make_timestamp(win) AS window_start, version::BIGINT AS version, item, cnt::BIGINT AS cnt, rank FROM r WHERE rank <= 5""")
def hot_urls_topn_late(spark, sf_dir):
    """The top five of a day, and the whole list again each time late rows change the day's counts.

    Counts are kept per window and item, so no window is one task's state; a batch ranks only the windows it changed,
    from the newest counts in the log of firings.
    """
    replay = delivered(spark, sf_dir, "late-top")
    log = scratch_dir(spark, "late-top-counts")
    save = keyed_batches(log)

    def ranked(batch, batch_id):
        save(batch.filter(F.col("kind") == WINDOW), batch_id)
        counts = spark.read.option("basePath", log).parquet(f"{log}/{BATCH}=*").filter(F.col(BATCH) <= batch_id)
        changed = counts.filter(F.col(BATCH) == batch_id).select("window_start").distinct()
        newest = counts.join(changed, "window_start", "left_semi").groupBy("window_start", "item").agg(
            F.max_by("n", "version").alias("cnt"))
        return r.top_n(newest, ["window_start"], [F.desc("cnt"), "item"], 5)

    lists = replay.to_batches(firing_windows(
        timed(replay), "ts", SIZE, ["item"], "cents", "event_id", LATENESS), ranked, "append")
    numbered = lists.select("window_start", BATCH).distinct().withColumn(
        "version", F.expr(f"row_number() OVER (PARTITION BY window_start ORDER BY {BATCH})").cast("long"))
    return lists.join(numbered, ["window_start", BATCH]).select(
        plain(instant("window_start")).alias("window_start"), "version", "item", "cnt", "rank")
