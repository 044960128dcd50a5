"""Streaming twins, run over the whole table and read back.

An append-mode result holds what the watermark has closed.  So that nothing stays
open at the end of the input, a flush row far behind the last event moves the
watermark past all of them; it never leaves its own window or queue.  Where
time going on would itself make results (repeated alerts), there is no flush row
and the oracle stops at the watermark.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.detection import CLICKS_SQL, ORDER, SYMBOL_SQL, TRANSITION_ROWS, with_symbols
from tidemark.jobs.ranking import HOT_ITEMS_SQL, AREA_ORDERS_SQL
from tidemark.jobs.registry import DAY, EVENTS, HOUR, MINUTE, query, table, tumble_sql, with_event_columns
from tidemark.jobs.windows import SESSION_SQL, sliding_starts
from tidemark.operators import distinct as d
from tidemark.operators import joins as j
from tidemark.operators import ranking as r
from tidemark.operators import windows as w
from tidemark.plans.timing import plain
from tidemark.session import scratch_dir
from tidemark.streaming import rules
from tidemark.streaming.ordered import apply_rule
from tidemark.streaming.run import (
    finish, newest, stream_of, to_batches, to_table, use_rocksdb,
)
from tidemark.streaming.state import fresh_visitors

DELAY = "10 minutes"


def mark() -> str:
    """Where the watermark ends up without a flush row, in SQL: Spark keeps it in whole milliseconds."""
    return f"(SELECT (max(epoch_us(ts)) // 1000) * 1000 - {10 * MINUTE} FROM events)"


def flush_row(spark, sf_dir, *kinds: str):
    """A stream of one row ten years behind the last event, of the first of some types, without any other value."""
    rows = table(spark, sf_dir, "events")
    stamp = F.max("ts") + F.expr("INTERVAL 10 YEARS")
    last = rows.agg(stamp.alias("ts")).filter("ts IS NOT NULL").withColumn("event_type", F.lit(kinds[0] if kinds else None).cast("string"))
    schema = rows.schema
    folder = scratch_dir(spark, "flush")
    last.select(*[F.col(f.name) if f.name in last.columns else F.lit(None).cast(f.dataType).alias(f.name)
                  for f in schema.fields]).write.parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


def event_stream(spark, sf_dir, *kinds: str, flush: bool = False):
    """Events as a stream; of some types only, the watermark follows the events of these types."""
    use_rocksdb(spark)
    rows = stream_of(spark, sf_dir, "events")
    if flush:
        rows = rows.unionByName(flush_row(spark, sf_dir, *kinds))
    if kinds:
        rows = rows.filter(F.col("event_type").isin(*kinds))
    return with_event_columns(rows.withWatermark("ts", DELAY))


@query("window_count_by_key_stream", f"""
SELECT {tumble_sql(HOUR)} AS window_start, {tumble_sql(HOUR)} + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS cnt
FROM events GROUP BY ALL""")
def window_count_by_key_stream(spark, sf_dir):
    counts = w.tumbling(event_stream(spark, sf_dir, flush=True), "ts", "1 hour", ["user_id"], cnt=F.count(F.lit(1)))
    return to_table(w.flatten_window(counts), "counts")


@query("pv_sliding_stream", f"""
WITH {EVENTS}, s AS (SELECT unnest({sliding_starts(HOUR, 10 * MINUTE)}) AS st FROM ev WHERE event_type = 'view')
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end, count(*) AS pv FROM s GROUP BY st""")
def pv_sliding_stream(spark, sf_dir):
    out = w.sliding(event_stream(spark, sf_dir, "view", flush=True), "ts", "1 hour", "10 minutes", pv=F.count(F.lit(1)))
    return to_table(w.flatten_window(out), "pv-sliding")


@query("uv_window_exact_stream", f"""
SELECT {tumble_sql(HOUR)} AS window_start, {tumble_sql(HOUR)} + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL""")
def uv_window_exact_stream(spark, sf_dir):
    return to_table(w.flatten_window(d.exact_uv(event_stream(spark, sf_dir, flush=True), "ts", "1 hour", "user_id")), "uv")


@query("hot_items_topn_stream", HOT_ITEMS_SQL)
def hot_items_topn_stream(spark, sf_dir):
    """All items of a window leave the state in the batch that closes it, so each batch ranks whole windows."""
    views = event_stream(spark, sf_dir, "view", flush=True)
    counts = w.sliding(views, "ts", "1 hour", "10 minutes", ["item"], cnt=F.count(F.lit(1)))
    ranked = to_batches(
        counts, "hot-items",
        lambda batch, _: w.flatten_window(r.top_n(batch, ["window.start"], [F.desc("cnt"), "item"], 3)), "append")
    return ranked.drop("batch")


@query("session_window_count_stream", SESSION_SQL)
def session_window_count_stream(spark, sf_dir):
    out = w.sessions(event_stream(spark, sf_dir, flush=True), "ts", "2 hours", ["user_id"], cnt=F.count(F.lit(1)))
    return to_table(w.flatten_window(out), "sessions")


@query("sql_tumble_sum_stream", f"""
WITH {EVENTS}
SELECT event_type AS behavior, make_timestamp((pos // {5 * MINUTE} + 1) * {5 * MINUTE}) AS window_end, sum(item)::BIGINT AS total
FROM ev GROUP BY ALL""")
def sql_tumble_sum_stream(spark, sf_dir):
    event_stream(spark, sf_dir, flush=True).createOrReplaceTempView("tidemark_fruit_stream")
    out = spark.sql("""
        SELECT event_type AS behavior, CAST(window(ts, '5 minutes').end AS TIMESTAMP_NTZ) AS window_end, sum(item) AS total
        FROM tidemark_fruit_stream GROUP BY event_type, window(ts, '5 minutes')""")
    return to_table(out, "tumble-sum")


@query("keep_first_stream", "SELECT DISTINCT user_id, event_type FROM events")
def keep_first_stream(spark, sf_dir):
    seen = event_stream(spark, sf_dir).select("user_id", "event_type")
    return to_table(r.keep_first(seen, ["user_id", "event_type"], []), "keep-first")


@query("interval_join_stream", f"""
WITH {EVENTS}
SELECT c.user_id, c.event_id AS click_id, p.event_id AS buy_id
FROM ev c JOIN ev p ON c.user_id = p.user_id AND p.pos BETWEEN c.pos - {HOUR} AND c.pos + {6 * HOUR}
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def interval_join_stream(spark, sf_dir):
    side = lambda kind, prefix: event_stream(spark, sf_dir, kind).select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))
    out = j.interval_join(side("click", "click"), side("purchase", "buy"), ["user_id"],
                          "click_ts", "buy_ts", "-1 hour", "6 hours")
    return to_table(out.select("user_id", "click_id", "buy_id"), "interval-join")


@query("stream_full_outer_join", f"""
WITH m AS (SELECT (max(epoch_us(o_orderdate)) // 1000) * 1000 AS a FROM orders),
n AS (SELECT (max(epoch_us(l_shipdate)) // 1000) * 1000 AS b FROM lineitem),
p AS (SELECT o_orderkey, l_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      AND epoch_us(l_shipdate) BETWEEN epoch_us(o_orderdate) AND epoch_us(o_orderdate) + {61 * 12 * HOUR})
SELECT o_orderkey, l_orderkey, l_linenumber FROM p
UNION ALL SELECT o_orderkey, NULL, NULL FROM orders, m, n
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM p) AND epoch_us(o_orderdate) + {61 * 12 * HOUR} < least(a, b) - {DAY // 2}
UNION ALL SELECT NULL, l_orderkey, l_linenumber FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
      AND epoch_us(l_shipdate) BETWEEN epoch_us(o_orderdate) AND epoch_us(o_orderdate) + {61 * 12 * HOUR}, m, n
  WHERE o_orderkey IS NULL AND epoch_us(l_shipdate) < least(a, b) - {DAY // 2}""")
def stream_full_outer_join(spark, sf_dir):
    """Orders and the lines shipped within a month of them; what stays alone leaves when its time is over."""
    use_rocksdb(spark)
    orders = stream_of(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").withWatermark("o_orderdate", "12 hours")
    lines = stream_of(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate").withWatermark("l_shipdate", "12 hours")
    near = F.expr("o_orderkey = l_orderkey AND l_shipdate >= o_orderdate"
                  " AND l_shipdate <= o_orderdate + INTERVAL 732 HOURS")
    return to_table(orders.join(lines, near, "full").select("o_orderkey", "l_orderkey", "l_linenumber"), "outer")


@query("early_fire_stream", f"""
SELECT {tumble_sql(DAY)} AS window_start, {tumble_sql(DAY)} + INTERVAL 1 DAY AS window_end, event_type,
       sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS running_sum
FROM events GROUP BY ALL""")
def early_fire_stream(spark, sf_dir):
    """Update mode: each batch re-emits the windows it changed, the sink keeps the newest version."""
    sums = w.tumbling(event_stream(spark, sf_dir), "ts", "1 day", ["event_type"], running_sum=F.sum("cents"))
    fired = to_batches(sums, "early-fire", lambda batch, _: w.flatten_window(batch), "update")
    return newest(fired, ["window_start", "window_end", "event_type"])


@query("hot_urls_topn_late_stream", f"""
WITH {EVENTS},
c AS (SELECT pos // {10 * MINUTE} AS w, item, count(*) AS cnt FROM ev GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY cnt DESC, item) AS rank FROM c)
SELECT make_timestamp(w * {10 * MINUTE}) AS window_start, make_timestamp((w + 1) * {10 * MINUTE}) AS window_end, item, cnt, rank
FROM r WHERE rank <= 5""")
def hot_urls_topn_late_stream(spark, sf_dir):
    """Rankings that late rows may still change: counts re-emitted on update, ranked in their newest version."""
    counts = w.tumbling(event_stream(spark, sf_dir), "ts", "10 minutes", ["item"], cnt=F.count(F.lit(1)))
    kept = newest(to_batches(counts, "late-top", lambda batch, _: w.flatten_window(batch), "update"),
                  ["window_start", "window_end", "item"])
    return r.top_n(kept, ["window_start", "window_end"], [F.desc("cnt"), "item"], 5)


MATCH_STREAM_SQL = f"""
WITH RECURSIVE {EVENTS},
s AS (SELECT user_id, item, event_id AS id, pos, CASE event_type WHEN 'click' THEN 'left' ELSE 'right' END AS side,
             row_number() OVER (PARTITION BY user_id, item ORDER BY pos, event_id) AS rn
      FROM ev WHERE event_type IN ('click', 'purchase')),
m AS (SELECT user_id, item, rn, side AS wside, pos AS wpos, id AS wid,
             CAST(NULL AS BIGINT) AS left_id, CAST(NULL AS BIGINT) AS right_id, CAST(NULL AS VARCHAR) AS status
      FROM s WHERE rn = 1
      UNION ALL
      SELECT n.user_id, n.item, n.rn,
             CASE WHEN pair THEN NULL ELSE side END, CASE WHEN pair THEN NULL ELSE pos END, CASE WHEN pair THEN NULL ELSE id END,
             CASE WHEN pair AND side = 'left' THEN id WHEN wside = 'left' THEN wid END,
             CASE WHEN pair AND side = 'right' THEN id WHEN wside = 'right' THEN wid END,
             CASE WHEN pair THEN 'matched' ELSE 'only_' || wside END
      FROM (SELECT s.*, m.wside, m.wpos, m.wid,
                   coalesce(m.wpos + {5 * DAY} >= s.pos AND m.wside <> s.side, FALSE) AS pair
            FROM m JOIN s ON s.user_id = m.user_id AND s.item = m.item AND s.rn = m.rn + 1) n),
fin AS (SELECT user_id, item, arg_max(coalesce(wside, ''), rn) AS wside, arg_max(coalesce(wpos, 0), rn) AS wpos,
               arg_max(coalesce(wid, -1), rn) AS wid FROM m GROUP BY ALL)
SELECT user_id, item, left_id, right_id, status FROM m WHERE status IS NOT NULL
UNION ALL
SELECT user_id, item, CASE WHEN wside = 'left' THEN wid END, CASE WHEN wside = 'right' THEN wid END, 'only_' || wside
FROM fin WHERE wside <> ''"""


@query("two_stream_match_stream", MATCH_STREAM_SQL)
def two_stream_match_stream(spark, sf_dir):
    """Clicks and purchases of one item by one user, paired within five days or reported alone."""
    sides = event_stream(spark, sf_dir, "click", "purchase", flush=True).withColumn(
        "event_type", F.when(F.col("event_type") == "click", "left").otherwise("right"))
    rows = sides.select("user_id", "item", "ts", *ORDER, "event_type")
    return to_table(apply_rule(rows, ["user_id", "item"], rules.MatchStreams(5 * DAY)), "match")


@query("latest_status_count_stream", """
SELECT status, count(*) AS devices FROM (
  SELECT user_id, arg_max(event_type, (ts, event_type)) AS status FROM events GROUP BY user_id)
GROUP BY status""")
def latest_status_count_stream(spark, sf_dir):
    """Aggregate of an aggregate: latest status in state, status counts from its upserted result."""
    latest = event_stream(spark, sf_dir).groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_type")).alias("status"))
    kept = newest(to_batches(latest, "latest", lambda batch, _: batch, "update"), ["user_id"])
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("devices"))


@query("global_group_topn_stream", f"""
WITH {AREA_ORDERS_SQL},
s AS (SELECT area, c_custkey, sum(cents)::BIGINT AS cents FROM ao GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY cents DESC, c_custkey) AS rank FROM s)
SELECT area, c_custkey, cents, rank FROM r WHERE rank <= 10""")
def global_group_topn_stream(spark, sf_dir):
    """Continuous ranking over all time: sums in state, the ranking anew for every batch."""
    use_rocksdb(spark)
    orders = stream_of(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    areas = customers.join(table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area")), "n_nationkey")
    sums = orders.join(areas, "c_custkey").groupBy("area", "c_custkey").agg(F.sum("cents").alias("cents"))
    ranked = to_batches(
        sums, "global-top", lambda batch, _: r.top_n(batch, ["area"], [F.desc("cents"), "c_custkey"], 10), "complete")
    return newest(ranked, ["area", "rank"]).select("area", "c_custkey", "cents", "rank")


@query("dim_join_reload_stream", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def dim_join_reload_stream(spark, sf_dir):
    """Every micro-batch joins the dimension as it is at that moment."""
    lines = stream_of(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")

    def enrich(batch, _):
        parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        return j.lookup(batch, parts, ["l_partkey"], "left")

    return to_batches(lines, "reload", enrich, "append").select("l_orderkey", "l_linenumber", "l_partkey", "p_brand")


@query("sink_partitioned_stream", """
SELECT strftime(ts, '%Y%m%d') AS dt, event_id, user_id FROM events""")
def sink_partitioned_stream(spark, sf_dir):
    dated = event_stream(spark, sf_dir).select("event_id", "user_id", F.date_format("ts", "yyyyMMdd").alias("dt"))
    return to_table(dated, "dated", ["dt"]).select("dt", "event_id", "user_id")


@query("state_as_table", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def state_as_table(spark, sf_dir):
    """The keyed state of a finished run, read from its checkpoint."""
    counts = event_stream(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    checkpoint = scratch_dir(spark, "state")
    finish(counts.writeStream.format("noop").outputMode("update"), checkpoint)
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.user_id").alias("user_id"), F.col("value.count").alias("n"))


@query("uv_daily_cumulative_stream", """
SELECT strftime(ts, '%Y%m%d') AS day, event_type AS url, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL""")
def uv_daily_cumulative_stream(spark, sf_dir):
    seen = event_stream(spark, sf_dir).withColumn("url", F.col("event_type"))
    fresh = fresh_visitors(seen, "ts", "1 day", ["url"], "user_id")
    counted = to_batches(
        fresh, "daily-uv", lambda batch, _: batch.groupBy("window", "url").agg(F.count(F.lit(1)).alias("fresh")), "append")
    return counted.groupBy(F.date_format("window.start", "yyyyMMdd").alias("day"), "url").agg(F.sum("fresh").alias("uv"))


@query("state_machine_alerts_stream", f"""
WITH RECURSIVE {EVENTS},
tr(s, e, t) AS (VALUES {TRANSITION_ROWS}),
o AS (SELECT user_id, event_id, {SYMBOL_SQL} AS event, row_number() OVER (PARTITION BY user_id ORDER BY pos, event_id) AS rn
      FROM ev),
m AS (SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS event,
             CAST('Initial' AS VARCHAR) AS was, CAST('Initial' AS VARCHAR) AS state, TRUE AS legal
      FROM (SELECT DISTINCT user_id FROM o)
      UNION ALL
      SELECT o.user_id, o.rn, o.event_id, o.event, m.state, coalesce(tr.t, m.state), tr.t IS NOT NULL
      FROM m JOIN o ON o.user_id = m.user_id AND o.rn = m.rn + 1 LEFT JOIN tr ON tr.s = m.state AND tr.e = o.event)
SELECT user_id, event_id, event, was AS state FROM m WHERE NOT legal""")
def state_machine_alerts_stream(spark, sf_dir):
    rows = with_symbols(event_stream(spark, sf_dir, flush=True)).withColumn("event_type", F.col("event"))
    return to_table(apply_rule(rows.select("user_id", "ts", *ORDER, "event_type"), ["user_id"], rules.StateMachine()), "machine")


@query("offline_alerts_stream", f"""
WITH {EVENTS},
n AS (SELECT *, lead(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS np, {mark()} - 1 AS fin FROM ev WHERE pos < {mark()}),
s AS (SELECT user_id, pos, event_id, unnest(generate_series(pos + {5 * HOUR}, coalesce(np - 1, fin), {5 * HOUR})) AS fire
      FROM n WHERE event_type = 'error')
SELECT user_id, event_id, (fire - pos) // {5 * HOUR} AS alert_no, make_timestamp(fire) AS alert_at FROM s""")
def offline_alerts_stream(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("user_id", "ts", *ORDER, "event_type")
    out = to_table(apply_rule(rows, ["user_id"], rules.Offline("error", 5 * HOUR)), "offline")
    return out.select("user_id", "event_id", "alert_no", plain(F.timestamp_micros("alert_pos")).alias("alert_at"))


@query("blacklist_stream", f"""
{CLICKS_SQL}
SELECT user_id, ad, event_id, CASE WHEN rn <= 1 THEN 'pass' ELSE 'warn' END AS verdict
FROM c WHERE rn <= 2""")
def blacklist_stream(spark, sf_dir):
    clicks = event_stream(spark, sf_dir, "click", flush=True).withColumn("ad", F.expr("item div 50"))
    rows = clicks.select("user_id", "ad", "ts", *ORDER, "event_type")
    return to_table(apply_rule(rows, ["user_id", "ad"], rules.Blacklist(1)), "blacklist")
