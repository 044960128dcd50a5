"""Queries over top-N rankings and row comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, MINUTE, events, query, table
from tidemark.jobs.routing import WORDS
from tidemark.jobs.windows import sliding_starts
from tidemark.operators import ranking as r
from tidemark.operators import windows as w
from tidemark.operators.routing import tokens
from tidemark.plans.timing import plain

HOT_ITEMS_SQL = f"""
WITH {EVENTS},
s AS (SELECT item, unnest({sliding_starts(HOUR, 10 * MINUTE)}) AS st FROM ev WHERE event_type = 'view'),
c AS (SELECT st, item, count(*) AS cnt FROM s GROUP BY st, item),
r AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY cnt DESC, item) AS rank FROM c)
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end, item, cnt, rank
FROM r WHERE rank <= 3"""


def hot_items(views):
    counts = w.sliding(views, "ts", "1 hour", "10 minutes", ["item"], cnt=F.count(F.lit(1)))
    return r.top_n(counts, ["window.start"], [F.desc("cnt"), "item"], 3)


@query("hot_items_topn", HOT_ITEMS_SQL)
def hot_items_topn(spark, sf_dir):
    views = events(spark, sf_dir).filter("event_type = 'view'").select("ts", "item")
    return w.flatten_window(hot_items(views))


@query("hot_items_report", f"""
WITH {EVENTS},
c AS (SELECT pos // {DAY} AS d, item, count(*) AS cnt FROM ev WHERE event_type = 'view' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY cnt DESC, item) AS rank FROM c)
SELECT strftime(make_timestamp((d + 1) * {DAY}), '%Y-%m-%d %H:%M:%S') || ' No' || rank || ': item ' || item || ' views ' || cnt AS line
FROM r WHERE rank <= 3""")
def hot_items_report(spark, sf_dir):
    from tidemark.functions.scalar import DATE_TIME, report_line

    views = events(spark, sf_dir).filter("event_type = 'view'")
    counts = w.tumbling(views, "ts", "1 day", ["item"], cnt=F.count(F.lit(1)))
    top = r.top_n(counts, ["window.start"], [F.desc("cnt"), "item"], 3)
    return top.select(report_line(
        "%s No%d: item %d views %d", F.date_format("window.end", DATE_TIME),
        F.col("rank"), F.col("item"), F.col("cnt")).alias("line"))


@query("hot_urls_topn", f"""
WITH {EVENTS},
s AS (SELECT url, unnest(generate_series((pos // {5 * MINUTE}) * {5 * MINUTE} - {55 * MINUTE},
                                         (pos // {5 * MINUTE}) * {5 * MINUTE}, {5 * MINUTE})) AS st
      FROM ev JOIN pages ON page_id = item),
c AS (SELECT st, url, count(*) AS cnt FROM s GROUP BY st, url),
r AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY cnt DESC, url) AS rank FROM c)
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end, url, cnt, rank
FROM r WHERE rank <= 3""")
def hot_urls_topn(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("item"), "url")
    visits = events(spark, sf_dir).select("ts", "item").join(pages, "item")
    counts = w.sliding(visits, "ts", "1 hour", "5 minutes", ["url"], cnt=F.count(F.lit(1)))
    return w.flatten_window(r.top_n(counts, ["window.start"], [F.desc("cnt"), "url"], 3))


AREA_ORDERS_SQL = """
ao AS (SELECT n_name AS area, c_custkey, o_orderkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def area_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").alias("c_custkey"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    return orders.join(customers.join(nations, "n_nationkey"), "c_custkey")


@query("window_group_topn", f"""
WITH {AREA_ORDERS_SQL},
s AS (SELECT epoch_us(o_orderdate) // {28 * DAY} AS w, area, c_custkey, sum(cents)::BIGINT AS cents FROM ao GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY w, area ORDER BY cents DESC, c_custkey) AS rank FROM s)
SELECT make_timestamp(w * {28 * DAY}) AS window_start, make_timestamp((w + 1) * {28 * DAY}) AS window_end,
       area, c_custkey, cents, rank
FROM r WHERE rank <= 3""")
def window_group_topn(spark, sf_dir):
    sums = w.tumbling(area_orders(spark, sf_dir), "o_orderdate", "28 days", ["area", "c_custkey"],
                      cents=F.sum("cents"))
    top = r.top_n(sums, ["window.start", "area"], [F.desc("cents"), "c_custkey"], 3)
    return w.flatten_window(top)


@query("global_group_topn", f"""
WITH {AREA_ORDERS_SQL},
s AS (SELECT area, c_custkey, sum(cents)::BIGINT AS cents FROM ao GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY cents DESC, c_custkey) AS rank FROM s)
SELECT area, c_custkey, cents, rank FROM r WHERE rank <= 10""")
def global_group_topn(spark, sf_dir):
    sums = area_orders(spark, sf_dir).groupBy("area", "c_custkey").agg(F.sum("cents").alias("cents"))
    return r.top_n(sums, ["area"], [F.desc("cents"), "c_custkey"], 10)


@query("two_stage_topn", f"""
WITH c AS (SELECT word, count(*) AS cnt FROM (SELECT {WORDS} AS word FROM documents) WHERE word <> '' GROUP BY word),
f AS (SELECT *, substring(word, 1, 1) AS grp,
             row_number() OVER (PARTITION BY substring(word, 1, 1) ORDER BY cnt DESC, word) AS rn FROM c)
SELECT word, cnt, grp FROM f WHERE rn <= 2 ORDER BY cnt DESC, word LIMIT 5""")
def two_stage_topn(spark, sf_dir):
    words = tokens(table(spark, sf_dir, "documents").select("text"), "text")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return r.two_stage_top_n(counts, "word", "cnt", F.substring("word", 1, 1), 2, 5)


@query("login_fail_consecutive", f"""
WITH {EVENTS},
l AS (SELECT *, lag(event_type) OVER w AS pt, lag(pos) OVER w AS pp FROM ev
      WHERE event_type IN ('error', 'signup') WINDOW w AS (PARTITION BY user_id ORDER BY pos, event_id))
SELECT user_id, event_id, make_timestamp(pp) AS first_fail, make_timestamp(pos) AS second_fail
FROM l WHERE event_type = 'error' AND pt = 'error' AND pos - pp < {4 * HOUR}""")
def login_fail_consecutive(spark, sf_dir):
    logins = events(spark, sf_dir).filter("event_type IN ('error', 'signup')").select(
        "user_id", "event_id", "event_type", "pos")
    hits = r.previous_within(logins, ["user_id"], ["pos", "event_id"], "event_type", "error", "4 hours")
    return hits.select(
        "user_id", "event_id", plain(F.timestamp_micros("prev_pos")).alias("first_fail"),
        plain(F.timestamp_micros("pos")).alias("second_fail"))


@query("value_jump_alert", f"""
WITH {EVENTS}, l AS (SELECT *, lag(cents) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS prev FROM ev)
SELECT user_id, event_id, prev AS prev_cents, cents FROM l WHERE prev <> 0 AND abs(prev - cents) > 3000""")
def value_jump_alert(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "pos", "cents")
    return r.value_jumps(rows, ["user_id"], ["pos", "event_id"], "cents", 3000).drop("pos")


@query("keep_first", f"""
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def keep_first(spark, sf_dir):
    return r.keep_first(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"),
                        ["user_id"], ["event_id"])


@query("sort_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def sort_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(20)
