"""Queries over joins and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, MINUTE, events, query, table
from tidemark.operators import joins as j
from tidemark.operators import windows as w
from tidemark.plans.ordered import asof_latest
from tidemark.plans.timing import plain


def of_type(spark, sf_dir, kind: str, prefix: str):
    """Events of one type with the columns ``user_id``, ``<prefix>_id``, ``<prefix>_ts``."""
    return events(spark, sf_dir).filter(F.col("event_type") == kind).select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


@query("interval_join", f"""
WITH {EVENTS}
SELECT c.user_id, c.event_id AS click_id, p.event_id AS buy_id, c.ts AS click_ts, p.ts AS buy_ts
FROM ev c JOIN ev p ON c.user_id = p.user_id AND p.pos BETWEEN c.pos - {HOUR} AND c.pos + {6 * HOUR}
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def interval_join(spark, sf_dir):
    out = j.interval_join(
        of_type(spark, sf_dir, "click", "click"), of_type(spark, sf_dir, "purchase", "buy"),
        ["user_id"], "click_ts", "buy_ts", "-1 hour", "6 hours")
    return out.withColumn("click_ts", plain("click_ts")).withColumn("buy_ts", plain("buy_ts"))


@query("window_join", f"""
WITH {EVENTS}
SELECT make_timestamp(c.pos // {6 * HOUR} * {6 * HOUR}) AS window_start,
       make_timestamp((c.pos // {6 * HOUR} + 1) * {6 * HOUR}) AS window_end,
       c.user_id, c.event_id AS click_id, p.event_id AS buy_id
FROM ev c JOIN ev p ON c.user_id = p.user_id AND c.pos // {6 * HOUR} = p.pos // {6 * HOUR}
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def window_join(spark, sf_dir):
    out = j.window_join(
        of_type(spark, sf_dir, "click", "click"), of_type(spark, sf_dir, "purchase", "buy"),
        ["user_id"], "click_ts", "buy_ts", "6 hours")
    return w.flatten_window(out, "user_id", "click_id", "buy_id")


@query("window_cogroup_left", f"""
SELECT make_timestamp(epoch_us(o_orderdate) // {28 * DAY} * {28 * DAY}) AS window_start,
       o_orderkey, l_linenumber, l_partkey
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
     AND epoch_us(o_orderdate) // {28 * DAY} = epoch_us(l_shipdate) // {28 * DAY}""")
def window_cogroup_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate")
    out = j.window_join(orders, lines, ["o_orderkey"], "o_orderdate", "l_shipdate", "28 days", "left")
    return out.select(plain("window.start").alias("window_start"), "o_orderkey", "l_linenumber", "l_partkey")


MATCH_SQL = f"""
WITH RECURSIVE a AS (
  SELECT o_orderkey AS orderkey, epoch_us(o_orderdate) AS pos, 0 AS side, o_orderdate AS seen, CAST(NULL AS BIGINT) AS line FROM orders
  UNION ALL SELECT l_orderkey, epoch_us(l_shipdate), 1, l_shipdate, l_linenumber FROM lineitem),
s AS (SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY pos, side, line) AS rn FROM a),
m AS (SELECT orderkey, rn, side AS wside, pos AS wpos, seen AS wat, line AS wline, CAST(NULL AS VARCHAR) AS status,
             CAST(NULL AS TIMESTAMP) AS o_orderdate, CAST(NULL AS BIGINT) AS l_linenumber, CAST(NULL AS TIMESTAMP) AS shipdate
      FROM s WHERE rn = 1
      UNION ALL
      SELECT orderkey, rn, CASE WHEN NOT pair THEN side END, CASE WHEN NOT pair THEN pos END,
             CASE WHEN NOT pair THEN seen END, CASE WHEN NOT pair THEN line END,
             CASE WHEN pair THEN 'matched' WHEN wside = 0 THEN 'only_left' WHEN wside = 1 THEN 'only_right' END,
             CASE WHEN wside = 0 THEN wat WHEN pair THEN seen END, CASE WHEN wside = 1 THEN wline WHEN pair THEN line END,
             CASE WHEN wside = 1 THEN wat WHEN pair THEN seen END
      FROM (SELECT s.*, wside, wat, wline, coalesce(wside <> side AND s.pos - wpos <= {30 * DAY}, FALSE) AS pair
            FROM m JOIN s ON s.orderkey = m.orderkey AND s.rn = m.rn + 1) n)
SELECT orderkey, status, o_orderdate, l_linenumber, shipdate FROM m WHERE status IS NOT NULL
UNION ALL
SELECT orderkey, CASE wside WHEN 0 THEN 'only_left' ELSE 'only_right' END, CASE wside WHEN 0 THEN wat END, wline,
       CASE wside WHEN 1 THEN wat END
FROM (SELECT *, max(rn) OVER (PARTITION BY orderkey) AS last FROM m) WHERE rn = last AND wside IS NOT NULL"""


@query("two_stream_match", MATCH_SQL)
def two_stream_match(spark, sf_dir):
    """Every order and every line of it: shipped within 30 days, or alone."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.col("l_shipdate").alias("shipdate"))
    out = j.match_streams(orders, lines, ["orderkey"], "o_orderdate", "shipdate", "30 days")
    return out.withColumn("o_orderdate", plain("o_orderdate")).withColumn("shipdate", plain("shipdate"))


@query("stream_equi_join", """
SELECT o_orderkey, l_linenumber, o_orderpriority, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def stream_equi_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(
        "o_orderkey", "l_linenumber", "o_orderpriority", plain("l_shipdate").alias("l_shipdate"))


@query("dim_join_reload", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def dim_join_reload(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return j.lookup(lines, parts, ["p_partkey"], "left").withColumnRenamed("p_partkey", "l_partkey")


@query("dim_join_then_window_count", f"""
SELECT make_timestamp(epoch_us(l_shipdate) // {7 * DAY} * {7 * DAY}) AS window_start,
       make_timestamp((epoch_us(l_shipdate) // {7 * DAY} + 1) * {7 * DAY}) AS window_end, p_brand, count(*) AS clicks
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def dim_join_then_window_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_shipdate")
    # Counted per part first: the join then meets one row per part and window.
    per_part = w.tumbling(lines, "l_shipdate", "7 days", ["p_partkey"], n=F.count(F.lit(1)))
    named = j.lookup(per_part, table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_partkey"], "left")
    return w.flatten_window(named.groupBy("window", "p_brand").agg(F.sum("n").alias("clicks")))


def order_lookup(spark, sf_dir, how: str, salted: bool = False):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"))
    # Customers in debt are missing from the store.
    store = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_name")
    return j.lookup(orders, store, ["c_custkey"], how, salted)


LOOKUP_SQL = """SELECT o_orderkey, o_custkey AS c_custkey, c_name FROM orders {how} JOIN
(SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey"""


@query("lookup_join_inner", LOOKUP_SQL.format(how=""))
def lookup_join_inner(spark, sf_dir):
    return order_lookup(spark, sf_dir, "inner")


@query("lookup_join_left", LOOKUP_SQL.format(how="LEFT"))
def lookup_join_left(spark, sf_dir):
    return order_lookup(spark, sf_dir, "left")


@query("lookup_join_salted", LOOKUP_SQL.format(how="LEFT"))
def lookup_join_salted(spark, sf_dir):
    return order_lookup(spark, sf_dir, "left", salted=True)


@query("lookup_composed_key", """
SELECT o_orderkey, 'userInfo:userId:' || o_custkey || ':userName' AS store_key, c_name
FROM orders JOIN customer ON o_custkey = c_custkey""")
def lookup_composed_key(spark, sf_dir):
    store = table(spark, sf_dir, "customer").select(
        j.composed_key("userInfo", "userId", F.col("c_custkey").cast("string"), "userName").alias("store_key"), "c_name")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        j.composed_key("userInfo", "userId", F.col("o_custkey").cast("string"), "userName").alias("store_key"))
    return j.lookup(orders, store, ["store_key"])


@query("broadcast_rule_replace", """
SELECT s_suppkey, coalesce(n_name, CAST(s_nationkey AS VARCHAR)) AS code
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey""")
def broadcast_rule_replace(spark, sf_dir):
    rules = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(
        F.col("n_nationkey").cast("string").alias("rule_code"), "n_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("code"))
    return j.replace_by_rules(suppliers, rules, "code", "rule_code", "n_name")


@query("broadcast_rule_semi", """
SELECT c_custkey, c_nationkey AS n_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def broadcast_rule_semi(spark, sf_dir):
    rules = table(spark, sf_dir, "nation").filter("n_regionkey = 1")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return j.keep_ruled(customers, rules, "n_nationkey").select("c_custkey", "n_nationkey")


KEYWORD_SQL = """
WITH k AS (SELECT conv_id, arg_min(lower(split_part(text, ' ', 1)), turn) AS keyword FROM conversations GROUP BY conv_id),
m AS (SELECT doc_id, coalesce(keyword, 'java') AS keyword, text
      FROM documents ASOF LEFT JOIN k ON doc_id >= conv_id)
SELECT doc_id, keyword FROM m WHERE contains(text, keyword)"""


@query("broadcast_keyword_filter", KEYWORD_SQL)
def broadcast_keyword_filter(spark, sf_dir):
    """Documents in id order against the newest keyword (first word of each conversation)."""
    talks = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("text")).select(
        "conv_id", F.lower(F.split_part("text", F.lit(" "), F.lit(1))).alias("keyword"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return j.keyword_filter(docs, talks, ["doc_id"], "conv_id", "keyword", "text", "java").select(
        "doc_id", "keyword")


@query("broadcast_map_lookup", """
SELECT p_partkey, p_type, n AS suppliers FROM part
LEFT JOIN (SELECT 'SMALL' AS p_type, count(*) AS n FROM supplier UNION ALL SELECT 'ECONOMY', count(*) FROM region) USING (p_type)""")
def broadcast_map_lookup(spark, sf_dir):
    entries = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("suppliers")).select(
        F.lit("SMALL").alias("p_type"), "suppliers").unionByName(
        table(spark, sf_dir, "region").agg(F.count(F.lit(1)).alias("suppliers")).select(
            F.lit("ECONOMY").alias("p_type"), "suppliers"))
    return j.map_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_type"), entries, "p_type", "suppliers")


@query("asof_join", f"""
WITH {EVENTS},
p AS (SELECT * FROM ev WHERE event_type = 'purchase'), v AS (SELECT * FROM ev WHERE event_type = 'view')
SELECT p.event_id, p.user_id, v.event_id AS view_id, v.cents AS view_cents
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.pos >= v.pos""")
def asof_join(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "pos", "cents", "event_type")
    buys = rows.filter("event_type = 'purchase'").select("event_id", "user_id", "pos")
    views = rows.filter("event_type = 'view'").select(
        "user_id", F.col("pos").alias("view_pos"), F.col("event_id").alias("view_id"),
        F.col("cents").alias("view_cents"))
    return asof_latest(buys, views, ["user_id"], ["pos", "event_id"], "view_pos",
                       ["view_id", "view_cents"], right_tie=["view_id"]).drop("pos")


@query("lookup_with_age", f"""
WITH {EVENTS},
p AS (SELECT * FROM ev WHERE event_type = 'purchase'), s AS (SELECT * FROM ev WHERE event_type = 'signup')
SELECT p.event_id, p.user_id, CASE WHEN p.pos - s.pos <= {2 * DAY} THEN s.event_id END AS signup_id,
       CASE WHEN s.pos IS NULL THEN 'miss' WHEN p.pos - s.pos <= {2 * DAY} THEN 'hit' ELSE 'stale' END AS lookup
FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.pos >= s.pos""")
def lookup_with_age(spark, sf_dir):
    """Purchases look up the user's newest sign-up, which counts for two days."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "pos", "event_type")
    history = rows.filter("event_type = 'signup'").select(
        "user_id", F.col("pos").alias("valid_pos"), F.col("event_id").alias("signup_id"))
    buys = rows.filter("event_type = 'purchase'").select("event_id", "user_id", "pos")
    return j.lookup_fresh(buys, history, ["user_id"], ["pos", "event_id"], "valid_pos", ["signup_id"], "2 days",
                          tie=["signup_id"]).drop("pos")
