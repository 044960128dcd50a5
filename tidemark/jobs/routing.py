"""Queries over filters, tokens, side outputs, partitioning and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import events, query, table
from tidemark.operators import routing as r
from tidemark.plans.timing import plain

WORDS = r"regexp_split_to_table(lower(text), '[ ,.\t\r\n]+')"


@query("filter_behavior", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'view'""")
def filter_behavior(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "view").select(
        "event_id", "user_id", "value")


@query("filter_static_assets", r"""
SELECT page_id, url FROM pages WHERE NOT regexp_matches(regexp_replace(url, '[?#].*$', ''), '\.(css|js)$')""")
def filter_static_assets(spark, sf_dir):
    path = F.regexp_replace("url", "[?#].*$", "")
    return r.drop_static_assets(table(spark, sf_dir, "pages"), path).select("page_id", "url")


@query("word_count", f"""
SELECT word, count(*) AS cnt FROM (SELECT {WORDS} AS word FROM documents) WHERE word <> '' GROUP BY word""")
def word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return r.tokens(docs, "text").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query("side_output_tokens", f"""
SELECT CASE WHEN length(word) > 5 THEN 'rejected' ELSE 'main' END AS route,
       CASE WHEN length(word) > 5 THEN 'rejected: ' || word ELSE word END AS token, count(*) AS cnt
FROM (SELECT {WORDS} AS word FROM documents) WHERE word <> '' GROUP BY 1, 2""")
def side_output_tokens(spark, sf_dir):
    words = r.tokens(table(spark, sf_dir, "documents").select("text"), "text", name="token")
    routed = r.side_output(words, F.length("token") > 5, "token")
    return routed.groupBy("route", "token").agg(F.count(F.lit(1)).alias("cnt"))


@query("split_select", """
SELECT 'positive' AS tag, c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'rich', c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000
UNION ALL SELECT 'debt', c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0""")
def split_select(spark, sf_dir):
    tagged = r.with_tags(
        table(spark, sf_dir, "customer"), positive=F.col("c_acctbal") >= 0,
        rich=F.col("c_acctbal") > 5000, debt=F.col("c_acctbal") < 0)
    picked = [r.select_tag(tagged, tag).select(F.lit(tag).alias("tag"), "c_custkey", "c_acctbal")
              for tag in ("positive", "rich", "debt")]
    return r.union_all(*picked)


@query("partition_custom", """
SELECT CASE WHEN regexp_matches(code, '[0-9]') THEN 'lower' ELSE 'upper' END AS half,
       count(*) AS n, count(DISTINCT code) AS codes
FROM (SELECT p_brand AS code FROM part UNION ALL SELECT p_type FROM part) GROUP BY 1""")
def partition_custom(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    codes = r.union_all(parts.select("p_partkey", F.col("p_brand").alias("code")),
                        parts.select("p_partkey", F.col("p_type").alias("code")))
    placed = r.partition_halves(codes, "code", 8)
    half = F.when(F.spark_partition_id() < 4, "lower").otherwise("upper")
    return placed.select(half.alias("half"), "code").groupBy("half").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("codes"))


@query("union_streams", """
SELECT 'order' AS kind, CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS ts FROM orders
UNION ALL SELECT 'event', CAST(event_id AS VARCHAR), ts FROM events""")
def union_streams(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("id"),
        plain("o_orderdate").alias("ts"))
    seen = table(spark, sf_dir, "events").select(
        F.lit("event").alias("kind"), F.col("event_id").cast("string").alias("id"), plain("ts").alias("ts"))
    return r.union_all(orders, seen)


@query("distinct_rows", """
SELECT DISTINCT user_id, event_type, json_extract_string(props, '$.k') AS item FROM events""")
def distinct_rows(spark, sf_dir):
    return events(spark, sf_dir).select(
        "user_id", "event_type", F.col("item").cast("string").alias("item")).distinct()
