"""Queries that write through a sink and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import EVENTS, events, query, table
from tidemark.plans.timing import plain
from tidemark.session import scratch_dir
from tidemark.sinks import batched, files
from tidemark.sources.external import to_kafka_value


@query("sink_text", """
SELECT event_type || ':' || count(*) AS line FROM events GROUP BY event_type""")
def sink_text(spark, sf_dir):
    path = scratch_dir(spark, "text")
    counts = events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    files.write_text(counts, path, F.concat_ws(":", "event_type", F.col("n").cast("string")), single_file=True)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("sink_partitioned_by_day", """
SELECT strftime(ts, '%Y%m%d') AS dt, event_id, user_id, ts FROM events""")
def sink_partitioned_by_day(spark, sf_dir):
    path = scratch_dir(spark, "by-day")
    files.write_by_day(events(spark, sf_dir).select("event_id", "user_id", "ts"), path, "ts")
    back = spark.read.schema("event_id LONG, user_id LONG, ts TIMESTAMP, dt STRING").parquet(path)
    return back.select("dt", "event_id", "user_id", plain("ts").alias("ts"))


@query("compact_small_files", """
SELECT o_orderkey, o_custkey, o_totalprice, 1 AS files FROM orders""")
def compact_small_files(spark, sf_dir):
    small, big = scratch_dir(spark, "small"), scratch_dir(spark, "compact")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").repartition(12).write.parquet(small)
    written = files.compact(spark, small, big)
    return spark.read.parquet(big).withColumn("files", F.lit(written))


@query("wide_column_puts", """
WITH n AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch_no FROM orders)
SELECT o_orderkey, o_orderkey || '_' || o_custkey || '_' || o_orderstatus AS rowkey, batch_no,
       CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS status
FROM n""")
def wide_column_puts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws("::", "o_orderkey", "o_custkey", "o_orderstatus")
    puts = batched.wide_column_puts(orders, ["o_orderkey"], line, ["order", "cust", "status"], 100)
    return puts.select("o_orderkey", "rowkey", "batch_no", F.col("columns")["cust"].alias("cust"),
                       F.col("columns")["status"].alias("status"))


@query("sink_batched", """
SELECT count(*) AS input_rows, count(*) AS saved_rows, CAST(0 AS BIGINT) AS oversized_batches FROM events""")
def sink_batched(spark, sf_dir):
    """Buffered sink: every record goes out once, in batches of at most 12."""
    records = spark.sparkContext.accumulator(0)
    oversized = spark.sparkContext.accumulator(0)

    def save_records(rows):
        records.add(len(rows))
        oversized.add(int(len(rows) > 12))

    sent = events(spark, sf_dir).select("event_id", "user_id")
    batched.save_in_batches(sent, save_records, 12, clients=4)
    return sent.agg(F.count(F.lit(1)).alias("input_rows")).select(
        "input_rows", F.lit(records.value).cast("long").alias("saved_rows"),
        F.lit(oversized.value).cast("long").alias("oversized_batches"))


@query("to_kafka_value", f"""
WITH {EVENTS}
SELECT CAST(user_id AS VARCHAR) AS key,
       '{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}}' AS value
FROM ev""")
def kafka_value(spark, sf_dir):
    return to_kafka_value(events(spark, sf_dir).select("event_id", "user_id", "event_type"), "user_id")
