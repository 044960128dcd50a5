"""Queries over aggregates and distinct counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, HOUR, MINUTE, events, query, table, tumble_sql
from tidemark.jobs.windows import sliding_starts
from tidemark.operators import aggregates as a
from tidemark.operators import distinct as d
from tidemark.operators import windows as w
from tidemark.plans.timing import plain, window_end
from tidemark.sources.records import parse_json


@query("reduce_window_sum", f"""
SELECT {tumble_sql(DAY)} AS window_start, {tumble_sql(DAY)} + INTERVAL 1 DAY AS window_end,
       user_id, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents,
       arg_min(event_id, (ts, event_id)) AS event_id, arg_min(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY ALL""")
def reduce_window_sum(spark, sf_dir):
    out = a.reduce_window(events(spark, sf_dir), "ts", "1 day", ["user_id"], "cents",
                          ["event_id", "event_type"], ["ts", "event_id"])
    return w.flatten_window(out)


@query("rolling_sum", f"""
WITH {EVENTS}
SELECT event_id, user_id, ts, (sum(cents) OVER (PARTITION BY user_id ORDER BY pos, event_id))::BIGINT AS rolling_sum
FROM ev""")
def rolling_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "pos", "cents")
    out = a.rolling_sum(rows, ["user_id"], ["pos", "event_id"], "cents")
    return out.select("event_id", "user_id", plain("ts").alias("ts"), "rolling_sum")


@query("window_avg", f"""
WITH {EVENTS}
SELECT make_timestamp(pos // {HOUR} * {HOUR}) AS window_start, make_timestamp((pos // {HOUR} + 1) * {HOUR}) AS window_end,
       event_type, sum(cents)::DOUBLE / count(*) AS avg_cents
FROM ev GROUP BY ALL""")
def window_avg(spark, sf_dir):
    out = w.tumbling(events(spark, sf_dir), "ts", "1 hour", ["event_type"], avg_cents=F.avg("cents"))
    return w.flatten_window(out)


@query("window_collect", f"""
WITH {EVENTS},
n AS (SELECT *, pos // {DAY} AS d,
             row_number() OVER (PARTITION BY user_id, pos // {DAY} ORDER BY pos, event_id) AS rn FROM ev)
SELECT user_id, '[' || strftime(make_timestamp(d * {DAY}), '%Y-%m-%d %H:%M:%S') || '~' ||
       strftime(make_timestamp((d + 1) * {DAY}), '%Y-%m-%d %H:%M:%S') || ')' AS window_label,
       (rn - 1) // 3 AS part, count(*) AS n,
       string_agg(event_type || '=' || cents, ';' ORDER BY rn) AS contents
FROM n GROUP BY user_id, d, (rn - 1) // 3""")
def window_collect(spark, sf_dir):
    item = F.concat_ws("=", "event_type", F.col("cents").cast("string"))
    return a.collect_window_text(
        events(spark, sf_dir).select("user_id", "event_id", "ts", "pos", "event_type", "cents"),
        "ts", "1 day", ["user_id"], ["pos", "event_id"], item, per_part=3)


@query("count_by_channel_behavior", f"""
WITH {EVENTS},
s AS (SELECT user_id % 10 AS channel, event_type, unnest({sliding_starts(HOUR, 10 * MINUTE)}) AS st
      FROM ev WHERE event_type <> 'error')
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end, channel, event_type, count(*) AS cnt
FROM s GROUP BY ALL""")
def count_by_channel_behavior(spark, sf_dir):
    kept = events(spark, sf_dir).filter("event_type <> 'error'").withColumn("channel", F.col("user_id") % 10)
    out = w.sliding(kept, "ts", "1 hour", "10 minutes", ["channel", "event_type"], cnt=F.count(F.lit(1)))
    return w.flatten_window(out)


@query("count_total_sliding", f"""
WITH {EVENTS},
s AS (SELECT unnest({sliding_starts(HOUR, 10 * MINUTE)}) AS st FROM ev WHERE event_type <> 'error')
SELECT make_timestamp(st) AS window_start, make_timestamp(st + {HOUR}) AS window_end,
       'app marketing' AS channel, 'total' AS behavior, count(*) AS cnt
FROM s GROUP BY st""")
def count_total_sliding(spark, sf_dir):
    kept = events(spark, sf_dir).filter("event_type <> 'error'")
    out = w.sliding(kept, "ts", "1 hour", "10 minutes", cnt=F.count(F.lit(1)))
    labelled = out.withColumn("channel", F.lit("app marketing")).withColumn("behavior", F.lit("total"))
    return w.flatten_window(labelled, "channel", "behavior", "cnt")


@query("uv_window_exact", f"""
SELECT {tumble_sql(HOUR)} AS window_start, {tumble_sql(HOUR)} + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL""")
def uv_window_exact(spark, sf_dir):
    return w.flatten_window(d.exact_uv(events(spark, sf_dir), "ts", "1 hour", "user_id"))


@query("uv_bitmap_hash", f"""
WITH h AS (
  SELECT {tumble_sql(DAY)} AS window_start,
         list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST(user_id AS VARCHAR), ''),
                     lambda c: CAST(ascii(c) AS BIGINT))),
                     lambda acc, c: (acc * 61 + c) & {(1 << 29) - 1}) AS bit
  FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(DISTINCT bit) AS uv
FROM h GROUP BY window_start""")
def uv_bitmap_hash(spark, sf_dir):
    return w.flatten_window(d.bitmap_uv(events(spark, sf_dir), "ts", "1 day", "user_id"))


@query("uv_approx")
def uv_approx(spark, sf_dir):
    return w.flatten_window(d.approx_uv(events(spark, sf_dir), "ts", "1 day", "user_id"))


@query("uv_hll")
def uv_hll(spark, sf_dir):
    """Hourly sketches rolled up to days without reading the events again."""
    hourly = d.hll_sketches(events(spark, sf_dir), "ts", "1 hour", "user_id")
    return d.hll_rollup(hourly, F.date_format("window.start", "yyyy-MM-dd").alias("day"))


@query("uv_hll_checked", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS uv, TRUE AS within FROM events GROUP BY ALL""")
def uv_hll_checked(spark, sf_dir):
    """Exact daily users, and whether the sketches rolled up from hours keep to their error bound."""
    exact = events(spark, sf_dir).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.countDistinct("user_id").alias("uv"))
    return d.hll_checked(uv_hll(spark, sf_dir), exact, ["day"])


RANKS = {"p50": 0.5, "p99": 0.99}


@query("metric_quantile_rollup", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(value) AS n, TRUE AS p50_within, TRUE AS p99_within FROM events GROUP BY ALL""")
def metric_quantile_rollup(spark, sf_dir):
    """Daily quantiles from hourly sketches, checked against the ranks they really have."""
    rows = events(spark, sf_dir)
    hourly = a.quantile_sketches(rows, "ts", "1 hour", "cents")
    daily = a.merged_quantiles(hourly, [F.date_format("window.start", "yyyy-MM-dd").alias("day")], RANKS)
    return a.quantiles_checked(rows.withColumn("day", F.date_format("ts", "yyyy-MM-dd")), daily, ["day"], "cents", RANKS)


@query("uv_daily_cumulative", f"""
WITH {EVENTS},
v AS (SELECT strftime(ts, '%Y%m%d') AS day, event_type AS url, (pos // {10 * MINUTE} + 1) * {10 * MINUTE} AS step,
             user_id FROM ev),
f AS (SELECT day, url, user_id, min(step) AS step FROM v GROUP BY ALL),
c AS (SELECT day, url, step, count(*) AS fresh FROM f GROUP BY ALL),
s AS (SELECT DISTINCT day, url, step FROM v)
SELECT s.day, s.url, make_timestamp(s.step) AS step_end,
       (sum(coalesce(c.fresh, 0)) OVER (PARTITION BY s.day, s.url ORDER BY s.step))::BIGINT AS uv
FROM s LEFT JOIN c ON c.day = s.day AND c.url = s.url AND c.step = s.step""")
def uv_daily_cumulative(spark, sf_dir):
    seen = events(spark, sf_dir).select(F.col("event_type").alias("url"), "user_id", "ts")
    out = d.cumulative_uv(seen, ["url"], "user_id", F.date_format("ts", "yyyyMMdd"),
                          window_end("ts", "10 minutes"))
    return out.select(F.col("period").alias("day"), "url", plain("step_end").alias("step_end"), "uv")


@query("uv_hourly_by_key", f"""
WITH {EVENTS},
f AS (SELECT item, (pos // {HOUR} + 1) * {HOUR} AS hour_end, user_id, min((pos // {MINUTE} + 1) * {MINUTE}) AS step
      FROM ev GROUP BY ALL),
s AS (SELECT DISTINCT item, (pos // {HOUR} + 1) * {HOUR} AS hour_end, (pos // {MINUTE} + 1) * {MINUTE} AS step FROM ev)
SELECT s.item, make_timestamp(s.hour_end) AS hour_end, make_timestamp(s.step) AS step_end, count(f.user_id) AS uv
FROM s LEFT JOIN f ON f.item = s.item AND f.hour_end = s.hour_end AND f.step <= s.step
GROUP BY s.item, s.hour_end, s.step""")
def uv_hourly_by_key(spark, sf_dir):
    seen = events(spark, sf_dir).select("item", "user_id", "ts")
    out = d.cumulative_uv(seen, ["item"], "user_id", window_end("ts", "1 hour"), window_end("ts", "1 minute"))
    return out.select("item", plain("period").alias("hour_end"), plain("step_end").alias("step_end"), "uv")


@query("latest_status_count", """
SELECT status, count(*) AS devices FROM (
  SELECT user_id, arg_max(event_type, (ts, event_type)) AS status FROM events GROUP BY user_id)
GROUP BY status""")
def latest_status_count(spark, sf_dir):
    seen = events(spark, sf_dir).select("user_id", "ts", F.col("event_type").alias("status"))
    latest = a.latest_per_key(seen, ["user_id"], ["ts", "status"], "status")
    return latest.groupBy("status").agg(F.count(F.lit(1)).alias("devices"))


@query("retract_changelog_counts", f"""
WITH {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY pos, event_id) AS n FROM ev)
SELECT pos, event_id, item, '+' AS op, n AS cnt FROM n
UNION ALL SELECT pos, event_id, item, '-', n - 1 FROM n WHERE n > 1""")
def retract_changelog_counts(spark, sf_dir):
    rows = events(spark, sf_dir).select("pos", "event_id", "item")
    return a.changelog_counts(rows, "item", ["pos", "event_id"])


@query("observed_counts", """
SELECT event_type, count(*) AS cnt, (SELECT count(*) FROM events) AS records,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS errors
FROM events GROUP BY event_type""")
def observed_counts(spark, sf_dir):
    """Job-wide counters gathered while the result is written, next to the result itself."""
    from pyspark.sql import Observation

    from tidemark.session import scratch_dir

    path, counters = scratch_dir(spark, "observed"), Observation("counters")
    counted = events(spark, sf_dir).observe(
        counters, F.count(F.lit(1)).alias("records"), F.count_if(F.col("event_type") == "error").alias("errors"))
    counted.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt")).write.parquet(path)
    return spark.read.parquet(path).select(
        "event_type", "cnt", F.lit(counters.get["records"]).cast("long").alias("records"),
        F.lit(counters.get["errors"]).cast("long").alias("errors"))


@query("parse_quality_counts", f"""
WITH {EVENTS}
SELECT event_type, CASE WHEN event_type IN ('error', 'click') THEN 0 ELSE count(*) END AS parsed,
       CASE WHEN event_type IN ('error', 'click') THEN count(*) ELSE 0 END AS failed,
       CASE WHEN event_type = 'click' THEN count(*) ELSE 0 END AS missing
FROM ev GROUP BY event_type""")
def parse_quality_counts(spark, sf_dir):
    # Errors carry text that is no number, clicks carry nothing.
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).when(
        F.col("event_type") != "click", F.col("item").cast("string"))
    lines = events(spark, sf_dir).select("event_type", text.alias("text"))
    return a.parse_quality(lines, "text", F.col("text").try_cast("long"), ["event_type"])


SQL_VIEW = "tidemark_user_log"


def user_log(spark, sf_dir):
    """Register the events as the table the SQL jobs read."""
    from tidemark.session import table as load

    log = load(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("behavior"), "ts",
        parse_json("props", "k LONG")["k"].alias("item_id"))
    log.createOrReplaceTempView(SQL_VIEW)


@query("sql_pvuv_hourly", """
SELECT strftime(ts, '%Y-%m-%d %H:00') AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM events GROUP BY 1""")
def sql_pvuv_hourly(spark, sf_dir):
    user_log(spark, sf_dir)
    return spark.sql(f"""
        SELECT date_format(ts, 'yyyy-MM-dd HH:00') AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv
        FROM {SQL_VIEW} GROUP BY date_format(ts, 'yyyy-MM-dd HH:00')""")


@query("sql_uv_daily", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS uv FROM events GROUP BY 1""")
def sql_uv_daily(spark, sf_dir):
    user_log(spark, sf_dir)
    return spark.sql(f"""
        SELECT date_format(ts, 'yyyy-MM-dd') AS day, count(DISTINCT user_id) AS uv
        FROM {SQL_VIEW} GROUP BY date_format(ts, 'yyyy-MM-dd')""")


@query("sql_tumble_sum", f"""
WITH {EVENTS}
SELECT event_type AS behavior, make_timestamp((pos // {5 * MINUTE} + 1) * {5 * MINUTE}) AS window_end,
       sum(item)::BIGINT AS total
FROM ev GROUP BY ALL""")
def sql_tumble_sum(spark, sf_dir):
    user_log(spark, sf_dir)
    return spark.sql(f"""
        SELECT behavior, CAST(window(ts, '5 minutes').end AS TIMESTAMP_NTZ) AS window_end, sum(item_id) AS total
        FROM {SQL_VIEW} GROUP BY behavior, window(ts, '5 minutes')""")


@query("sql_insert_result", """
SELECT strftime(ts, '%Y-%m-%d %H:00') AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM events GROUP BY 1""")
def sql_insert_result(spark, sf_dir):
    """The SQL job with its result table: ``INSERT INTO`` a table in the shared folder."""
    from tidemark.session import scratch_dir

    user_log(spark, sf_dir)
    path = scratch_dir(spark, "pvuv")
    name = "tidemark_pvuv_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (dt STRING, pv BIGINT, uv BIGINT) USING parquet LOCATION '{path}'")
    spark.sql(f"""
        INSERT INTO {name}
        SELECT date_format(ts, 'yyyy-MM-dd HH:00') AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv
        FROM {SQL_VIEW} GROUP BY date_format(ts, 'yyyy-MM-dd HH:00')""")
    return spark.table(name)
