"""Queries over the readers and record parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.jobs.registry import EVENTS, events, query
from tidemark.operators.automaton import EVENTS as SYMBOLS
from tidemark.plans.timing import instant, plain
from tidemark.session import scratch_dir, table
from tidemark.sinks.files import write_text
from tidemark.sources import external, files, records


def event_line():
    """One delimited line per event: user, item, type, epoch seconds."""
    return F.concat_ws(",", "event_id", "user_id", "item", "event_type", F.expr("pos div 1000000"))


def log_line():
    """An access-log line per page view; the page seen is the event's item."""
    return F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), F.col("user_id")), F.lit("-"), F.col("user_id").cast("string"),
        F.date_format("ts", records.ACCESS_LOG_TIME), F.lit("+0000"), F.lit("GET"), F.col("url"))


LOG_SQL = """
  SELECT event_id, '10.0.0.' || user_id AS ip, CAST(user_id AS VARCHAR) AS "user",
         date_trunc('second', ts) AS ts, 'GET' AS method, url
  FROM ev JOIN pages ON page_id = item"""


def access_log_lines(spark, sf_dir):
    """Access-log text built from the events and the pages they touch."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    seen = events(spark, sf_dir).select("event_id", "ts", "user_id", F.col("item").alias("page_id"))
    return seen.join(pages, "page_id").select("event_id", log_line().alias("line"))


@query("src_text_lines", f"""
WITH {EVENTS}
SELECT concat_ws(',', event_id, user_id, item, event_type, pos // 1000000) AS line,
       length(concat_ws(',', event_id, user_id, item, event_type, pos // 1000000)) AS n_chars
FROM ev""")
def src_text_lines(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    write_text(events(spark, sf_dir), path, event_line())
    lines = files.read_lines(spark, path)
    return lines.select(F.col("value").alias("line"), F.length("value").cast("long").alias("n_chars"))


@query("src_csv_typed", f"""
WITH {EVENTS}
SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users, sum(item)::BIGINT AS items,
       max(pos // 1000000) AS last_second
FROM ev GROUP BY event_type""")
def src_csv_typed(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    write_text(events(spark, sf_dir), path, event_line())
    typed = files.read_csv(
        spark, path, "event_id LONG, user_id LONG, item LONG, event_type STRING, second LONG")
    return typed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"),
        F.sum("item").alias("items"), F.max("second").alias("last_second"))


@query("parse_delimited", f"""
WITH {EVENTS}
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'signup' THEN item END AS item,
       event_type NOT IN ('error', 'signup') AS is_valid
FROM ev""")
def parse_delimited(spark, sf_dir):
    # `error` lines carry a broken user id and `signup` lines lack a field.
    user = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("user_id").cast("string"))
    item = F.when(F.col("event_type") != "signup", F.col("item").cast("string"))
    text = events(spark, sf_dir).select(
        "event_id", F.concat_ws(" , ", user, item).alias("line"))
    parsed = records.parse_delimited(text, "line", "user_id LONG, item LONG", keep=("event_id",))
    return parsed.select("event_id", "user_id", "item", "is_valid")


@query("parse_access_log", f"WITH {EVENTS} {LOG_SQL}")
def parse_access_log(spark, sf_dir):
    lines = access_log_lines(spark, sf_dir)
    parsed = records.parse_access_log(lines, "line", keep=("event_id",))
    return parsed.withColumn("ts", plain("ts"))


@query("parse_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing
FROM events""")
def parse_json(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    parsed = df.withColumn("v", records.parse_json("props", "k LONG, missing STRING"))
    return parsed.select("event_id", "v.k", "v.missing")


@query("decode_binary_event", f"""
WITH {EVENTS}
SELECT event_id, user_id AS address,
       (user_id >> 24) || '.' || ((user_id >> 16) & 255) || '.' || ((user_id >> 8) & 255) || '.' || (user_id & 255) AS ip,
       ['a','b','c','d','e','f','g'][CAST(length(event_type) % 7 + 1 AS INTEGER)] AS symbol
FROM ev""")
def decode_binary_event(spark, sf_dir):
    ordinal = F.length("event_type") % 7
    packed = events(spark, sf_dir).select(
        "event_id",
        F.concat(records.to_little_endian(F.col("user_id")), records.to_little_endian(ordinal)).alias("payload"))
    address, symbol = records.decode_event(F.col("payload"), SYMBOLS)
    return packed.select(
        "event_id", address.alias("address"), scalar.ipv4(address).alias("ip"), symbol.alias("symbol"))


@query("kafka_records_decode", f"""
WITH {EVENTS}
SELECT event_type AS key, event_id AS "offset", user_id, item, CAST(NULL AS VARCHAR) AS note FROM ev""")
def kafka_records_decode(spark, sf_dir):
    # The columns a Kafka topic delivers, filled from the events.
    topic = external.to_kafka_value(
        events(spark, sf_dir).select("event_type", "event_id", "ts", "user_id", "item"), "event_type")
    body = records.parse_json(F.col("value"), "event_id LONG, ts TIMESTAMP")
    delivered = topic.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        body["event_id"].alias("offset"), body["ts"].alias("timestamp"))
    decoded = external.decode_json_value(delivered, "user_id LONG, item LONG, note STRING")
    return decoded.select("key", "offset", "user_id", "item", "note")


@query("catalog_table_roundtrip", """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment""")
def catalog_table_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    external.save_table(table(spark, sf_dir, "customer"), name, path)
    return spark.table(name).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("fn_date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:00') AS hour,
       'null' AS missing
FROM orders""")
def fn_date_format(spark, sf_dir):
    ms = F.unix_millis("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalar.date_text(ms).alias("day"),
        scalar.date_text(ms, "yyyy-MM-dd HH:00").alias("hour"),
        scalar.date_text(F.lit(None).cast("long")).alias("missing"))


@query("fn_epoch_roundtrip", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, (epoch_us(ts) // 1000000) * 1000 AS epoch_ms
FROM events""")
def fn_epoch_roundtrip(spark, sf_dir):
    text = scalar.stamp_to_date(F.unix_millis("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", text.alias("text"), scalar.date_to_stamp(text).alias("epoch_ms"))


@query("fn_ipv4", """
WITH a AS (SELECT o_orderkey, (o_orderkey * 65537) % 4294967296 AS address FROM orders)
SELECT o_orderkey, address,
       (address >> 24) || '.' || ((address >> 16) & 255) || '.' || ((address >> 8) & 255) || '.' || (address & 255) AS ip
FROM a""")
def fn_ipv4(spark, sf_dir):
    address = F.expr("(o_orderkey * 65537L) % 4294967296L")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", address.alias("address"), scalar.ipv4(address).alias("ip"))


@query("fn_string_ops", """
SELECT p_partkey, starts_with(p_name, 'red') AS is_red, contains(p_name, 'bolt') AS is_bolt,
       substring(p_name, 1, 1) AS initial, replace(p_brand, '#', '_') AS rowkey,
       lower(p_type) AS type_lower, trim('  ' || p_type || ' ') AS type_trimmed
FROM part""")
def fn_string_ops(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").startswith("red").alias("is_red"),
        F.col("p_name").contains("bolt").alias("is_bolt"),
        F.substring("p_name", 1, 1).alias("initial"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("rowkey"),
        F.lower("p_type").alias("type_lower"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type_trimmed"))


@query("fn_next_midnight", """
SELECT event_id, date_trunc('day', ts) + INTERVAL 1 DAY AS midnight,
       make_timestamp((epoch_us(ts) // 600000000) * 600000000) AS window_start
FROM events""")
def fn_next_midnight(spark, sf_dir):
    pos = F.unix_micros("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", plain(scalar.next_midnight(F.col("ts"))).alias("midnight"),
        plain(instant(pos - F.pmod(pos, F.lit(600_000_000)))).alias("window_start"))


@query("fn_report_line", """
SELECT o_orderkey, 'order ' || o_orderkey || ' of ' || strftime(o_orderdate, '%Y-%m-%d') || ' is ' ||
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS line
FROM orders""")
def fn_report_line(spark, sf_dir):
    status = scalar.lookup_or_self({"F": "finished", "O": "open"}, F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalar.report_line("order %d of %s is %s", F.col("o_orderkey"),
                           F.date_format("o_orderdate", scalar.DATE), status).alias("line"))


@query("udf_scalar", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events""")
def udf_scalar(spark, sf_dir):
    from tidemark.functions import user

    user.register(spark)
    return table(spark, sf_dir, "events").select(
        "event_id", F.expr("format_epoch(unix_millis(ts), '%Y-%m-%d %H:%M')").alias("minute"))


def typed_items():
    """A turn as a JSON array of typed items."""
    return F.to_json(F.array(
        F.struct(F.lit("role").alias("type"), F.col("role").alias("value")),
        F.struct(F.lit("text").alias("type"), F.col("text").alias("value"))))


def long_lines():
    """The long lines of a turn as a JSON array, possibly empty."""
    return F.to_json(F.transform(
        F.filter(F.split("text", "\n"), lambda x: F.length(x) > 80),
        lambda x: F.struct(F.lit("line").alias("type"), x.alias("value"))))


@query("udtf_json_rows", """
SELECT conv_id, turn, 'role' AS type, role AS value FROM conversations
UNION ALL SELECT conv_id, turn, 'text', text FROM conversations""")
def udtf_json_rows(spark, sf_dir):
    from tidemark.functions import user

    user.register(spark)
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", typed_items().alias("items"))
    return spark.sql(
        "SELECT conv_id, turn, i.type, i.value FROM {talks}, LATERAL json_items(items) AS i", talks=talks)


@query("lateral_json_explode", """
SELECT conv_id, turn, 'role' AS type, role AS value FROM conversations
UNION ALL SELECT conv_id, turn, 'text', text FROM conversations""")
def lateral_json_explode(spark, sf_dir):
    from tidemark.functions import user

    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", typed_items().alias("items"))
    return user.json_items(talks, "items").drop("items")


@query("lateral_left_explode", """
WITH l AS (
  SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: length(x) > 80) AS items
  FROM conversations)
SELECT conv_id, turn, 'line' AS type, unnest(items) AS value FROM l WHERE len(items) > 0
UNION ALL SELECT conv_id, turn, NULL, NULL FROM l WHERE len(items) = 0""")
def lateral_left_explode(spark, sf_dir):
    from tidemark.functions import user

    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", long_lines().alias("items"))
    return user.json_items(talks, "items", outer=True).drop("items")


@query("udaf_latest", """
SELECT o_custkey, max_by(len, (o_orderdate, len)) AS latest_status FROM (
  SELECT o_custkey, o_orderdate, CAST(ascii(o_orderstatus) AS BIGINT) AS len FROM orders)
GROUP BY o_custkey""")
def udaf_latest(spark, sf_dir):
    from tidemark.functions import user

    orders = table(spark, sf_dir, "orders").withColumn("status", F.ascii("o_orderstatus").cast("long"))
    return orders.groupBy("o_custkey").agg(
        user.latest(F.col("o_orderdate"), F.col("status")).alias("latest_status"))


@query("udaf_latest_merged", """
SELECT o_custkey, max_by(len, (o_orderdate, len)) AS latest_status FROM (
  SELECT o_custkey, o_orderdate, CAST(ascii(o_orderstatus) AS BIGINT) AS len FROM orders)
GROUP BY o_custkey""")
def udaf_latest_merged(spark, sf_dir):
    """The user's own aggregate over parts of each key, and once more over the parts' states."""
    from tidemark.functions import user

    orders = table(spark, sf_dir, "orders").withColumn("status", F.ascii("o_orderstatus").cast("long"))
    return user.latest_merged(orders, ["o_custkey"], "o_orderdate", "status")
