"""Readers, record parsers, sinks and option builders."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import routing
from tidemark.plans.timing import micros
from tidemark.session import scratch_dir
from tidemark.sinks import batched, files
from tidemark.sources import external, records
from tidemark.sources.files import read_csv, stream_lines
from tidemark.streaming.run import to_table


def test_delimited_records_and_rejects(spark):
    lines = spark.createDataFrame([("1, a ,2.5",), ("x,b,1",), ("2,c",), ("3,d,4.0,extra",), ("4,e,",)], "line string")
    good, bad = records.split_rejects(records.parse_delimited(lines, "line", "id LONG, name STRING, v DOUBLE"))
    assert [tuple(r) for r in good.collect()] == [(1, "a", 2.5)]
    assert sorted(r["raw"] for r in bad.collect()) == ["2,c", "3,d,4.0,extra", "4,e,", "x,b,1"]


def test_special_separator_is_literal(spark):
    lines = spark.createDataFrame([("1|2",)], "line string")
    row = records.parse_delimited(lines, "line", "a INT, b INT", sep="|").first()
    assert (row["a"], row["b"], row["is_valid"]) == (1, 2, True)


def test_access_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/style.css"
    row = records.parse_access_log(spark.createDataFrame([(line,), ("broken",)], "l string"), "l").collect()
    assert str(row[0]["ts"]) == "2015-05-17 10:05:03" and row[0]["method"] == "GET"
    assert row[1]["ts"] is None and row[1]["url"] is None


def test_static_assets_are_dropped(spark):
    df = spark.createDataFrame([("/a/style.css",), ("/a/app.js",), ("/a/page.html",), ("/a.js/page",)], "url string")
    assert sorted(r["url"] for r in routing.drop_static_assets(df, F.col("url")).collect()) == ["/a.js/page", "/a/page.html"]


def test_binary_events(spark):
    payload = bytearray((0xC0A80001).to_bytes(4, "little") + (2).to_bytes(4, "little"))
    df = spark.createDataFrame([(payload,)], "p binary")
    address, symbol = records.decode_event(F.col("p"), ("a", "b", "c"))
    assert tuple(df.select(address, symbol).first()) == (-1062731775, "c")


def test_csv_keeps_broken_fields_as_null(spark):
    path = scratch_dir(spark, "csv")
    files.write_text(spark.createDataFrame([("1,2",), ("x,3",)], "l string"), path, F.col("l"))
    assert sorted((r["a"] or 0, r["b"]) for r in read_csv(spark, path, "a INT, b INT").collect()) == [(0, 3), (1, 2)]


def test_lines_replayed_as_stream(spark):
    path = scratch_dir(spark, "lines")
    spark.range(10).select(F.col("id").cast("string").alias("value")).repartition(3).write.text(path)
    assert to_table(stream_lines(spark, path), "replay").count() == 10


def test_option_builders():
    options = external.jdbc_options("jdbc:x", "t", "id", 0, 100, 4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        external.jdbc_options("jdbc:x", "t", "id", 5, 5, 4)
    kafka = external.kafka_options("host:1", "topic", "latest", group="g", max_offsets=10)
    assert kafka["startingOffsets"] == "latest" and kafka["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        external.kafka_options("host:1", "topic", "somewhere")


def test_kafka_value_roundtrip(spark):
    sent = external.to_kafka_value(spark.createDataFrame([(1, "a")], "id long, s string"), "id")
    topic = sent.select(F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("t").alias("topic"),
                        F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.current_timestamp().alias("timestamp"))
    row = external.decode_json_value(topic, "id LONG, s STRING, more INT").first()
    assert (row["key"], row["id"], row["s"], row["more"]) == ("1", 1, "a", None)


def test_reloaded_dimension_is_read_per_batch(spark):
    seen = []
    versions = iter([spark.range(1), spark.range(2)])
    run = external.with_reloaded(lambda: next(versions), lambda batch, dim, n: seen.append((n, dim.count())))
    run(spark.range(3), 0)
    run(spark.range(3), 1)
    assert seen == [(0, 1), (1, 2)]


def test_chunks_lose_nothing():
    got = list(batched.chunks(iter(range(10)), 4))
    assert got == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]


def test_compaction_counts_files_by_size(spark):
    source, target = scratch_dir(spark, "many"), scratch_dir(spark, "few")
    spark.range(20_000).repartition(16).write.parquet(source)
    assert files.compact(spark, source, target, target_bytes=40_000) > 1
    assert files.compact(spark, source, scratch_dir(spark, "one")) == 1
    assert spark.read.parquet(target).count() == 20_000


def test_durations():
    assert micros("10 minutes") == 600_000_000 and micros("-1 hour") == -3_600_000_000 and micros(7) == 7
    with pytest.raises(ValueError):
        micros("soon")
