"""Kafka, JDBC and catalog adapters.

The Kafka and JDBC connectors need their packages on the cluster's class path;
everything after the ``load()`` works on plain columns and is tested as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.records import parse_json

START = ("earliest", "latest")


def kafka_options(
    brokers: str, topic: str, start: str = "earliest", group: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    if start not in START:
        raise ValueError(f"start must be one of {START}")
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka_stream(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def decode_json_value(df: DataFrame, ddl: str) -> DataFrame:
    """Topic records with a JSON value, decoded; broken values give null fields."""
    return df.select(
        F.col("key").cast("string").alias("key"), "topic", "partition", "offset", "timestamp",
        parse_json(F.col("value").cast("string"), ddl).alias("v")).select(
        "key", "topic", "partition", "offset", "timestamp", "v.*")


def to_kafka_value(df: DataFrame, key: str | Column) -> DataFrame:
    """``key`` / ``value`` columns as the Kafka sink expects them, value as JSON."""
    col = F.col(key) if isinstance(key, str) else key
    return df.select(col.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def jdbc_options(
    url: str, table: str, column: str, lower: int, upper: int, partitions: int,
) -> dict[str, str]:
    """Options of a JDBC read split into ``partitions`` ranges of a numeric column."""
    if partitions < 1 or lower >= upper:
        raise ValueError("need at least one partition and lower < upper")
    return {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower),
        "upperBound": str(upper), "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def with_reloaded(load: Callable[[], DataFrame], use: Callable[[DataFrame, DataFrame, int], None]):
    """A ``foreachBatch`` function that reads the dimension anew for every micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        use(batch, load(), batch_id)

    return run


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
