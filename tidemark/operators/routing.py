"""Tokenising, side outputs, tagged routing, partitioning and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Static assets that are no page views, and the word separators.
STATIC_ASSET = r"\.(css|js)$"
SEPARATORS = r"[ ,.\t\r\n]+"


def drop_static_assets(df: DataFrame, url: Column) -> DataFrame:
    return df.filter(~url.rlike(STATIC_ASSET))


def tokens(df: DataFrame, text: str, pattern: str = SEPARATORS, name: str = "word") -> DataFrame:
    """One row per lower-cased token, empty tokens dropped."""
    return df.withColumn(name, F.explode(F.split(F.lower(text), pattern))).filter(F.col(name) != "")


def side_output(df: DataFrame, rejected: Column, value: str, prefix: str = "rejected: ") -> DataFrame:
    """Tag rows ``main`` or ``rejected``; rejected values get the prefix."""
    return df.withColumn("route", F.when(rejected, "rejected").otherwise("main")).withColumn(
        value, F.when(rejected, F.concat(F.lit(prefix), F.col(value))).otherwise(F.col(value)))


def with_tags(df: DataFrame, **conditions: Column) -> DataFrame:
    """Add the array of all tags whose condition holds."""
    tags = F.array(*[F.when(cond, F.lit(tag)) for tag, cond in conditions.items()])
    return df.withColumn("tags", F.filter(tags, lambda t: t.isNotNull()))


def select_tag(df: DataFrame, *tags: str) -> DataFrame:
    wanted = reduce(lambda a, b: a | b, [F.array_contains("tags", t) for t in tags])
    return df.filter(wanted)


def partition_halves(df: DataFrame, key: str, n: int) -> DataFrame:
    """Place rows whose key has a digit on partitions below ``n / 2``, others above.

    Inside its half a row's slot comes from a hash of the whole row, so that one
    frequent key does not fill one partition.
    """
    half = n // 2
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(half)).cast("int")
    slot = F.when(F.col(key).rlike("[0-9]"), spread).otherwise(spread + half)
    return df.withColumn("_slot", slot).repartitionById(n, "_slot").drop("_slot")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
