"""User functions: the extension points for scalar, table and aggregate functions.

Each has a built-in expression next to it; the built-in form is the one to use
on large tables, the Python form shows how a user's own logic is registered.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.runs import latest_states

DATA_ITEMS = "array<struct<type:string,value:string>>"


@F.pandas_udf("string")
def format_epoch(epoch_ms: pd.Series, fmt: pd.Series) -> pd.Series:
    """Epoch milliseconds with a strftime pattern, in Arrow batches."""
    times = pd.to_datetime(epoch_ms, unit="ms")
    out = pd.Series(index=epoch_ms.index, dtype="object")
    for pattern in fmt.unique():  # a handful of patterns, not rows
        rows = fmt == pattern
        out[rows] = times[rows].dt.strftime(pattern)
    return out.fillna("null")


@F.udtf(returnType="type string, value string")
class JsonItems:
    """Rows ``(type, value)`` of a JSON array; a broken text yields no rows."""

    def eval(self, text: str) -> Iterator[tuple[str, str]]:
        try:
            items = json.loads(text) if text is not None else []
        except ValueError:
            return
        for item in items:
            yield item.get("type"), item.get("value")


@F.pandas_udf("long")
def latest_status(times: pd.Series, status: pd.Series) -> int:
    """Status at the latest time (grouped aggregate); equal times prefer the higher status."""
    return int(status[times == times.max()].max())


@F.pandas_udf("long")
def newest_time(times: pd.Series) -> int:
    return int(times.max())


def register(spark: SparkSession) -> None:
    spark.udf.register("format_epoch", format_epoch)
    spark.udf.register("latest_status", latest_status)
    spark.udtf.register("json_items", JsonItems)


def json_items(df: DataFrame, text: str, outer: bool = False) -> DataFrame:
    """Built-in form of ``JsonItems``: lateral rows, ``outer`` keeps rows without items."""
    items = F.from_json(F.col(text), DATA_ITEMS)
    explode = F.explode_outer if outer else F.explode
    return df.withColumn("_item", explode(items)).select(
        *df.columns, F.col("_item.type").alias("type"), F.col("_item.value").alias("value"))


def latest(times: Column, status: Column) -> Column:
    """Built-in form of ``latest_status``: a partial aggregate."""
    return F.max_by(status, F.struct(times, status))


def latest_merged(df: DataFrame, keys: list[str], times: str, status: str, parts: int = 16, part_rows: int = 10_000) -> DataFrame:
    """``keys, latest_status`` by the grouped aggregate ``latest_status`` itself, in two steps.

    A Python aggregate takes a whole group into one task, and a call from Spark for each of many small groups is dear.  So
    the rows are sorted by key within partitions, and a task calls the aggregate for one key after the other.  A key of
    over ``part_rows`` rows is dealt to as many parts as hold that many rows each, but at least ``parts``, by a hash of
    its rows; a part's state (latest time and its status) is an input of the same aggregate again, and a frequent key's
    rows never meet in one place.  Rows without time or status are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # Keys as text: beside a null key pandas would make floats of whole numbers.
    rows = df.filter(F.col(times).isNotNull() & F.col(status).isNotNull()).select(
        *[F.col(k).cast("string").alias(k) for k in keys], F.unix_micros(F.col(times).cast("timestamp")).alias("_at"),
        F.col(status).cast("long").alias("_status"), F.monotonically_increasing_id().alias("_row"))
    frequent = rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_rows")).filter(
        F.col("_rows") > part_rows)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    count = F.greatest(F.lit(parts), F.ceil(F.col("_rows") / F.lit(part_rows)))
    part = F.when(F.col("_rows").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("_row"), count)).alias("_part")
    dealt = rows.join(frequent, same, "left").select(*keys, "_at", "_status", part)
    # The plain functions: a task cannot load this module, whose decorators need a session.
    states = latest_states(keys, latest_status.func, newest_time.func)
    schema = ", ".join([*(f"`{k}` string" for k in keys), "_at long", "_status long"])
    partial = dealt.repartition(*keys, "_part").sortWithinPartitions(*keys).select(
        *keys, "_at", "_status").mapInPandas(states, schema)
    merged = partial.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(states, schema)
    return merged.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys], F.col("_status").alias("latest_status"))
