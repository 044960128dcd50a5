"""File sinks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, line: Column, single_file: bool = False) -> None:
    """Overwrite a folder of text files; ``single_file`` is for small final results only."""
    lines = df.select(line.alias("value"))
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode("overwrite").text(path)


def write_by_day(
    df: DataFrame, path: str, ts: str, fmt: str = "parquet", max_records: int = 5_000_000,
) -> None:
    """Files bucketed by the record's own event date as ``dt=yyyyMMdd``.

    Rows are rebalanced by day before writing: adaptive execution merges small
    days into one task and splits a crowded one over several.
    """
    dated = df.withColumn("dt", F.date_format(ts, "yyyyMMdd"))
    (
        dated.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt")
        .option("maxRecordsPerFile", max_records).format(fmt).save(path)
    )


def compact(
    spark: SparkSession, source: str, target: str, target_bytes: int = 256 * 1024 * 1024,
) -> int:
    """Rewrite a folder of small Parquet files into files of about ``target_bytes``.

    The file count follows from the folder's listing (names and lengths, no
    contents); the rows are dealt out evenly.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(source)
    total = listing.agg(F.sum("length")).first()[0] or 0
    files = max(1, math.ceil(total / target_bytes))
    spark.read.parquet(source).repartition(files).write.mode("overwrite").parquet(target)
    return files
