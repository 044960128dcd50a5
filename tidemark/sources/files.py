"""Text and CSV files, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Replay a folder of line files as a stream, a bounded number of files per batch."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def read_csv(spark: SparkSession, path: str, ddl: str, sep: str = ",") -> DataFrame:
    """CSV with a fixed field order; the schema is declared, never inferred."""
    return spark.read.schema(ddl).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
