"""Intermediate tables.

An operator that reads an intermediate result several times would otherwise
compute it several times, and nested ordered scans multiply that.  ``staged``
writes the result once to the shared scratch folder and reads it back: lineage
is cut, and a lost executor only costs a file read.

A table is needed as long as a result that reads it has not been written.
``unstage`` deletes tables that nothing reads any more.  Within
``Scratch.collecting`` the tables are noted, and ``Scratch.release`` deletes
the others once their results are written.  What was shuffled to write a table
goes as soon as it is written, not when the driver next collects its garbage.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir, scratch_root

# Spark's own setting, read for each execution.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_noting = threading.local()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each execution as it ends, unless the session's own setting says otherwise."""
    if spark.conf.get(SHUFFLES_GO, None) is not None:
        yield
        return
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO)


def staged(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_dir(spark, f"stage-{name}")
    with _shuffles_go(spark):
        df.write.parquet(path)
    made = getattr(_noting, "paths", None)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unstage(*frames: DataFrame) -> None:
    """Delete all staged tables that ``frames`` read; every result that needs them must have been written."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rsplit("/", 2)[1] for file in frame.inputFiles()}:
            if folder.startswith("stage-"):
                _delete(spark, f"{scratch_root(spark)}/{folder}")


class Scratch:
    """The intermediate tables of one chain of steps, each thread's its own."""

    def __init__(self) -> None:
        self._own = threading.local()

    def _paths(self) -> list[str]:
        if not hasattr(self._own, "paths"):
            self._own.paths = []
        return self._own.paths

    @contextmanager
    def collecting(self) -> Iterator[None]:
        """Note the tables staged in this thread; an inner collection has them noted as its own."""
        outer = getattr(_noting, "paths", None)
        _noting.paths = self._paths()
        try:
            yield
        finally:
            _noting.paths = outer

    def release(self, spark: SparkSession, reading: DataFrame | None = None) -> None:
        """Delete the noted tables, but for those that ``reading`` still reads."""
        paths = self._paths()
        if not paths:
            return
        files = reading.inputFiles() if reading is not None else []
        kept = [p for p in paths if any(f"/{p.rstrip('/').rsplit('/', 1)[1]}/" in f for f in files)]
        for path in paths:
            if path not in kept:
                _delete(spark, path)
        paths[:] = kept
