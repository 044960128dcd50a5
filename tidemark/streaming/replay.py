"""Tables replayed as streams in several deliveries.

A replay hands over the rows of one or more tables step by step while one streaming query runs: a step's files are moved
into the table's folder at once, as a folder of their own, and the query takes them in one batch before the next step.
Watermark, timers and state are carried from batch to batch, each side keeps its own watermark, and the result does not
depend on how many files a step has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir
from tidemark.sinks.batched import keyed_batches
from tidemark.streaming.run import BATCH, use_rocksdb

STEP = "_step"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


class Replay:
    """``tables`` hold the rows with their delivery in the column ``step`` (whole numbers from 0 on, below ``steps``).

    With ``idle_batches`` false no batch runs without new rows; state with a time to live in processing time would
    otherwise be visited for ever.
    """

    def __init__(self, spark: SparkSession, name: str, steps: int, tables: dict[str, DataFrame], step: str = "step",
                 idle_batches: bool = True) -> None:
        use_rocksdb(spark)
        self.spark, self.name, self.steps, self.idle_batches = spark, name, steps, idle_batches
        self.schemas = {t: df.drop(step).schema for t, df in tables.items()}
        self.folders = {t: scratch_dir(spark, f"{name}-{t}") for t in tables}
        self.checkpoint = scratch_dir(spark, f"{name}-ckpt")
        self._stored = {t: scratch_dir(spark, f"{name}-{t}-steps") for t in tables}
        for t, df in tables.items():
            df.withColumnRenamed(step, STEP).write.partitionBy(STEP).parquet(self._stored[t])
            self._path(self.folders[t])[1].mkdirs(self._path(self.folders[t])[0])

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def stream(self, table: str) -> DataFrame:
        return self.spark.readStream.schema(self.schemas[table]).option("recursiveFileLookup", "true").parquet(
            self.folders[table])

    def deliver(self, k: int) -> None:
        for t, stored in self._stored.items():
            source, files = self._path(f"{stored}/{STEP}={k}")
            if files.exists(source):
                files.rename(source, self._path(f"{self.folders[t]}/delivery-{k}")[0])

    def run(self, writer, after: Callable[[int], None] = lambda k: None) -> None:
        """Start the stream of ``writer``, deliver step after step, and stop it when all rows are taken."""
        before = self.spark.conf.get(NO_DATA_BATCHES)
        self.spark.conf.set(NO_DATA_BATCHES, str(self.idle_batches).lower())
        try:
            query = writer.option("checkpointLocation", self.checkpoint).start()
        finally:
            self.spark.conf.set(NO_DATA_BATCHES, before)
        try:
            for k in range(self.steps):
                self.deliver(k)
                query.processAllAvailable()
                after(k)
        finally:
            query.stop()

    def to_table(self, df: DataFrame) -> DataFrame:
        """All rows that a stream has put out in append mode after the last delivery."""
        out = scratch_dir(self.spark, self.name)
        self.run(df.writeStream.format("parquet").outputMode("append").option("path", out))
        return self.spark.read.schema(df.schema).parquet(out)

    def to_batches(self, df: DataFrame, transform: Callable[[DataFrame, int], DataFrame], mode: str,
                   after: Callable[[int], None] = lambda k: None) -> DataFrame:
        """What ``transform`` makes of every batch, with the batch's number in the column ``batch``."""
        out = scratch_dir(self.spark, self.name)
        save = keyed_batches(out)

        def write(batch: DataFrame, batch_id: int) -> None:
            save(transform(batch, batch_id), batch_id)

        self.run(df.writeStream.foreachBatch(write).outputMode(mode), after)
        return self.spark.read.option("basePath", out).parquet(f"{out}/{BATCH}=*")
