"""Running streaming queries over bounded input and reading their result.

Every query has its own checkpoint and output folder below the shared scratch
root.  ``availableNow`` processes what the source holds and stops; in append
mode windows that the watermark has not passed stay open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ROCKSDB_PROVIDER, scratch_dir
from tidemark.sinks.batched import keyed_batches

BATCH = "batch"


def use_rocksdb(spark: SparkSession) -> None:
    """State on disk with incremental changelog checkpoints; custom state needs it.

    A count of the state's rows, for progress reports only, would cost a read before every write.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


def stream_of(
    spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None,
) -> DataFrame:
    """A table as a stream; zone-less times become instants, which a watermark needs.

    Without ``files_per_trigger`` one batch takes all files, whatever their
    order; with it the files must arrive in event-time order up to the delay.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.parquet(sf_dir)
    for field in schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def finish(writer, checkpoint: str):
    """Start, run to the end of the input, and raise what failed."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), checkpoint: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Append-mode run into Parquet files (exactly once per checkpoint); returns the files' content."""
    spark = df.sparkSession
    out = path or scratch_dir(spark, name)
    writer = df.writeStream.format("parquet").outputMode("append").option("path", out)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    finish(writer, checkpoint or scratch_dir(spark, f"{name}-ckpt"))
    return spark.read.schema(df.schema).parquet(out)


def to_batches(
    df: DataFrame, name: str, transform: Callable[[DataFrame, int], DataFrame], mode: str,
    checkpoint: str | None = None,
) -> DataFrame:
    """Run ``transform`` on each batch and keep the results by batch id (column ``batch``).

    A replayed batch overwrites its own folder, so the result holds each batch once.
    """
    spark = df.sparkSession
    out = scratch_dir(spark, name)
    save = keyed_batches(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        save(transform(batch, batch_id), batch_id)

    finish(df.writeStream.foreachBatch(write).outputMode(mode),
           checkpoint or scratch_dir(spark, f"{name}-ckpt"))
    return spark.read.parquet(out)


def newest(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest version of every key of an update-mode result."""
    rest = [c for c in batches.columns if c not in keys and c != BATCH]
    return batches.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col(BATCH)).alias("_v")).select(*keys, "_v.*")
