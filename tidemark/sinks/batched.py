"""Sinks that hand records to a client in small batches.

Tasks are the parallel clients.  A task streams its partition and passes on at
most ``batch_size`` records at a time, so nothing is gathered and the buffer is
always emptied by the call that flushed it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import row_numbers


def chunks(rows: Iterator, size: int) -> Iterator[list]:
    while batch := list(islice(rows, size)):
        yield batch


def save_in_batches(
    df: DataFrame, save_records: Callable[[list], None], batch_size: int, clients: int | None = None,
) -> None:
    """Call ``save_records`` with lists of at most ``batch_size`` rows, ``clients`` tasks at once."""

    def write(rows: Iterator) -> None:
        for batch in chunks(rows, batch_size):
            save_records(batch)

    (df.repartition(clients) if clients else df).foreachPartition(write)


def batch_writer(save: Callable[[DataFrame, int], None]):
    """A ``foreachBatch`` function; replays carry the same ``batch_id``, so ``save`` can be idempotent."""

    def run(batch: DataFrame, batch_id: int) -> None:
        save(batch, batch_id)

    return run


def keyed_batches(path: str, fmt: str = "parquet"):
    """``foreachBatch`` sink with one folder per batch id; a replayed batch replaces its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return batch_writer(save)


def wide_column_puts(df: DataFrame, order: list[str], line: Column, names: list[str], n: int,
    width: Width = None) -> DataFrame:
    """Records as wide-column puts in batches of ``n``.

    The row key is the record with ``::`` replaced by ``_``; every field becomes
    one entry of the column map.
    """
    fields = F.split(line, "::")
    puts = df.select(
        *order, F.replace(line, F.lit("::"), F.lit("_")).alias("rowkey"),
        F.map_from_arrays(F.array(*[F.lit(x) for x in names]), fields).alias("columns"))
    numbered = row_numbers(puts, [], order, width, "_rn")
    return numbered.withColumn(
        "batch_no", F.call_function("div", F.col("_rn") - 1, F.lit(n)).cast("long")).drop("_rn")
