"""Loading tables and walking Arrow batches in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch; texts can be long, so batches are kept short.
BATCH_ROWS = 256


def prepare_texts(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of long texts small, unless the session already asks for smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_texts(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Whether a document must not be learned from: crc32 of its id, as text, is divisible by five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; a null is an empty text."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row stands alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def long_array(values: list[np.ndarray]) -> pa.Array:
    """A list<int64> column from one array of 64-bit numbers per row."""
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values))
    flat = np.concatenate(values) if len(values) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


FILTER_BITS = 1 << 23


def _marked(frame: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``frame`` with the word of a bitmap of hashed ids in which each row's bit is.

    The bitmap has at most ``FILTER_BITS`` / 64 rows of one number each (2 MB) whatever the input, so it can be
    broadcast, and rows with long texts are told apart before a join shuffles them.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bitmap = ids.select(slot.alias("_slot")).groupBy(F.floor(F.col("_slot") / 64).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_slot % 64 as int))")).alias("_bits"))
    return frame.withColumn("_slot", slot).withColumn("_word", F.floor(F.col("_slot") / 64)).join(
        F.broadcast(bitmap), "_word", how)


_BIT = "shiftright(_bits, cast(_slot % 64 as int)) & 1"


def rows_of(frame: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``frame`` whose ``key`` is among ``ids``, which has that one column.

    Spark moves a semi join below the bitmap's join and shuffles all rows for it; an inner join stays above.
    """
    kept = _marked(frame, ids, key, "inner").filter(f"{_BIT} = 1")
    return kept.select(*frame.columns).join(ids.distinct(), key).select(*frame.columns)


def rows_apart(frame: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``frame`` whose ``key`` may be among ``ids``, with all for which it is, and the others.

    Join the former with an outer join: a semi or anti join moves below the bitmap's, as in ``rows_of``.
    """
    marked = _marked(frame, ids, key, "left").withColumn("_hit", F.expr(f"coalesce({_BIT}, 0L) = 1"))
    return marked.filter("_hit").select(*frame.columns), marked.filter("not _hit").select(*frame.columns)
