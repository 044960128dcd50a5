"""Token counts of a corpus from an exact histogram of encoded lengths.

Documents are aggregated by their number of tokens.  From sums over all shorter and all longer documents, each length
answers for the context limit of that many tokens: how many documents fit, how many tokens all documents have after
truncation to the limit, and which quantile it is.  Any other limit or quantile follows from the next length.

The sums are taken within buckets of lengths and over the buckets' totals, so the histogram is not ordered in one task.

Rows: a null or empty text has length 0; repeated rows count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.staging import staged

BUCKET_LENGTHS = 1024


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per length of ``lengths(n_tokens)``, for use as a context limit.

    ``documents`` and ``tokens`` of that length; ``documents_longer`` and ``tokens_longer`` of the greater lengths;
    ``truncated_tokens``, the total if every document keeps at most that many; ``quantile``, the share of documents
    that are not longer; ``total_tokens`` of all.
    """
    histogram = staged(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("documents")).select(
        "n_tokens", "documents", (F.col("documents") * F.col("n_tokens")).alias("tokens"),
        F.floor(F.col("n_tokens") / BUCKET_LENGTHS).alias("_bucket")), "length-histogram")
    after = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    # One row per 1,024 lengths: bounded by the longest document.
    buckets = histogram.groupBy("_bucket").agg(F.sum("documents").alias("_d"), F.sum("tokens").alias("_t")).select(
        "_bucket", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_later_d"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_later_t"),
        F.sum("_d").over(all_rows).alias("_all_d"), F.sum("_t").over(all_rows).alias("total_tokens"))
    longer = Window.partitionBy("_bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    return histogram.join(buckets, "_bucket").select(
        "n_tokens", "documents", "tokens", "_all_d", "total_tokens",
        (F.coalesce(F.sum("documents").over(longer), F.lit(0)) + F.col("_later_d")).alias("documents_longer"),
        (F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("_later_t")).alias("tokens_longer"),
    ).select(
        "n_tokens", "documents", "tokens", "documents_longer", "tokens_longer",
        (F.col("total_tokens") - F.col("tokens_longer") + F.col("documents_longer") * F.col("n_tokens")
         ).alias("truncated_tokens"),
        ((F.col("_all_d") - F.col("documents_longer")) / F.col("_all_d")).alias("quantile"), "total_tokens")


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``limit, documents_longer, truncated_tokens`` for any limits: the greatest length within each limit answers."""
    spark = histogram.sparkSession
    asked = spark.createDataFrame([(n,) for n in limits], "limit long")
    within = histogram.join(F.broadcast(asked), F.col("n_tokens") <= F.col("limit")).groupBy("limit").agg(
        F.max_by(F.struct("documents_longer", "tokens_longer", "total_tokens"), "n_tokens").alias("h"))
    totals = histogram.agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    return asked.join(within, "limit", "left").join(F.broadcast(totals)).select(
        "limit", F.coalesce("h.documents_longer", "d").alias("documents_longer"),
        (F.coalesce("t", F.lit(0)) - F.coalesce("h.tokens_longer", "t", F.lit(0))
         + F.coalesce("h.documents_longer", "d", F.lit(0)) * F.col("limit")).alias("truncated_tokens"))
