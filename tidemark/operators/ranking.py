"""Top-N rankings and row comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import in_bucket, overlap, settle, with_previous
from tidemark.plans.timing import micros


def top_n(
    df: DataFrame, group: Sequence, order: Sequence, n: int, rank: str = "rank",
) -> DataFrame:
    """First ``n`` rows of each group under a total order.

    Written as ``row_number() <= n``, which Spark turns into a group limit before
    the shuffle: each map task sends at most ``n`` rows per group, so a group of
    any size is ranked without being gathered.  Spark does so for n up to its
    threshold; beyond it the groups are first ranked in hashed parts.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n >= threshold:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(64))
        local = Window.partitionBy(*group, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_r", F.row_number().over(local)).filter(
            F.col("_r") <= n).drop("_part", "_r")
    scan = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(scan)).filter(F.col(rank) <= n)


def two_stage_top_n(
    df: DataFrame, key: str, count: str, group: Column, n_group: int, n_all: int,
) -> DataFrame:
    """Best ``n_group`` per group, then best ``n_all`` over all groups."""
    first = top_n(df.withColumn("_group", group), ["_group"], [F.desc(count), key], n_group, "_r")
    return first.drop("_r").orderBy(F.desc(count), key).limit(n_all).withColumnRenamed("_group", "grp")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key, by aggregation (no sort, partial results map-side)."""
    if df.isStreaming:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")).select(*keys, "_first.*")


def previous_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], event: str, wanted: str,
    within: str, width: Width = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of type ``wanted`` whose previous row of the key is also ``wanted``
    and less than ``within`` earlier."""
    rows = overlap(df, keys, order[0], width, behind=within)
    scan = in_bucket(keys, *order)
    seen = rows.withColumn("prev_type", F.lag(event).over(scan)).withColumn(
        "prev_pos", F.lag(order[0]).over(scan))
    for col in keep:
        seen = seen.withColumn(f"prev_{col}", F.lag(col).over(scan))
    hit = (
        (F.col(event) == wanted) & (F.col("prev_type") == wanted)
        & (F.col(order[0]) - F.col("prev_pos") < F.lit(micros(within)))
    )
    return settle(seen).filter(hit)


def value_jumps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, threshold: float,
    width: Width = None,
) -> DataFrame:
    """Rows whose value differs from the key's previous value by more than ``threshold``.

    A previous value of zero counts as absent.
    """
    seen = with_previous(df, keys, order, [value], width)
    before = F.col(f"prev_{value}")
    return seen.filter((before != 0) & (F.abs(before - F.col(value)) > threshold))
