"""Distinct visitors: exact, hashed to a bitmap, and sketched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.panes import tumbling_totals

# Fixed values of the visitor bitmap: hash seed and number of bits.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def exact_uv(df: DataFrame, ts: str, size: str, user: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact distinct users per window.

    On a stream, where a distinct aggregate does not exist, users are first
    deduplicated per window and then counted.
    """
    if df.isStreaming:
        once = df.groupBy(F.window(ts, size).alias("window"), user, *keys).agg(
            F.count(F.lit(1)).alias("_n"))
        return once.groupBy("window", *keys).agg(F.count(F.lit(1)).alias("uv"))
    return tumbling_totals(df, ts, keys, size, {"uv": F.count_distinct(user)})


def text_hash(text: Column, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> Column:
    """Polynomial hash of a text, masked to ``bits`` (a power of two).

    Masking after every step gives the same value as masking once at the end
    and keeps the sum far from overflow.
    """
    codes = F.transform(F.split(text, ""), lambda ch: F.ascii(ch).cast("long"))
    return F.aggregate(
        codes, F.lit(0).cast("long"),
        lambda acc, code: (acc * F.lit(seed) + code).bitwiseAND(F.lit(bits - 1)))


def bitmap_uv(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """Visitors per window counted as set bits of a hashed bitmap.

    Counting distinct bit numbers gives the bitmap's population without building
    it: a sparse bitmap would travel as blocks that are mostly zeros.  Colliding
    users count once, as in any single-hash bitmap.
    """
    hashed = df.withColumn("_bit", text_hash(F.col(user).cast("string")))
    return tumbling_totals(hashed, ts, [], size, {"uv": F.count_distinct("_bit")})


def approx_uv(df: DataFrame, ts: str, size: str, user: str, rsd: float = 0.02) -> DataFrame:
    return tumbling_totals(df, ts, [], size, {"uv": F.approx_count_distinct(user, rsd)})


def hll_sketches(
    df: DataFrame, ts: str, size: str, user: str, log2m: int = 14, keys: Sequence[str] = (),
) -> DataFrame:
    """One mergeable sketch per window."""
    return tumbling_totals(df, ts, keys, size, {"sketch": F.hll_sketch_agg(user, log2m)})


def hll_rollup(sketches: DataFrame, *group) -> DataFrame:
    """Merge sketches to coarser groups and estimate."""
    return sketches.groupBy(*group).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv"))


def hll_checked(rolled: DataFrame, exact: DataFrame, on: Sequence[str], log2m: int = 14, deviations: float = 4.0) -> DataFrame:
    """``on, uv, within``: exact counts, and whether the estimates ``uv`` of ``rolled`` keep to their error bound.

    The standard error of a sketch is 1.04 / sqrt(2 ** log2m); ``deviations`` of it are allowed, and one user.
    """
    bound = deviations * 1.04 / 2 ** (log2m / 2)
    return exact.join(rolled.withColumnRenamed("uv", "_estimate"), list(on), "left").select(
        *on, "uv", F.coalesce(F.abs(F.col("_estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * bound),
                              F.lit(False)).alias("within"))


def cumulative_uv(
    df: DataFrame, keys: Sequence[str], user: str, period_start: Column, step_end: Column,
) -> DataFrame:
    """Distinct users since the period began, at every step in which the key had rows.

    A user's steps within a period are a small set; its first element is where the
    user counts.  So the input is read once, and a key has one row per step when
    the running sum is taken.
    """
    visits = df.select(*keys, user, period_start.alias("period"), step_end.alias("step_end"))
    steps = visits.groupBy(*keys, "period", user).agg(
        F.sort_array(F.collect_set("step_end")).alias("_steps"))
    counted = steps.select(*keys, "period", F.posexplode("_steps").alias("_i", "step_end")).groupBy(
        *keys, "period", "step_end").agg(F.count_if(F.col("_i") == 0).alias("_new"))
    scan = Window.partitionBy(*keys, "period").orderBy("step_end")
    return counted.select(*keys, "period", "step_end", F.sum("_new").over(scan).alias("uv"))
