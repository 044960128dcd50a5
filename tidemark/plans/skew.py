"""Hot keys and checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 1024 * 1024


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Hint a broadcast after measuring that the frame is small.

    Reads at most ``max_rows + 1`` rows.  A larger frame comes back unhinted, so
    the join stays a shuffle join that adaptive execution can split.
    """
    width = F.length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    small = seen["rows"] <= max_rows and seen["bytes"] <= max_bytes
    return F.broadcast(df) if small else df


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys that own more than ``share`` of all rows: at most ``1 / share`` rows."""
    total = df.count()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > F.lit(total * share)).select(*keys)


def salted_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner",
    salts: int = 32, share: float = 0.01,
) -> DataFrame:
    """Fact-to-dimension join with the fact rows of hot keys spread over ``salts`` tasks.

    Only hot keys are salted, and only their dimension rows are repeated.  The
    list of hot keys has at most ``1 / share`` rows, so it can be broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted joins keep or drop fact rows: use inner or left")
    keys = list(keys)
    hot = F.broadcast(hot_keys(fact, keys, share).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    facts = fact.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    dims = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return facts.join(dims, [*keys, "_salt"], how).drop("_salt")
