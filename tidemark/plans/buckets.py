"""Cutting the time axis into buckets.

An ordered scan is split into buckets of positions.  Any cut gives the same
result; it only decides how much work a task gets.  By default the cut follows
the data: split points are quantiles of the position, so that no bucket, and
therefore no key within a bucket, holds much more than ``rowsPerBucket`` rows,
however skewed the keys or the times are.  Only hot keys, those with more rows
than a bucket, are cut at all; the others stay in bucket 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.timing import floor_div, micros

ROWS_PER_BUCKET = "tidemark.rowsPerBucket"
DEFAULT_ROWS = 2_000_000
MOST_BUCKETS = 10_000
SAMPLED_ROWS = 5_000_000
HOT = "_hot"


@dataclass(frozen=True)
class Grid:
    """Buckets of equal width."""

    width: int
    single = False

    def assign(self, df: DataFrame, source: str, out: str) -> DataFrame:
        return df.withColumn(out, floor_div(source, self.width))

    def mirrored(self) -> Grid:
        return self


@dataclass(frozen=True)
class Splits:
    """Buckets between ascending split points, measured on ``rows`` rows."""

    points: tuple[float, ...]
    rows: int = 0
    hot: dict = field(default_factory=dict, compare=False)

    @property
    def single(self) -> bool:
        return not self.points

    def assign(self, df: DataFrame, source: str, out: str) -> DataFrame:
        if self.single:
            return df.withColumn(out, F.lit(0).cast("long"))
        cut = Bucketizer(
            splits=[-math.inf, *self.points, math.inf], inputCol="_at", outputCol="_cut",
            handleInvalid="keep")
        placed = cut.transform(df.withColumn("_at", F.col(source).cast("double")))
        return placed.withColumn(out, F.col("_cut").cast("long")).drop("_at", "_cut")

    def mirrored(self) -> Splits:
        """The same cut for negated positions."""
        return Splits(tuple(-p for p in reversed(self.points)), self.rows, self.hot)

    def hot_keys(self, df: DataFrame, keys: Sequence[str]) -> list:
        """Keys with more rows than a bucket: at most one per bucket.

        Large input is sampled for this.  Which keys count as hot changes who
        does the work, never a result; the list is taken once, so that all parts
        of a plan agree on it.
        """
        name = tuple(keys)
        if name not in self.hot:
            share = min(1.0, SAMPLED_ROWS / max(self.rows, 1))
            seen = df if share == 1.0 else df.sample(share, seed=1)
            limit = share * self.rows / (len(self.points) + 1)
            counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            self.hot[name] = counts.filter(F.col("_rows") > limit).select(*keys).collect()
        return self.hot[name]


def mark_hot(df: DataFrame, keys: Sequence[str], buckets: Grid | Splits) -> DataFrame | None:
    """Add the flag ``_hot`` to the rows whose key is cut into buckets; None when no key is.

    A fixed grid, like a scan without key, cuts everything.
    """
    if buckets.single:
        return None
    if isinstance(buckets, Grid) or not keys:
        return df.withColumn(HOT, F.lit(True))
    found = buckets.hot_keys(df, keys)
    if not found:
        return None
    names = [f"_hot_{i}" for i in range(len(keys))]
    listed = df.sparkSession.createDataFrame(found, df.select(*keys).schema).toDF(*names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    flagged = df.join(F.broadcast(listed.withColumn(HOT, F.lit(True))), same, "left").drop(*names)
    return flagged.withColumn(HOT, F.coalesce(HOT, F.lit(False)))


Buckets = Grid | Splits
Width = str | int | Buckets | None


def buckets_for(
    df: DataFrame, pos: str, width: Width = None, apart: int = 0,
) -> Buckets:
    """The buckets for scanning ``df`` by ``pos``.

    A duration or number asks for equal widths; ``None`` measures the data with
    one small aggregate, and for large input its quantiles.  Split points closer
    than ``apart`` are merged.
    """
    if isinstance(width, (Grid, Splits)):
        return width
    if width is not None:
        return Grid(max(micros(width), 1))
    per_bucket = int(df.sparkSession.conf.get(ROWS_PER_BUCKET, str(DEFAULT_ROWS)))
    rows = df.agg(F.count(pos)).first()[0]
    wanted = min(math.ceil(rows / per_bucket), MOST_BUCKETS)
    if wanted <= 1:
        return Splits((), rows)
    found = df.select(F.col(pos).cast("double").alias("_at")).approxQuantile(
        "_at", [i / wanted for i in range(1, wanted)], 0.5 / wanted)
    points: list[float] = []
    for point in sorted(set(found)):
        if not points or point - points[-1] >= max(apart, 1):
            points.append(point)
    return Splits(tuple(points), rows)
