"""Tumbling and sliding windows.

On batch input the grouping key is the window's start as a plain number, which
hashes and sorts faster than a window struct; the ``window`` struct column is put
together after the aggregation.  Streams group by ``F.window``, whose metadata
the watermark needs.

A direct sliding window copies each input row ``size / slide`` times before the
first aggregation.  Here rows are first aggregated per pane (a tumbling window
of one slide), and only the pane totals are spread over the windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.timing import floor_div, instant, micros, position

START = "_start"


def _start(ts: str, size: int, offset: int = 0) -> Column:
    pos = position(ts)
    return pos - F.pmod(pos - F.lit(offset), F.lit(size))


def _with_window(df: DataFrame, size: int, rest: Sequence[str]) -> DataFrame:
    window = F.struct(
        instant(START).alias("start"), instant(F.col(START) + F.lit(size)).alias("end"))
    return df.select(window.alias("window"), *rest)


def tumbling_totals(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, aggs: dict[str, Column],
    offset: str | None = None,
) -> DataFrame:
    """Any aggregates per key and tumbling window."""
    columns = [agg.alias(name) for name, agg in aggs.items()]
    if df.isStreaming:
        return df.groupBy(F.window(ts, size, startTime=offset).alias("window"), *keys).agg(*columns)
    width = micros(size)
    grouped = df.filter(F.col(ts).isNotNull()).groupBy(
        _start(ts, width, micros(offset or 0)).alias(START), *keys).agg(*columns)
    return _with_window(grouped, width, [*keys, *aggs])


def sliding_totals(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str,
    totals: dict[str, Column],
) -> DataFrame:
    """Sum-like aggregates per key and sliding window.

    ``totals`` maps output names to aggregates whose partial results add up
    (``count``, ``sum``).  Works on batch and streaming input; on a stream put a
    watermark on ``ts`` and use append mode.
    """
    keys = list(keys)
    width, step = micros(size), micros(slide)
    if width % step:
        raise ValueError("window size must be a multiple of the slide")
    columns = [agg.alias(name) for name, agg in totals.items()]
    sums = [F.sum(name).alias(name) for name in totals]
    if df.isStreaming:
        panes = df.groupBy(F.window(ts, slide).alias("_pane"), *keys).agg(*columns)
        moved = panes.withColumn("_at", F.window_time("_pane")).drop("_pane")
        return moved.groupBy(F.window("_at", size, slide).alias("window"), *keys).agg(*sums)
    panes = df.filter(F.col(ts).isNotNull()).groupBy(
        floor_div(position(ts), step).alias("_pane"), *keys).agg(*columns)
    if keys:
        # One copy of each pane total is shuffled by key; the spread over the
        # windows and the final sum then run inside that partitioning.  The
        # partition count is explicit because adaptive merging would go by the
        # size before the spread.
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        panes = panes.repartition(parts, *keys)
    starts = F.transform(
        F.sequence(F.col("_pane") - (width // step - 1), F.col("_pane")), lambda p: p * step)
    spread = panes.select(F.explode(starts).alias(START), *keys, *totals)
    return _with_window(spread.groupBy(START, *keys).agg(*sums), width, [*keys, *totals])
