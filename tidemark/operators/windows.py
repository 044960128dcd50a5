"""Event-time windows over DataFrames (batch and streaming)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import row_numbers
from tidemark.plans.panes import sliding_totals, tumbling_totals
from tidemark.plans.timing import floor_div, instant, micros, plain, position, window_end


def flatten_window(df: DataFrame, *rest: str) -> DataFrame:
    """Replace the window struct by plain ``window_start`` / ``window_end`` columns."""
    others = rest or tuple(c for c in df.columns if c != "window")
    return df.select(
        plain(F.col("window.start")).alias("window_start"),
        plain(F.col("window.end")).alias("window_end"), *others)


def tumbling(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], offset: str | None = None,
    **aggs: Column,
) -> DataFrame:
    """Aggregates per key and tumbling window; partial aggregation runs map-side."""
    return tumbling_totals(df, ts, keys, size, aggs, offset)


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (), **totals: Column,
) -> DataFrame:
    """Additive aggregates per key and sliding window, via panes."""
    return sliding_totals(df, ts, keys, size, slide, totals)


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Additive aggregates per key and session window closed by ``gap`` without events.

    Batch input is first aggregated to cells of one gap length: rows of a cell are
    closer than the gap and always share a session.  Sessions are then put
    together from cells, of which a key has at most ``time span / gap``.
    """
    keys, width = list(keys), micros(gap)
    if df.isStreaming:
        return df.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(
            *[agg.alias(name) for name, agg in totals.items()])
    rows = df.filter(F.col(ts).isNotNull()).withColumn("_pos", position(ts))
    cells = rows.groupBy(*keys, floor_div("_pos", width).alias("_cell")).agg(
        F.min("_pos").alias("_low"), F.max("_pos").alias("_high"),
        *[agg.alias(name) for name, agg in totals.items()])
    scan = Window.partitionBy(*keys).orderBy("_cell")
    opens = F.coalesce(F.col("_low") - F.lag("_high").over(scan) >= width, F.lit(True))
    numbered = cells.withColumn("_opens", opens.cast("long")).withColumn(
        "_session", F.sum("_opens").over(scan))
    merged = numbered.groupBy(*keys, "_session").agg(
        F.min("_low").alias("_low"), F.max("_high").alias("_high"),
        *[F.sum(name).alias(name) for name in totals])
    window = F.struct(instant("_low").alias("start"), instant(F.col("_high") + width).alias("end"))
    return merged.select(window.alias("window"), *keys, *totals)


def count_windows(
    df: DataFrame, order: Sequence[str], n: int, width: Width = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Number rows into consecutive windows of ``n`` elements (``window_no`` from 0)."""
    numbered = row_numbers(df, keys, order, width, "_rn")
    return numbered.withColumn(
        "window_no", F.call_function("div", F.col("_rn") - 1, F.lit(n)).cast("long")).drop("_rn")


def early_fire_sums(
    df: DataFrame, ts: str, keys: Sequence[str], value: str, size: str, every: str,
) -> DataFrame:
    """Running window sum re-emitted at each ``every`` mark until the window ends.

    A window starts to fire at the first mark after its first row and fires at
    every later mark, with or without new rows, its last mark being its end.
    """
    step = micros(every)
    panes = df.groupBy(
        F.window(ts, size).alias("window"), *keys,
        window_end(ts, every).alias("_mark"),
    ).agg(F.sum(value).alias("_sum"))
    # At most size / every rows per key and window from here on.
    scan = Window.partitionBy("window", *keys).orderBy("_mark")
    upto = F.coalesce(F.lead("_mark").over(scan) - F.expr(f"INTERVAL {step} MICROSECOND"),
                      F.col("window.end"))
    filled = panes.select(
        "window", *keys, F.sum("_sum").over(scan).alias("running_sum"), "_mark", upto.alias("_upto"))
    return filled.select(
        "window", *keys,
        F.explode(F.sequence("_mark", "_upto", F.expr(f"INTERVAL {step} MICROSECOND"))).alias("fire_at"),
        "running_sum")
