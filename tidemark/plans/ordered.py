"""Ordered per-key scans that do not put a whole key into one task.

A window function over ``PARTITION BY key ORDER BY time`` sorts everything a
key owns in a single task.  When one key holds a third of the table that task
never ends.  The scans here cut the rows of hot keys into time buckets (see
``buckets``) and run the window function per ``(key, bucket)``:

* ``with_previous`` / ``with_next`` / ``running`` need information from other
  buckets.  That is one small row per hot key and bucket, aggregated map-side,
  scanned per key, and handed to the bucket it concerns as an extra row.  A key
  has at most as many of these rows as there are buckets.
* ``overlap`` is for operators that only look a bounded distance around a row:
  rows near a bucket border are copied into the neighbouring bucket, and
  nothing else crosses buckets.

Both are exact.  ``width`` (a duration, ready-made buckets, or ``None`` to
measure the data) only moves work between tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.buckets import HOT, Width, buckets_for, mark_hot
from tidemark.plans.timing import micros

BUCKET = "_bucket"
CARRIED = "_carried"


def _placed(flagged: DataFrame, pos: str, buckets) -> DataFrame:
    """Rows with their bucket: the cut one for hot keys, 0 for the others."""
    placed = buckets.assign(flagged, pos, BUCKET)
    return placed.withColumn(BUCKET, F.when(F.col(HOT), F.col(BUCKET)).otherwise(F.lit(0)))


def _neighbour(df, keys, order, values, width, prefix, forward: bool) -> DataFrame:
    keys, order, values = list(keys), list(order), list(values)
    buckets = buckets_for(df, order[0], width)
    shift = F.lead if forward else F.lag
    flagged = mark_hot(df, keys, buckets)
    if flagged is None:
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[shift(v).over(whole).alias(prefix + v) for v in values])
    rows = _placed(flagged, order[0], buckets)
    fields = list(dict.fromkeys([*order, *values]))
    pick = F.min_by if forward else F.max_by
    edge = rows.filter(HOT).groupBy(*keys, BUCKET).agg(
        pick(F.struct(*fields), F.struct(*order)).alias("_edge")
    )
    by_bucket = Window.partitionBy(*keys).orderBy(BUCKET)
    target = F.lag(BUCKET).over(by_bucket) if forward else F.lead(BUCKET).over(by_bucket)
    handed = (
        edge.withColumn(BUCKET, target)
        .filter(F.col(BUCKET).isNotNull())
        .select(*keys, BUCKET, *[F.col(f"_edge.{f}").alias(f) for f in fields if f not in keys],
                F.lit(True).alias(CARRIED))
    )
    both = rows.withColumn(CARRIED, F.lit(False)).unionByName(handed, allowMissingColumns=True)
    scan = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    return (
        both.select("*", *[shift(v).over(scan).alias(prefix + v) for v in values])
        .filter(~F.col(CARRIED))
        .drop(BUCKET, CARRIED, HOT)
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    width: Width = None, prefix: str = "prev_",
) -> DataFrame:
    """``lag(value)`` per key for every value.

    ``order`` starts with the BIGINT position and must be a total order per key.
    """
    return _neighbour(df, keys, order, values, width, prefix, forward=False)


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    width: Width = None, prefix: str = "next_",
) -> DataFrame:
    """``lead(value)`` per key for every value."""
    return _neighbour(df, keys, order, values, width, prefix, forward=True)


def _fold(fold: str, column: str) -> Column:
    if fold == "last":
        return F.last(column, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[fold](column)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    measures: dict[str, tuple[str, str]], width: Width = None,
) -> DataFrame:
    """Running aggregates from the first row of the key up to the current one.

    ``measures`` maps an output column to ``(input column, fold)`` with fold one
    of ``sum``, ``max``, ``min`` or ``last`` (latest value that is not null).
    """
    keys, order = list(keys), list(order)
    buckets = buckets_for(df, order[0], width)
    flagged = mark_hot(df, keys, buckets)
    if flagged is None:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[_fold(fold, source).over(whole).alias(out)
                                for out, (source, fold) in measures.items()])
    rows = _placed(flagged, order[0], buckets)
    for out, (source, _) in measures.items():
        rows = rows.withColumn(f"_m_{out}", F.col(source))

    totals, carried, folded = [], [], []
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    scan = Window.partitionBy(*keys, BUCKET).orderBy(F.col(CARRIED).desc(), *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for out, (_, fold) in measures.items():
        name = f"_m_{out}"
        newest = F.max_by(name, F.when(F.col(name).isNotNull(), F.struct(*order)))
        totals.append((newest if fold == "last" else _fold(fold, name)).alias(name))
        carried.append(_fold(fold, name).over(before).alias(name))
        folded.append(_fold(fold, name).over(scan).alias(out))
    names = [f"_m_{out}" for out in measures]
    handed = (
        rows.filter(HOT).groupBy(*keys, BUCKET).agg(*totals)
        .select(*keys, BUCKET, *carried)
        .filter(reduce(or_, [F.col(n).isNotNull() for n in names]))
        .withColumn(CARRIED, F.lit(True))
    )
    both = rows.withColumn(CARRIED, F.lit(False)).unionByName(handed, allowMissingColumns=True)
    return both.select("*", *folded).filter(~F.col(CARRIED)).drop(BUCKET, CARRIED, HOT, *names)


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], width: Width = None,
    name: str = "rn",
) -> DataFrame:
    """``row_number()`` per key, counted bucket by bucket."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running(ones, keys, order, {name: ("_one", "sum")}, width).drop("_one")


def overlap(
    df: DataFrame, keys: Sequence[str], pos: str, width: Width = None, ahead: str | int = 0,
    behind: str | int = 0,
) -> DataFrame:
    """Assign the rows of hot keys to time buckets, copying those near a border.

    A bucket receives copies (``_carried`` = true) of the rows up to ``ahead``
    after its end and up to ``behind`` before its start.  Run the window
    function over ``(key, _bucket)`` and keep rows with ``_carried`` = false.
    Measured buckets are kept much longer than the reach, so few rows are copied.
    """
    after, before = micros(ahead), micros(behind)
    buckets = buckets_for(df, pos, width, apart=8 * max(after, before))
    flagged = mark_hot(df, keys, buckets)
    if flagged is None:
        return df.withColumn(BUCKET, F.lit(0).cast("long")).withColumn(CARRIED, F.lit(False))
    cut = buckets.assign(flagged, pos, "_home")
    cut = buckets.assign(cut.withColumn("_low", F.col(pos) - F.lit(after)), "_low", "_from")
    cut = buckets.assign(cut.withColumn("_high", F.col(pos) + F.lit(before)), "_high", "_to")
    seen_by = F.when(F.col(HOT), F.sequence("_from", "_to")).otherwise(F.array(F.lit(0).cast("long")))
    return (
        cut.withColumn(BUCKET, F.explode(seen_by))
        .withColumn(CARRIED, F.col(HOT) & (F.col(BUCKET) != F.col("_home")))
        .drop("_low", "_high", "_from", "_to", "_home", HOT)
    )


def in_bucket(keys: Sequence[str], *order) -> "Window":
    """Window specification per key and bucket, for use after ``overlap``."""
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)


def settle(df: DataFrame) -> DataFrame:
    """Drop the border copies made by ``overlap``."""
    return df.filter(~F.col(CARRIED)).drop(BUCKET, CARRIED)


def asof_latest(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str],
    right_pos: str, values: Sequence[str], width: Width = None, right_tie: Sequence[str] = (),
) -> DataFrame:
    """Attach to each left row the latest right row of its key at or before it.

    Both sides are merged into one ordered sequence; the right row's values
    travel forward with a running ``last``.  Nothing is joined row against row,
    and a right row at the same position counts as earlier.
    """
    keys, left_order = list(keys), list(left_order)
    pos = left_order[0]
    probes = left.withColumn("_side", F.lit(1)).withColumn("_tie", F.lit(""))
    builds = right.select(
        *keys, F.col(right_pos).alias(pos), F.lit(0).alias("_side"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in right_tie]).alias("_tie"),
        F.struct(*values).alias("_right"),
    )
    both = probes.unionByName(builds, allowMissingColumns=True)
    # Measured on both sides: either may hold the hot key's long history.
    scanned = running(both, keys, [pos, "_side", "_tie"], {"_latest": ("_right", "last")}, width)
    return scanned.filter(F.col("_side") == 1).select(
        *left.columns, *[F.col(f"_latest.{v}").alias(v) for v in values])
