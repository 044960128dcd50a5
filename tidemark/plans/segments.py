"""Greedy chains over independent segments.

Some operators restart from their own last result ("fire, then wait for the next
80 metres"), so what a row does depends on the rows before it.  Such a chain
breaks wherever the outcome of a row does not depend on the past.  These reset
rows are found with the bucketed scans of ``ordered``; each stretch between two
resets is a segment, and segments run in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import running

SEGMENT = "_segment"


def with_segments(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], reset: Column, width: Width = None,
) -> DataFrame:
    """Number the stretches of each key; a row where ``reset`` holds starts a new one."""
    marked = df.withColumn("_reset", F.coalesce(reset, F.lit(True)).cast("long"))
    return running(marked, keys, order, {SEGMENT: ("_reset", "sum")}, width).drop("_reset")


def chain_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, gap: int,
) -> DataFrame:
    """Rows on the greedy chain of each segment; null keys form one key.

    The first row of a segment is on the chain; after it, always the next row
    whose ``value`` exceeds that of the last chain row by more than ``gap``.
    ``value`` is a BIGINT that does not decrease within a segment.

    Spark places and sorts the rows.  A task reads its sorted batches as a
    stream and carries one number from batch to batch, so memory does not grow
    with the segment.
    """
    # Keys are compared as one text, in which a null equals a null.
    by = ["_chain", SEGMENT]
    placed = (
        df.withColumn("_chain", F.to_json(F.struct(*keys)) if keys else F.lit(""))
        .repartition(*by).sortWithinPartitions(*by, *order)
    )

    columns = df.columns

    def on_chains(batches):
        segment, base = None, None
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            values = batch.column(value).to_numpy()
            opens = np.ones(rows, dtype=bool)
            opens[1:] = np.logical_or.reduce([
                pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, rows - 1)).to_numpy(zero_copy_only=False)
                for c in by])
            starts = np.flatnonzero(opens)
            ends = np.append(starts[1:], rows)
            on_chain = np.zeros(rows, dtype=bool)
            at = starts.copy()
            if tuple(batch.column(c)[0].as_py() for c in by) == segment:
                at[:1] = _first_above(values, at[:1], ends[:1], np.array([base + gap]))
            limit = ends
            while True:
                alive = at < limit
                at, limit = at[alive], limit[alive]
                if not len(at):
                    break
                on_chain[at] = True
                at = _first_above(values, at + 1, limit, values[at] + gap)
            tail = np.flatnonzero(on_chain[starts[-1]:])
            if len(tail):
                base = values[starts[-1] + tail[-1]]
            segment = tuple(batch.column(c)[rows - 1].as_py() for c in by)
            yield batch.select(columns).filter(pa.array(on_chain))

    return placed.mapInArrow(on_chains, df.schema)


def _first_above(values, low, high, target):
    """For each range ``[low, high)`` of the sorted values, the first index above ``target``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        below = open_ & (values[np.minimum(middle, len(values) - 1)] <= target)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
