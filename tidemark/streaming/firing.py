"""Windows that fire more than once, and a side output for the rows that come too late.

Every firing is a row of its own with a version, so the result is a log of all firings and not the last one.  A window
fires when the watermark reaches its end, on every mark of ``every`` before that, and again in each batch that brings
rows for it while the watermark is within ``lateness`` of the end.  Rows that come later leave as rows of the kind
``late``.  With ``purge`` a window fires in each batch that brings rows for it, with these rows alone, and its pane is
emptied.

State is a few numbers per key and window.  The keys are dealt to ``spread`` slots, and a slot's panes of one window are
one row of state, because calls to the state store, one per key, window and batch, are too many.  The windows of a
frequent key are spread over the tasks; a window's row is cleared when nothing can be accepted any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.timing import floor_div, micros, position
from tidemark.streaming.ordered import SLOT, key_kinds, slots, text_keys, typed_keys

WINDOW, LATE = "window", "late"
_OUT = ["kind", "window_start", "window_end", "version", "fire_at", "n", "total", "row_id"]


def unmarked(df: DataFrame) -> DataFrame:
    """The frame with its watermarked columns as ordinary times: an operator would drop late rows by them."""
    for field in df.schema.fields:
        if "spark.watermarkDelayMs" in (field.metadata or {}):
            df = df.withColumn(field.name, F.timestamp_micros(F.unix_micros(field.name)))
    return df


class FiringWindows(StatefulProcessor):
    """All panes of one window in one slot of keys."""

    def __init__(self, keys: list[str], size: int, lateness: int, every: int, purge: bool) -> None:
        self.keys, self.size, self.lateness, self.every, self.purge = keys, size, lateness, every, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Of each key: rows and sum so far, last version, next mark (0: none), whether the end has fired.
        self.panes = handle.getValueState("panes", ", ".join([
            "n array<long>, total array<long>, version array<long>, mark array<long>, ended array<boolean>",
            *(f"k_{key} array<string>" for key in self.keys)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        start = key[-1]
        end = start + self.size
        if end + self.lateness <= mark:
            for frame in rows:
                if len(frame):
                    yield self._frame([(*own, LATE, start, end, None, None, None, None, None if row is None else int(row))
                                       for own, row in zip(self._owners(frame), frame["w_row"].tolist())])
            return
        fresh: dict[tuple, list] = {}
        for frame in rows:
            for own, measure, pos in zip(self._owners(frame), frame["w_measure"].tolist(), frame["w_pos"].tolist()):
                found = fresh.setdefault(own, [0, 0, pos])
                found[0] += 1
                found[1] += measure
                found[2] = min(found[2], pos)
        if not fresh:
            return
        panes = self._read()
        out, wakes = [], []
        for own, (n, total, first) in fresh.items():
            known = own in panes
            held, summed, version, tick, ended = panes.get(own, (0, 0, 0, 0, False))
            held, summed = held + n, summed + total
            if self.purge or end <= mark:
                version += 1
                out.append((*own, WINDOW, start, end, version, None if self.purge else end, held, summed, None))
                if self.purge:
                    held = summed = 0
                ended = ended or end <= mark
            if not known:
                if self.every and not ended:
                    tick = first // self.every * self.every + self.every
                wakes.append(self._next(tick, end, ended, mark))
            panes[own] = held, summed, version, tick, ended
        if wakes:
            self._wake(min(wakes))
        self._write(panes)
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        panes = self._read()
        if not panes:
            return
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        start = key[-1]
        end = start + self.size
        out, wakes = [], []
        for own, (held, summed, version, tick, ended) in panes.items():
            while self.every and not ended and tick < end and tick <= mark:
                version += 1
                out.append((*own, WINDOW, start, end, version, tick, held, summed, None))
                tick += self.every
            if not ended and end <= mark:
                if not self.purge:
                    version += 1
                    out.append((*own, WINDOW, start, end, version, end, held, summed, None))
                ended = True
            panes[own] = held, summed, version, tick, ended
            wakes.append(self._next(tick, end, ended, mark))
        if end + self.lateness <= mark:
            self.panes.clear()
        else:
            self._write(panes)
            self._wake(min(wakes))
        if out:
            yield self._frame(out)

    def _owners(self, frame: pd.DataFrame) -> Iterator[tuple]:
        return zip(*(frame[key].tolist() for key in self.keys)) if self.keys else repeat((), len(frame))

    def _read(self) -> dict[tuple, tuple]:
        return {tuple(row[5:]): tuple(row[:5]) for row in zip(*self.panes.get())} if self.panes.exists() else {}

    def _write(self, panes: dict[tuple, tuple]) -> None:
        self.panes.update(tuple(list(column) for column in zip(*((*pane, *own) for own, pane in panes.items()))))

    def _next(self, tick: int, end: int, ended: bool, mark: int) -> int:
        if ended:
            return end + self.lateness
        return min(tick, end) if self.every and tick else end

    def _wake(self, pos: int) -> None:
        # A timer goes off once the watermark is beyond it; the window is over once the watermark reaches its end.
        self.handle.registerTimer(int(-(-pos // 1000)) - 1)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[*self.keys, *_OUT], dtype=object)

    def close(self) -> None:
        pass


def firing_windows(
    df: DataFrame, ts: str, size: str, keys: list[str], measure: str, row_id: str,
    lateness: str | int = 0, every: str | None = None, purge: bool = False, spread: int = 64,
) -> DataFrame:
    """Log of all firings of the tumbling windows of a watermarked stream.

    ``kind`` is ``window`` (``version`` from 1 on, ``fire_at`` the mark or window end it belongs to, rows ``n`` and sum
    ``total`` of ``measure`` so far) or ``late`` (``row_id`` of a row that no window takes).  Times are microseconds.
    Rows without a time are ignored, a null measure adds nothing to the sum.
    """
    rows = unmarked(df.withColumn("w_pos", position(ts)).filter(F.col("w_pos").isNotNull()))
    width = micros(size)
    rows = rows.select(*keys, "w_pos", F.coalesce(F.col(measure), F.lit(0)).cast("long").alias("w_measure"),
                       F.col(row_id).cast("long").cast("string").alias("w_row"), (floor_div("w_pos", width) * width).alias("w_start"))
    schema = ", ".join([*(f"{k} string" for k in keys), "kind string", *(f"{c} long" for c in _OUT[1:])])
    fired = text_keys(rows, keys).withColumn(SLOT, slots(keys, spread)).groupBy(SLOT, "w_start").transformWithStateInPandas(
        FiringWindows(keys, width, micros(lateness), micros(every) if every else 0, purge), schema, "append", "EventTime")
    return typed_keys(fired, key_kinds(rows, keys))
