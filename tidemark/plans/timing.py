"""Durations and integer time positions.

Ordered operators work on a *position*, a BIGINT that grows with event time
(microseconds since the epoch for timestamps).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str | int) -> int:
    """``"10 minutes"`` as microseconds; integers pass through."""
    if isinstance(duration, int):
        return duration
    match = re.fullmatch(r"\s*(-?\d+)\s*([a-z]+?)s?\s*", duration)
    if not match or match.group(2) not in _UNITS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match.group(1)) * _UNITS[match.group(2)]


def position(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def instant(pos: str | Column) -> Column:
    return F.timestamp_micros(F.col(pos) if isinstance(pos, str) else pos)


def floor_div(pos: str | Column, width: int) -> Column:
    """Exact floor division on BIGINT (no detour over doubles)."""
    col = F.col(pos) if isinstance(pos, str) else pos
    return F.call_function("div", col - F.pmod(col, F.lit(width)), F.lit(width)).cast("long")


def window_start(ts: str | Column, size: str | int, offset: str | int = 0) -> Column:
    """Start of the tumbling window of ``size`` shifted by ``offset``."""
    pos = position(ts)
    shift = micros(offset)
    return instant(pos - F.pmod(pos - F.lit(shift), F.lit(micros(size))))


def window_end(ts: str | Column, size: str | int) -> Column:
    """End of the tumbling window of ``size``; usable next to a ``F.window`` column."""
    pos = position(ts)
    width = F.lit(micros(size))
    return instant(pos - F.pmod(pos, width) + width)


def plain(ts: str | Column) -> Column:
    """An instant as a zone-less timestamp, the form result tables use."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
