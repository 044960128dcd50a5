"""Stateful operators that do not need ordered delivery."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.timing import micros


class LateRouter(StatefulProcessor):
    """Tag each row by the watermark it meets; nothing is dropped."""

    def __init__(self, columns: list[str], pos: str, size: int, lateness: int):
        self.columns, self.pos, self.size, self.lateness = columns, pos, size, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        for frame in rows:
            last = frame[self.pos] // self.size * self.size + self.size - 1
            route = np.where(last > mark, "on_time",
                             np.where(last + self.lateness > mark, "late_accepted", "late"))
            yield frame[self.columns].assign(route=route)

    def close(self) -> None:
        pass


def route_late_stream(
    df: DataFrame, pos: str, size: str, lateness: str, spread: int = 64,
) -> DataFrame:
    """Streaming side output of late rows, as a ``route`` column.

    Routing needs no state per key, so rows are grouped by a hash of themselves:
    a hot key does not end up in one task.
    """
    # A stateful operator drops late rows when it sees the watermarked column
    # itself, so the column goes in as a plain timestamp.
    for field in df.schema.fields:
        if "spark.watermarkDelayMs" in (field.metadata or {}):
            df = df.withColumn(field.name, F.timestamp_micros(F.unix_micros(field.name)))
    columns = df.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return (
        df.withColumn("_slot", F.pmod(F.xxhash64(*columns), F.lit(spread))).groupBy("_slot")
        .transformWithStateInPandas(
            LateRouter(columns, pos, micros(size), micros(lateness)),
            f"{schema}, route string", "append", "EventTime")
    )


def fresh_visitors(df: DataFrame, ts: str, period: str, keys: list[str], user: str) -> DataFrame:
    """First sighting of each user per key and period, for running distinct counts.

    State is one entry per (period, key, user), spread by all three, so a key
    visited by everyone is no single task's state; the watermark drops a
    period's entries once it is over.
    """
    return (
        df.withColumn("window", F.window(ts, period))
        .dropDuplicates(["window", *keys, user]).select("window", *keys, user)
    )
