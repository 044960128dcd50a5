"""State that Spark itself forgets: values and map entries with a time to live.

A time to live counts processing time from the last write of a value or map entry; a value past it is never returned and
is removed from the state store.  (In event time, ``ordered.apply_rule`` forgets idle keys.)

Calls from Python to the state store, two per user, are too many for millions of users.  So the users of a key share
``BUCKETS`` map entries.  An entry holds when each of its users was last seen, in the batch's processing time, by which
Spark counts a time to live as well: a user past it does not count and leaves with the entry's next write, and Spark
removes an entry that has not been written for that time.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.ordered import key_kinds, text_keys, typed_keys


BUCKETS = 256   # map entries that share the users of one part of a key
HELD = 1 << 18  # most users held in memory before they are written


def _bucket(user: str) -> int:
    return zlib.crc32(user.encode()) % BUCKETS


class ExpiringDistinct(StatefulProcessor):
    """Distinct users of a key, each remembered for ``ttl`` milliseconds from its last sighting."""

    def __init__(self, keys: list[str], ttl: int) -> None:
        self.keys, self.ttl = keys, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        # An entry goes by the first of its bucket's users.
        self.users = handle.getMapState("users", "user string", "users array<string>, seen array<long>", ttlDurationMs=self.ttl)
        self.count = handle.getValueState("count", "uv long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        count = self.count.get()[0] if self.count.exists() else 0
        names = {_bucket(user): user for (user,) in self.users.keys()}
        met: set[str] = set()
        fresh = 0
        for frame in rows:
            met.update(frame["w_user"].dropna().unique().tolist())
            if len(met) >= HELD:
                fresh += self._see(met, names, now)
                met = set()
        fresh += self._see(met, names, now)
        self.count.update((count + fresh,))
        yield pd.DataFrame([(*key[:-1], count + fresh, fresh)], columns=[*self.keys, "uv", "fresh"])

    def _see(self, met: set[str], names: dict[int, str], now: int) -> int:
        """Remember the users as seen now; how many of them were not remembered."""
        dealt = defaultdict(list)
        for user in met:
            dealt[_bucket(user)].append(user)
        fresh = 0
        for bucket, users in dealt.items():
            held: dict[str, int] = {}
            name = names.get(bucket)
            if name is not None:
                held = {user: seen for user, seen in zip(*self.users.getValue((name,))) if seen + self.ttl > now}
            fresh += sum(user not in held for user in users)
            held.update(dict.fromkeys(users, now))
            names[bucket] = next(iter(held))
            if name is not None and name != names[bucket]:
                self.users.removeKey((name,))
            self.users.updateValue((names[bucket],), (list(held), list(held.values())))
        return fresh

    def close(self) -> None:
        pass


def expiring_uv(df: DataFrame, keys: list[str], user: str, ttl_ms: int, spread: int = 8) -> DataFrame:
    """Distinct users per key and batch, those forgotten after ``ttl_ms`` counted again.

    Users are dealt to ``spread`` parts of a key, so a frequent key is several tasks' state; the sum of the parts'
    ``fresh`` users over the batches is the count.  Null users do not count.  A batch reads and writes the entries its
    users are in, so ``spread`` should grow with the number of users of a key.
    """
    rows = df.select(*keys, F.col(user).cast("string").alias("w_user"), F.pmod(F.xxhash64(user), F.lit(spread)).alias("w_part"))
    schema = ", ".join([*(f"{k} string" for k in keys), "uv long", "fresh long"])
    counted = text_keys(rows, keys).groupBy(*keys, "w_part").transformWithStateInPandas(
        ExpiringDistinct(keys, ttl_ms), schema, "update", "ProcessingTime")
    return typed_keys(counted, key_kinds(df, keys))
