"""Keyed state with event-time timers, events delivered in time order.

A micro-batch brings a key's rows in no particular order.  ``OrderedProcessor``
holds them until the watermark has passed, then hands them to a ``Rule`` one by
one, letting the rule's timer go off between events where it is due.  A rule is
a few lines of plain logic over a small memo per key.

Calls from Python to the state store are dear, one per key and batch too many
for millions of keys.  So ``apply_rule`` deals the keys to ``spread`` slots, and
a slot's keys share their state: waiting rows by time bucket, one map entry of
column arrays each, and one row of memos.  A new row rewrites its slot's bucket,
and a timer reads the buckets that are due and the slot's memos, so the work of
a batch follows the rows it brings and releases and not those that wait.  What
is known of all buckets is their number and first position.

State need not stay for ever: with ``idle``, a rule's memo is cleared where a key
has no event for more than that, counted in event time, and no timer waits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.timing import micros

BUCKET = 86_400_000_000  # microseconds of one bucket of a slot's waiting rows
SPREAD = 256  # slots of keys
SLOT = "w_slot"
WHOLE = ("long", "bigint", "int", "integer")

class Rule:
    """What to do with the events of one key.

    ``fields`` names the input columns the rule reads; the first one is the
    BIGINT position, the second breaks ties.
    """

    fields: tuple[tuple[str, str], ...] = ()
    memo: tuple[tuple[str, str], ...] = ()
    output: tuple[tuple[str, str], ...] = ()

    def start(self) -> dict:
        return {name: None for name, _ in self.memo}

    def on_event(self, memo: dict, row: dict) -> Iterable[tuple]:
        raise NotImplementedError

    def due(self, memo: dict) -> int | None:
        """Position of the next timer; an event at the same position goes first."""
        return None

    def on_timer(self, memo: dict, at: int) -> Iterable[tuple]:
        return ()


def ddl(fields: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


class OrderedProcessor(StatefulProcessor):
    """The state of one key or, ``slotted``, of all keys of a slot, whose columns ``keys`` are then among the rows'."""

    def __init__(self, rule: Rule, keys: list[str], idle: int | None = None, bucket: int = BUCKET, slotted: bool = False):
        self.rule, self.idle, self.bucket, self.slotted = rule, idle, bucket, slotted
        self.names = [name for name, _ in rule.fields]
        self.whole = {name for name, kind in rule.fields if kind in WHOLE}
        self.within = keys if slotted else []
        self.columns = keys + [name for name, _ in rule.output]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        keys = [(f"k_{name}", "string") for name in self.within]
        arrays = lambda fields: ddl((name, f"array<{kind}>") for name, kind in fields)
        self.pending = handle.getMapState("pending", "bucket long", arrays([*self.rule.fields, *keys]))
        self.index = handle.getValueState("index", "buckets array<long>, firsts array<long>")
        # Of every key its memo and the position of its last event.
        self.memo = handle.getValueState("memo", arrays([*self.rule.memo, ("w_last", "long"), *keys]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        names = [*self.names, *self.within]
        fresh: list[list] = [[] for _ in names]
        for frame in rows:
            for held, name in zip(fresh, names):
                held.extend(self._values(name, frame[name]))
        buckets = defaultdict(list)
        for k, pos in enumerate(fresh[0]):
            # A row behind the watermark is late: its turn has passed.
            if pos >= mark * 1000:
                buckets[pos // self.bucket].append(k)
        if not buckets:
            return iter(())
        index = self._read_index()
        firsts = []
        for bucket, part in buckets.items():
            columns = [[column[k] for k in part] for column in fresh]
            firsts.append(min(columns[0]))
            if bucket in index:
                columns = [list(old) + new for old, new in zip(self.pending.getValue((bucket,)), columns)]
            self.pending.updateValue((bucket,), tuple(columns))
            index[bucket] = min(firsts[-1], index.get(bucket, firsts[-1]))
        self._write_index(index)
        self._wake(min(firsts), mark)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        group = () if self.slotted else tuple(key)
        index = self._read_index()
        known = self._read_memos()
        width = len(self.names)
        dues = sorted(b for b, first in index.items() if first < mark)
        for bucket in dues:
            columns = self.pending.getValue((bucket,))
            at = columns[0]
            out: list[tuple] = []
            for k in sorted((k for k in range(len(at)) if at[k] < mark), key=lambda k: (at[k], columns[1][k])):
                own = tuple(column[k] for column in columns[width:])
                memo, last = known.get(own) or (self.rule.start(), None)
                pos = at[k]
                self._fire(memo, pos - 1, group + own, out)
                if self.idle is not None and last is not None and pos > last + self.idle and self.rule.due(memo) is None:
                    memo = self.rule.start()
                known[own] = memo, pos
                row = {name: column[k] for name, column in zip(self.names, columns)}
                out.extend((*group, *own, *found) for found in self.rule.on_event(memo, row))
            rest = [k for k in range(len(at)) if at[k] >= mark]
            if rest:
                self.pending.updateValue((bucket,), tuple([column[k] for k in rest] for column in columns))
                index[bucket] = min(at[k] for k in rest)
            else:
                self.pending.removeKey((bucket,))
                del index[bucket]
            if out:
                yield self._frame(out)
        out = []
        nexts = list(index.values())
        for own, (memo, last) in list(known.items()):
            self._fire(memo, mark - 1, group + own, out)
            due = self.rule.due(memo)
            if due is not None:
                nexts.append(due)
            elif self.idle is not None:
                if last + self.idle < mark:
                    del known[own]
                else:
                    nexts.append(last + self.idle)
        if dues:
            self._write_index(index)
        if known:
            self._write_memos(known)
        elif self.memo.exists():
            self.memo.clear()
        if nexts:
            self._wake(min(nexts), mark // 1000)
        if out:
            yield self._frame(out)

    def _values(self, name: str, column: pd.Series) -> list:
        # A null is a None or, beside numbers, a NaN.
        whole = name in self.whole
        return [None if v is None or v != v else int(v) if whole else v for v in column.tolist()]

    def _read_index(self) -> dict[int, int]:
        return dict(zip(*self.index.get())) if self.index.exists() else {}

    def _write_index(self, index: dict[int, int]) -> None:
        self.index.update((list(index), list(index.values())))

    def _read_memos(self) -> dict[tuple, tuple[dict, int]]:
        if not self.memo.exists():
            return {}
        names = [name for name, _ in self.rule.memo]
        rows = zip(*self.memo.get())
        return {row[len(names) + 1:]: (dict(zip(names, row)), row[len(names)]) for row in rows}

    def _write_memos(self, known: dict[tuple, tuple[dict, int]]) -> None:
        names = [name for name, _ in self.rule.memo]
        rows = [(*(memo[name] for name in names), last, *own) for own, (memo, last) in known.items()]
        self.memo.update(tuple(list(column) for column in zip(*rows)))

    def _fire(self, memo: dict, upto: int, key: tuple, out: list) -> None:
        while (at := self.rule.due(memo)) is not None and at <= upto:
            out.extend((*key, *found) for found in self.rule.on_timer(memo, at))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns, dtype=object)

    def _wake(self, pos: int, mark_ms: int) -> None:
        self.handle.registerTimer(int(max(pos // 1000, mark_ms)) + 1)

    def close(self) -> None:
        pass


def key_kinds(df: DataFrame, keys: list[str]) -> dict[str, str]:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {k: kinds[k] for k in keys}


def text_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys as text: beside a null key pandas would make floats of whole numbers, which are no keys."""
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def typed_keys(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.col(k).cast(kind) for k, kind in kinds.items()})


def slots(keys: list[str], spread: int) -> Column:
    """The slot of a row's key; keys that are equal as text share one."""
    return F.pmod(F.xxhash64(*keys), F.lit(spread)).alias(SLOT)


def apply_rule(df: DataFrame, keys: list[str], rule: Rule, idle: str | int | None = None, bucket: str | int = BUCKET,
               spread: int = SPREAD) -> DataFrame:
    """Run a rule over a watermarked stream, per key.

    With ``idle`` a key's memo is forgotten once the watermark is that far beyond its last event and no timer waits; a
    later event starts afresh.  Rows without a position are ignored; other fields may be null.  A batch that touches a slot
    reads and writes the memos of its keys, so ``spread`` should grow with the number of keys.
    """
    pos, *others = rule.fields
    df = df.filter(F.col(pos[0]).isNotNull())
    # In pandas a null turns a whole column of a batch into floats, so whole numbers travel as text.
    for name, kind in others:
        if kind in WHOLE:
            df = df.withColumn(name, F.col(name).cast("string"))
    kinds = key_kinds(df, keys)
    dealt = text_keys(df, keys).withColumn(SLOT, slots(keys, spread))
    out = dealt.groupBy(SLOT).transformWithStateInPandas(
        OrderedProcessor(rule, keys, None if idle is None else micros(idle), micros(bucket), slotted=True),
        ddl([*((k, "string") for k in keys), *rule.output]), "append", "EventTime")
    return typed_keys(out, kinds)
