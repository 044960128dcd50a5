"""Keys that share a slot's state: results per key as before, calls to the state store that do not grow with the keys."""

from collections import defaultdict
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.streaming.firing import FiringWindows
from tidemark.streaming.ordered import OrderedProcessor
from tidemark.streaming.rules import Changelog, Offline

SECOND = 1_000_000


class Counted(dict):
    """A state variable in memory that counts all calls."""

    calls = 0

    def _count(self):
        Counted.calls += 1

    def getValue(self, key):
        self._count()
        return self[key]

    def updateValue(self, key, value):
        self._count()
        self[key] = value

    def removeKey(self, key):
        self._count()
        del self[key]

    def get(self):
        self._count()
        return self["value"]

    def update(self, value):
        self._count()
        self["value"] = value

    def exists(self):
        self._count()
        return "value" in self

    def clear(self):
        self._count()
        del self["value"]


def started(processor):
    stores = defaultdict(Counted)
    wakes = []
    processor.init(SimpleNamespace(getMapState=lambda name, *_: stores[name], getValueState=lambda name, *_: stores[name],
                                   registerTimer=wakes.append))
    Counted.calls = 0
    return stores, wakes


def mark(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


@pytest.mark.parametrize("keys", [1, 300])
def test_ordered_calls_do_not_grow_with_keys(keys):
    processor = OrderedProcessor(Changelog(), ["user_id"], bucket=10 * SECOND, slotted=True)
    started(processor)
    users = [None if k == 0 else str(k) for k in range(keys)]
    rows = [(k * SECOND, str(k), "a", u) for k in (3, 1, 2, 12) for u in users]
    list(processor.handleInputRows((5,), [pd.DataFrame(rows, columns=["pos", "event_id", "event_type", "user_id"])], mark(0)))
    out = pd.concat(processor.handleExpiredTimer((5,), mark(14_000), None))
    assert Counted.calls <= 16
    for u in users:
        own = out[out.user_id.isna() if u is None else out.user_id == u]
        assert own[own.op == "+"][["event_id", "cnt"]].values.tolist() == [[1, 1], [2, 2], [3, 3], [12, 4]]


def test_ordered_timers_of_a_slot_and_idle_keys():
    processor = OrderedProcessor(Offline("error", 5 * SECOND), ["user_id"], bucket=10 * SECOND, slotted=True)
    _, wakes = started(processor)
    rows = [(SECOND, "1", "error", "a"), (2 * SECOND, "2", "error", "b"), (3 * SECOND, "3", "view", "b"), (20 * SECOND, "4", "view", "a")]
    list(processor.handleInputRows((0,), [pd.DataFrame(rows, columns=["pos", "event_id", "event_type", "user_id"])], mark(0)))
    out = pd.concat(processor.handleExpiredTimer((0,), mark(12_000), None))
    assert out.values.tolist() == [["a", 1, 1, 6 * SECOND], ["a", 1, 2, 11 * SECOND]]
    assert wakes[-1] == 16_001
    out = pd.concat(processor.handleExpiredTimer((0,), mark(30_000), None))
    assert out.values.tolist() == [["a", 1, 3, 16 * SECOND]]

    processor = OrderedProcessor(Changelog(), ["user_id"], idle=10 * SECOND, slotted=True)
    stores, _ = started(processor)
    rows = [(SECOND, "1", "x", "a"), (15 * SECOND, "2", "x", "b")]
    list(processor.handleInputRows((0,), [pd.DataFrame(rows, columns=["pos", "event_id", "event_type", "user_id"])], mark(0)))
    list(processor.handleExpiredTimer((0,), mark(20_000), None))
    assert stores["memo"]["value"][-1] == ["b"]
    list(processor.handleExpiredTimer((0,), mark(26_000), None))
    assert "value" not in stores["memo"]


@pytest.mark.parametrize("keys", [1, 300])
def test_firing_calls_do_not_grow_with_keys(keys):
    processor = FiringWindows(["user_id"], 10 * SECOND, 5 * SECOND, 0, False)
    stores, wakes = started(processor)
    users = [None if k == 0 else str(k) for k in range(keys)]
    frame = pd.DataFrame([(u, SECOND, 2, "1") for u in users for _ in range(2)], columns=["user_id", "w_pos", "w_measure", "w_row"])
    assert not list(processor.handleInputRows((0, 0), [frame], mark(0)))
    assert wakes == [9_999]
    fired = pd.concat(processor.handleExpiredTimer((0, 0), mark(10_000), None))
    again = pd.concat(processor.handleInputRows((0, 0), [frame], mark(12_000)))
    for out, version, n in ((fired, 1, 4), (again, 2, 8)):
        assert out[["user_id", "version", "n", "total"]].values.tolist() == [[u, version, n // 2, n] for u in users]
    assert not list(processor.handleExpiredTimer((0, 0), mark(15_000), None)) and "value" not in stores["panes"]
    assert Counted.calls <= 14
    late = pd.concat(processor.handleInputRows((0, 0), [frame], mark(15_000)))
    assert len(late) == 2 * keys and set(late.kind) == {"late"} and set(late.row_id) == {1}


def test_only_frequent_keys_are_dealt_to_parts(spark):
    from tidemark.functions.user import latest, latest_merged

    rows = [(k, t, s) for k, n in ((1, 40), (2, 3), (None, 40), (3, 1)) for t, s in ((i % 20, i) for i in range(n))]
    df = spark.createDataFrame(rows + [(2, None, 5), (2, 9, None)], "k long, t long, status long").withColumn(
        "at", F.timestamp_seconds("t"))
    want = df.filter("at IS NOT NULL AND status IS NOT NULL").groupBy("k").agg(
        latest(F.col("at"), F.col("status")).alias("latest_status"))
    got = latest_merged(df, ["k"], "at", "status", 3, part_rows=10)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
