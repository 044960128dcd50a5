"""Streams of several deliveries: repeated firings, late rows, changing rules, forgotten state."""

import random
from collections import defaultdict
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.streaming import expiring
from tidemark.streaming.changing import apply_changing_rules, filter_by_newest_keyword
from tidemark.streaming.expiring import expiring_uv
from tidemark.streaming.firing import firing_windows
from tidemark.streaming.ordered import OrderedProcessor, apply_rule
from tidemark.streaming.replay import Replay
from tidemark.streaming.rules import Changelog

SECOND = 1_000_000
BASE = 1_704_067_200 * SECOND
DDL = "user_id long, event_id long, event_type string, value long, pos long, step int"


def make_rows(seed, n, steps, spread):
    """Rows a second apart, delivered in the step of their time or some steps later."""
    rng = random.Random(seed)
    return [(0 if rng.random() < .5 else rng.randrange(1, 4), k, rng.choice("ab"), rng.choice([None, 1, 5]), BASE + k * SECOND,
             min(k * steps // n + rng.choice([0, 0, 0, *range(spread)]), steps - 1)) for k in range(n)]


def replay(spark, rows, steps, name, **kwargs):
    df = spark.createDataFrame(rows, DDL).withColumn("ts", F.timestamp_micros("pos"))
    return Replay(spark, name, steps, {"rows": df}, **kwargs)


def timed(r, delay="2 seconds"):
    return r.stream("rows").withWatermark("ts", delay)


def plain_firings(rows, steps, size, lateness, every, purge):
    """The same log, row by row: timers after each delivery, late rows and repeated firings within it."""
    out, mark, top = [], 0, 0
    panes = {}
    for step in range(steps):
        fresh = defaultdict(list)
        for user, event, _, value, pos, at in rows:
            if at == step:
                fresh[user, pos // size * size].append((pos, value or 0, event))
        for (user, start), own in fresh.items():
            end = start + size
            if end + lateness <= mark:
                out += [("late", user, start, None, None, None, event) for _, _, event in own]
                continue
            new = (user, start) not in panes
            p = panes.setdefault((user, start), {"n": 0, "t": 0, "v": 0, "tick": None, "ended": end <= mark})
            p["n"] += len(own)
            p["t"] += sum(v for _, v, _ in own)
            if new and every and not p["ended"]:
                p["tick"] = min(own)[0] // every * every + every
            if purge or end <= mark:
                p["v"] += 1
                out.append(("window", user, start, p["v"], p["n"], p["t"], None))
                if purge:
                    p["n"] = p["t"] = 0
        top = max([top] + [r[4] for r in rows if r[5] == step])
        mark = max(mark, top - 2 * SECOND)
        for (user, start), p in panes.items():
            end = start + size
            while every and not p["ended"] and p["tick"] < end and p["tick"] <= mark:
                p["v"] += 1
                out.append(("window", user, start, p["v"], p["n"], p["t"], None))
                p["tick"] += every
            if not p["ended"] and end <= mark:
                p["ended"] = True
                if not purge:
                    p["v"] += 1
                    out.append(("window", user, start, p["v"], p["n"], p["t"], None))
    return sorted(out, key=str)


@pytest.mark.parametrize("lateness,every,purge", [(0, 0, False), (25, 4, False), (12, 0, True)])
def test_firings_equal_a_plain_log(spark, lateness, every, purge):
    rows = make_rows(lateness, 90, 4, 3)
    r = replay(spark, rows, 4, "t-fire")
    got = r.to_table(firing_windows(timed(r), "ts", "10 seconds", ["user_id"], "value", "event_id", lateness * SECOND,
                                    every=every * SECOND or None, purge=purge))
    found = sorted(((x.kind, x.user_id, x.window_start, x.version, x.n, x.total, x.row_id) for x in got.collect()), key=str)
    assert found == plain_firings(rows, 4, 10 * SECOND, lateness * SECOND, every * SECOND, purge)
    assert len({x[-1] for x in found if x[0] == "late"}) == sum(x[0] == "late" for x in found)


def test_rules_change_over_three_deliveries(spark):
    at = lambda k: BASE + k * SECOND
    rules = [(1, "old", at(10), 0), (1, "new", at(50), 2), (2, "only", at(45), 1), (9, "z", at(200), 2)]
    rows = [(1, 100, "own", at(5), 0), (1, 101, "own", at(10), 0), (1, 102, "own", at(49), 1), (1, 103, "own", at(50), 1),
            (1, 104, "own", at(70), 2), (2, 105, "own", at(44), 1), (2, 106, None, at(46), 0), (3, 107, "own", at(60), 2),
            (1, 108, "own", at(190), 2)]
    stamp = F.timestamp_micros("pos").alias("ts")
    r = Replay(spark, "t-rules", 3, {
        "rows": spark.createDataFrame(rows, "code long, event_id long, text string, pos long, step int").select(
            stamp, "code", "event_id", "text", "step"),
        "rules": spark.createDataFrame(rules, "code long, text string, pos long, step int").select(stamp, "code", "text", "step")})
    side = lambda t: r.stream(t).withWatermark("ts", "1 second")
    got = r.to_table(apply_changing_rules(side("rows"), side("rules"), "ts", "code", "event_id", "text", spread=3))
    assert sorted((x.row_id, x.text, x.ruled) for x in got.collect()) == [
        (100, "own", False), (101, "old", True), (102, "old", True), (103, "new", True), (104, "new", True),
        (105, "own", False), (106, "only", True), (107, "own", False)]


def test_newest_keyword(spark):
    at = lambda k: BASE + k * SECOND
    words = [(0, "spark", at(20), 1), (0, "zz", at(300), 2)]
    rows = [(0, 1, "java and spark", at(5), 0), (0, 2, "spark", at(6), 0), (0, 3, "java", at(30), 0), (0, 4, "a spark", at(30), 1),
            (0, 5, None, at(31), 1), (0, 6, "late end", at(290), 2)]
    stamp = F.timestamp_micros("pos").alias("ts")
    r = Replay(spark, "t-words", 3, {
        "rows": spark.createDataFrame(rows, "code long, event_id long, text string, pos long, step int").select(
            stamp, "event_id", "text", "step"),
        "rules": spark.createDataFrame(words, "code long, text string, pos long, step int").select(stamp, "text", "step")})
    side = lambda t: r.stream(t).withWatermark("ts", "1 second")
    got = r.to_table(filter_by_newest_keyword(side("rows"), side("rules"), "ts", "event_id", "text", "java", spread=2))
    assert sorted(tuple(x) for x in got.collect()) == [(1, "java"), (4, "spark")]


@pytest.mark.parametrize("ttl,left,counted", [(86_400_000, {"1", "2", "3"}, 3), (1, {"3"}, 4)])
def test_state_past_its_time_is_gone(spark, ttl, left, counted):
    rows = [(1, 1, "a", 1, BASE, 0), (2, 2, "a", 1, BASE, 0), (1, 3, "a", 1, BASE, 1), (3, 4, "a", 1, BASE, 2), (None, 5, "a", 1, BASE, 2)]
    r = replay(spark, rows, 3, "t-ttl", idle_batches=False)
    got = r.to_batches(expiring_uv(r.stream("rows"), ["event_type"], "user_id", ttl, spread=1), lambda b, _: b, "update")
    assert got.agg(F.sum("fresh")).first()[0] == counted
    state = spark.read.format("statestore").option("stateVarName", "users").load(r.checkpoint)
    assert {x.user for x in state.select("user_map_key.user").collect()} == left


class Entries:
    """A map state with a time to live, in memory, that counts its calls."""

    def __init__(self, ttl):
        self.ttl, self.now, self.calls, self.held = ttl, 0, 0, {}

    def live(self):
        self.calls += 1
        self.held = {k: v for k, v in self.held.items() if v[1] + self.ttl > self.now}
        return self.held

    def keys(self):
        return iter(list(self.live()))

    def containsKey(self, key):
        return key in self.live()

    def getValue(self, key):
        return self.live()[key][0]

    def updateValue(self, key, value):
        self.live()[key] = value, self.now

    def removeKey(self, key):
        del self.live()[key]


def test_expiring_users_share_entries(monkeypatch):
    """Each user is forgotten ``ttl`` after its own last sighting, with fewer calls to the state than users."""
    monkeypatch.setattr(expiring, "HELD", 1000)
    counter = expiring.ExpiringDistinct(["event_type"], 10)
    users = Entries(10)
    counter.users, counter.count = users, SimpleNamespace(exists=lambda: False, update=lambda value: None)
    last = {}
    for now, first, stop in ((100, 0, 5000), (105, 2500, 7500), (110, 0, 2600), (119, 7000, 7600), (129, 0, 100), (130, 7599, 7601)):
        users.now, users.calls = now, 0
        expected = sum(now >= last.get(u, -100) + 10 for u in range(first, stop))
        last.update(dict.fromkeys(range(first, stop), now))
        names = [str(u) for u in range(first, stop)]
        frames = [pd.DataFrame({"w_user": names[k:k + 700] + [None, names[0]]}) for k in range(0, len(names), 700)]
        clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda now=now: now)
        out = list(counter.handleInputRows(("a", 0), iter(frames), clock))
        assert [frame["fresh"].tolist() for frame in out] == [[expected]]
        assert users.calls <= 1 + 3 * expiring.BUCKETS * (1 + len(names) // 1000)
        kept = [u for value, _ in users.live().values() for u in value[0]]
        assert len(kept) == len(set(kept)) and {u for u in last if now < last[u] + 10} <= {int(u) for u in kept}
        assert len({expiring._bucket(name) for (name,) in users.held}) == len(users.held)


def test_many_expiring_users(spark):
    rows = [(u, 10 * s + u, "a", 1, BASE, s) for s, users in enumerate([range(900), range(600, 1200)]) for u in users]
    r = replay(spark, rows, 2, "t-many", idle_batches=False)
    got = r.to_batches(expiring_uv(r.stream("rows"), ["event_type"], "user_id", 86_400_000, spread=2), lambda b, _: b, "update")
    assert got.groupBy("batch").agg(F.sum("fresh")).orderBy("batch").collect() == [(0, 900), (1, 300)]
    state = spark.read.format("statestore").option("stateVarName", "users").load(r.checkpoint).select(
        F.explode("user_map_value.value.users").alias("user"))
    assert (state.count(), state.distinct().count()) == (1200, 1200)


def test_idle_keys_are_forgotten(spark):
    rows = [(k, n, "a", 1, BASE + at * SECOND, step) for n, (k, at, step) in enumerate(
        [(1, 0, 0), (1, 5, 0), (1, 16, 0), (2, 3, 0), (1, 25, 1), (2, 30, 1), (3, 500, 2)])]
    r = replay(spark, rows, 3, "t-idle")
    got = r.to_table(apply_rule(timed(r), ["user_id"], Changelog(), idle="10 seconds", bucket="4 seconds")).filter("op = '+'")
    assert sorted((x.user_id, x.event_id, x.cnt) for x in got.collect()) == [
        (1, 0, 1), (1, 1, 2), (1, 2, 1), (1, 4, 2), (2, 3, 1), (2, 5, 1)]
    memo = spark.read.format("statestore").option("stateVarName", "memo").load(r.checkpoint)
    assert memo.count() == 0


def test_nulls_stand_apart_and_large_numbers_stay_exact(spark):
    big = 2 ** 53 + 1
    rows = [(None, big, "a", None, BASE, 0), (None, None, "a", 2, BASE + SECOND, 0), (big, big + 2, "a", 3, BASE + SECOND, 0),
            (big + 1, 7, "a", None, BASE + SECOND, 1), (5, 8, "a", 1, BASE + 900 * SECOND, 1), (5, 9, "a", 1, None, 1)]
    r = replay(spark, rows, 2, "t-nulls")
    got = r.to_table(apply_rule(timed(r), ["user_id"], Changelog())).filter("op = '+'")
    assert sorted(((x.user_id, x.event_id, x.cnt) for x in got.collect()), key=str) == sorted(
        [(None, big, 1), (None, None, 2), (big, big + 2, 1), (big + 1, 7, 1)], key=str)
    r = replay(spark, rows, 2, "t-null-windows")
    got = r.to_table(firing_windows(timed(r), "ts", "10 seconds", ["user_id"], "value", "event_id"))
    assert sorted(((x.user_id, x.n, x.total) for x in got.collect()), key=str) == sorted(
        [(None, 2, 2), (big, 1, 3), (big + 1, 1, 0)], key=str)


class Store(dict):
    """A state variable in memory that counts its reads."""

    reads = 0

    def getValue(self, key):
        self.reads += 1
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def get(self):
        return self["value"]

    def update(self, value):
        self["value"] = value

    def exists(self):
        return "value" in self


@pytest.mark.parametrize("backlog", [0, 50, 500])
def test_a_timer_reads_due_buckets_only(backlog):
    stores = defaultdict(Store)
    handle = SimpleNamespace(getMapState=lambda name, *_: stores[name], getValueState=lambda name, *_: stores[name],
                             registerTimer=lambda at: None)
    processor = OrderedProcessor(Changelog(), ["user_id"], bucket=10 * SECOND)
    processor.init(handle)
    mark = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    events = [(k * SECOND, k, "a") for k in (3, 1, 2, 12)] + [((100 + 10 * k) * SECOND, 100 + k, "a") for k in range(backlog)]
    random.Random(1).shuffle(events)
    list(processor.handleInputRows((7,), [pd.DataFrame(events, columns=["pos", "event_id", "event_type"])], mark(0)))
    stores["pending"].reads = 0
    out = pd.concat(processor.handleExpiredTimer((7,), mark(14_000), None))
    assert out[out.op == "+"][["event_id", "cnt"]].values.tolist() == [[1, 1], [2, 2], [3, 3], [12, 4]]
    assert stores["pending"].reads == 2 and len(stores["pending"]) == backlog
