"""Detection operators against step-by-step models of what they promise."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import automaton, detection, patterns

ORDER = ["pos", "id"]


def sequence(seed, kinds, n=300, span=3000):
    rng = random.Random(seed)
    places = sorted(rng.sample(range(1, span), n))
    return [(0 if rng.random() < 0.4 else rng.randrange(1, 6), p, i, rng.choice(kinds)) for i, p in enumerate(places)]


def groups(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("chunk", [3, 10, 5000])
def test_state_machine_with_one_hot_source(spark, chunk):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.9 else 1, p, p, rng.choice(automaton.EVENTS)) for p in range(400)]
    df = spark.createDataFrame(rows, "src long, pos long, id long, ev string")
    got = {(r["src"], r["id"], r["state"]) for r in automaton.alerts(df, ["src"], ORDER, "ev", chunk=chunk).collect()}
    want = set()
    for src, seen in groups(rows).items():
        state = "Initial"
        for _, _, id_, ev in seen:
            to = automaton.TRANSITIONS.get((state, ev))
            if to is None:
                want.add((src, id_, state))
            else:
                state = "Initial" if to == automaton.TERMINAL else to
    assert got == want


@pytest.mark.parametrize("width", [None, 37])
def test_fail_timer(spark, width):
    rows, wait = sequence(3, ["fail", "fail", "ok", "other"]), 60
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    out = detection.fails_at_timer(df, ["k"], "pos", F.col("kind") == "fail", F.col("kind") == "ok",
                                   wait, width or None)
    got = {(r["id"], r["fails"]) for r in out.collect()}
    want = set()
    for seen in groups(rows).values():
        waiting, timers = [], []
        for _, pos, id_, kind in [*seen, (0, 10**9, None, "end")]:
            while timers and timers[0][0] < pos:
                _, owner = timers.pop(0)
                if len(waiting) >= 2:
                    want.add((owner, len(waiting)))
                waiting = []
            if kind == "fail":
                waiting.append(id_)
                timers.append((pos + wait, id_))
            elif kind == "ok":
                waiting = []
    assert got == want


@pytest.mark.parametrize("width", [None, 41])
def test_rising_trend(spark, width):
    rng, hold = random.Random(8), 45
    rows = [(k, p, i, rng.choice([0, 1, 2, 3, 4, 5])) for k, p, i, _ in sequence(8, ["x"])]
    df = spark.createDataFrame(rows, "k long, pos long, id long, v long")
    out = detection.rising_trends(df, ["k"], ORDER, "v", hold, width)
    got = {(r["k"], r["pos"]) for r in out.collect()}
    want, end = set(), max(r[1] for r in rows)
    for key, seen in groups(rows).items():
        last = started = None
        for _, pos, _, v in [*seen, (key, end + 1, None, None)]:
            if started is not None and started + hold < pos:
                want.add((key, started))
                started = None
            if v is None:
                break
            if last is None or last == 0 or last > v:
                started = None
            elif last < v and started is None:
                started = pos
            last = v
    assert got == want


@pytest.mark.parametrize("width", [None, 53])
def test_delta_trigger(spark, width):
    rng, threshold, last = random.Random(4), 30, 100
    total, rows = {}, []
    for k, p, i, _ in sequence(4, ["x"]):
        step = rng.choice([0, 1, 5, 20, 45])
        total[k] = total.get(k, 0) + step
        rows.append((k, p, i, step, total[k]))
    df = spark.createDataFrame(rows, "k long, pos long, id long, speed long, dist long")
    out = detection.delta_trigger(df, ["k"], ORDER, "dist", threshold, "speed", last, width)
    got = {(r["id"], r["best_id"]) for r in out.collect()}
    want = set()
    for seen in groups(rows).values():
        base = seen[0][4]
        for row in seen[1:]:
            if row[4] - base > threshold:
                base = row[4]
                near = [r for r in seen if row[1] - last < r[1] <= row[1]]
                best = max(near, key=lambda r: (r[3], -r[1], -r[2]))
                want.add((row[2], best[2]))
    assert got == want


def test_offline_alerts(spark):
    rows = [(1, 0, 1, "off"), (1, 12, 2, "off"), (1, 30, 3, "on"), (2, 5, 4, "off"), (3, 1, 5, "on")]
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    out = detection.offline_alerts(df, ["k"], ORDER, F.col("kind") == "off", 5, 7)
    got = sorted((r["id"], r["alert_no"]) for r in out.collect())
    # Alerts at 5 and 10 until the message at 12; at 17, 22, 27 until 30; key 2 until the end at 30.
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (4, 1), (4, 2), (4, 3), (4, 4), (4, 5)]


def test_order_outcomes(spark):
    rows = [(1, 0, "create"), (1, 9, "pay"), (2, 0, "create"), (2, 10, "pay"), (3, 0, "create"),
            (4, 5, "pay"), (5, 7, "create"), (5, 3, "pay"), (6, 1, "other")]
    df = spark.createDataFrame(rows, "k long, pos long, kind string")
    out = detection.order_outcomes(df, ["k"], "pos", F.col("kind") == "create", F.col("kind") == "pay", 10)
    assert {r["k"]: r["outcome"] for r in out.collect()} == {
        1: detection.PAID, 2: detection.PAID_LATE, 3: detection.UNPAID, 4: detection.NO_CREATE, 5: detection.PAID}


def test_blacklist_passes_warns_and_drops(spark):
    rows = [(1, i, f"2024-01-0{d} 10:00:0{i}") for d in (1, 2) for i in range(4)]
    df = spark.createDataFrame(rows, "k long, id long, at string").withColumn("ts", F.to_timestamp("at"))
    out = detection.blacklist(df, "ts", ["k"], ["ts"], 2)
    got = sorted((str(r["day"].date()), r["id"], r["verdict"]) for r in out.collect())
    assert got == [(d, i, v) for d in ("2024-01-01", "2024-01-02") for i, v in ((0, "pass"), (1, "pass"), (2, "warn"))]


def brute_times(seen, first, second, a, b, within):
    """All matches of a x(min..max) then at once b x(min..max), walking every start."""
    found = set()
    for i, row in enumerate(seen):
        if row[3] != first:
            continue
        taken, at = [row], i
        while True:
            if len(taken) >= a[0] and at + 1 < len(seen) and seen[at + 1][3] == second:
                bs, j = [], at + 1
                while j < len(seen) and len(bs) < b[1]:
                    if seen[j][3] == second:
                        bs.append(seen[j])
                        if len(bs) >= b[0] and bs[-1][1] - taken[0][1] < within:
                            found.add((tuple(r[2] for r in taken), tuple(r[2] for r in bs)))
                    j += 1
            nxt = next((j for j in range(at + 1, len(seen)) if seen[j][3] == first), None)
            if len(taken) == a[1] or nxt is None:
                break
            taken, at = [*taken, seen[nxt]], nxt
    return found


@pytest.mark.parametrize("width", [None, 400])
def test_times_pattern(spark, width):
    rows = sequence(11, ["a", "a", "b", "x"])
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    out = patterns.times_then_times(
        df, ["k"], ORDER, "id", F.col("kind") == "a", (2, 3), F.col("kind") == "b", (1, 2), 300, width)
    got = {(tuple(map(int, r["first_ids"].split(","))), tuple(map(int, r["second_ids"].split(",")))) for r in out.collect()}
    want = set()
    for seen in groups(rows).values():
        want |= brute_times(seen, "a", "b", (2, 3), (1, 2), 300)
    assert got == want and want


def test_followed_by_takes_first_and_any_takes_all(spark):
    rows = [(1, 1, 1, "a"), (1, 2, 2, "c"), (1, 3, 3, "b"), (1, 4, 4, "b")]
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    first = patterns.followed_by(df, ["k"], ORDER, F.col("kind") == "a", F.col("kind") == "b", 10, ["id"], 2)
    assert [(r["id"], r["next_id"]) for r in first.collect()] == [(1, 3)]
    timed = df.withColumn("t", F.timestamp_micros("pos"))
    left = timed.filter("kind = 'a'").select("k", F.col("id").alias("a_id"), F.col("t").alias("at"))
    right = timed.filter("kind = 'b'").select("k", F.col("id").alias("b_id"), F.col("t").alias("bt"))
    every = patterns.followed_by_any(left, right, ["k"], "at", "bt", 10)
    assert sorted(r["b_id"] for r in every.collect()) == [3, 4]


def test_next_is_strict_about_order_and_deadline(spark):
    rows = [(1, 0, 1, "create"), (1, 5, 2, "pay"), (2, 0, 3, "create"), (2, 10, 4, "pay"),
            (3, 0, 5, "create"), (3, 1, 6, "look"), (3, 2, 7, "pay"), (4, 0, 8, "create")]
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    out = patterns.next_within(df, ["k"], ORDER, F.col("kind") == "create", F.col("kind") == "pay", 10, ["id"], 3)
    assert {r["id"]: r["status"] for r in out.collect()} == {
        1: "matched", 3: "timeout", 5: "broken", 8: "timeout"}


def test_login_golden_sequence(spark):
    rows = [(1, t, t, "fail") for t in (1, 2, 3)] + [(1, 4, 4, "success")]
    df = spark.createDataFrame(rows, "k long, pos long, id long, kind string")
    out = patterns.next_within(df, ["k"], ORDER, F.col("kind") == "fail", F.col("kind") == "success", 10, ["id"])
    assert [(r["id"], r["next_id"]) for r in out.filter("status = 'matched'").collect()] == [(3, 4)]
