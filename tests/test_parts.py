"""Patterns of several counted parts against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.patterns import part_after_part

DDL = "user_id long, event_id long, kind string, pos long"


def plain(rows, parts, within):
    out = []
    for user in {r[0] for r in rows}:
        events = sorted((r for r in rows if r[0] == user), key=lambda r: (r[3], r[1]))

        def extend(i, at, ids, first):
            if i == len(parts):
                out.append((user, *[",".join(map(str, x)) for x in ids]))
                return
            kinds, least, most = parts[i]
            own = []
            for k in range(at, len(events)):
                if k == at and events[k][2] not in list(kinds):
                    return
                if events[k][2] in list(kinds):
                    own.append(k)
                    begun = events[own[0]][3] if first is None else first
                    if least <= len(own) <= most and (within is None or events[k][3] - begun < within):
                        extend(i + 1, k + 1, [*ids, [events[x][1] for x in own]], begun)
                    if len(own) == most:
                        return

        for start in range(len(events)):
            extend(0, start, [], None)
    return sorted(out, key=str)


@pytest.mark.parametrize("within", [None, 9, 40])
def test_counted_parts(spark, within):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, None]), k, rng.choice(["a", "b", "c", None]), k // 2) for k in range(150)]
    df = spark.createDataFrame(rows, DDL)
    for parts in ([("a", 2, 3), ("b", 1, 2)], [("ab", 1, 2), ("c", 2, 2), ("a", 1, 3)], [("a", 1, 1)]):
        conditions = [(F.col("kind").isin(*kinds), least, most) for kinds, least, most in parts]
        got = part_after_part(df, ["user_id"], ["pos", "event_id"], "event_id", conditions, within).drop("first_pos", "last_pos")
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows, parts, within)


def test_far_apart_and_empty(spark):
    rows = [(1, 1, "a", 0), (1, 2, "x", 10 ** 15), (1, 3, "a", 2 * 10 ** 15), (1, 4, "b", 3 * 10 ** 15)]
    parts = [(F.col("kind") == "a", 2, 2), (F.col("kind") == "b", 1, 1)]
    got = part_after_part(spark.createDataFrame(rows, DDL), ["user_id"], ["pos", "event_id"], "event_id", parts)
    assert [tuple(r) for r in got.collect()] == [(1, "1,3", "4", 0, 3 * 10 ** 15)]
    assert part_after_part(spark.createDataFrame([], DDL), ["user_id"], ["pos", "event_id"], "event_id", parts).collect() == []
