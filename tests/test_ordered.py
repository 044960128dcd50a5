"""Bucketed scans against a plain pass over the sorted rows, with a hot key and bursts."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import ordered as o
from tidemark.plans.buckets import Grid, Splits, buckets_for

KEYS, ORDER = ["k"], ["pos", "id"]


def make_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 12)  # key 0 is hot
        pos = rng.randrange(500, 520) if rng.random() < 0.3 else rng.randrange(-1000, 5000)  # a burst
        rows.append((key, pos, i, rng.choice([None, *range(10)])))
    return rows


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return make_rows(request.param)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, pos long, id long, v long").cache()


WIDTHS = [1, 7, 333, 10**9, None]


@pytest.mark.parametrize("width", WIDTHS)
def test_previous_and_next(frame, rows, width):
    prev = {r["id"]: (r["prev_id"], r["prev_v"]) for r in
            o.with_previous(frame, KEYS, ORDER, ["id", "v"], width).collect()}
    nxt = {r["id"]: r["next_id"] for r in o.with_next(frame, KEYS, ORDER, ["id"], width).collect()}
    assert len(prev) == len(rows)
    for group in by_key(rows).values():
        for before, row, after in zip([None, *group], group, [*group[1:], None]):
            assert prev[row[2]] == ((before[2], before[3]) if before else (None, None))
            assert nxt[row[2]] == (after[2] if after else None)


@pytest.mark.parametrize("width", WIDTHS)
def test_running(frame, rows, width):
    out = o.running(frame, KEYS, ORDER, {
        "s": ("v", "sum"), "m": ("v", "max"), "low": ("v", "min"), "l": ("v", "last")}, width)
    got = {r["id"]: (r["s"], r["m"], r["low"], r["l"]) for r in out.collect()}
    numbers = {r["id"]: r["rn"] for r in o.row_numbers(frame, [], ORDER, width).collect()}
    for group in by_key(rows).values():
        seen = []
        for row in group:
            if row[3] is not None:
                seen.append(row[3])
            want = (sum(seen), max(seen), min(seen), seen[-1]) if seen else (None,) * 4
            assert got[row[2]] == want
    whole = sorted(rows, key=lambda r: (r[1], r[2]))
    assert [numbers[r[2]] for r in whole] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("width", WIDTHS)
def test_overlap_sees_everything_within_reach(frame, rows, width):
    seen = o.overlap(frame, KEYS, "pos", width, ahead=40, behind=25)
    scan = o.in_bucket(KEYS, "pos").rangeBetween(-25, 40)
    got = {r["id"]: r["n"] for r in o.settle(seen.withColumn("n", F.count("*").over(scan))).collect()}
    assert len(got) == len(rows)
    for key, pos, id_, _ in rows:
        assert got[id_] == sum(1 for r in rows if r[0] == key and -25 <= r[1] - pos <= 40)


@pytest.mark.parametrize("width", WIDTHS)
def test_asof(spark, frame, rows, width):
    models = make_rows(9, 60)
    right = spark.createDataFrame(models, "k long, at long, mid long, w long").drop("w")
    out = o.asof_latest(frame, right, KEYS, ORDER, "at", ["mid"], width, ["mid"])
    got = {r["id"]: r["mid"] for r in out.collect()}
    for key, pos, id_, _ in rows:
        usable = [(m[1], str(m[2]), m[2]) for m in models if m[0] == key and m[1] <= pos]
        assert got[id_] == (max(usable)[2] if usable else None)


def test_measured_buckets_bound_every_bucket(spark):
    """A third of all rows in one instant's neighbourhood does not fill one bucket."""
    rows = [(i if i % 3 else 10_000 + i // 3 % 50,) for i in range(6000)]
    df = spark.createDataFrame(rows, "pos long")
    cut = buckets_for(df, "pos")
    sizes = [r["count"] for r in cut.assign(df, "pos", "b").groupBy("b").count().collect()]
    assert isinstance(cut, Splits) and len(sizes) > 50
    assert max(sizes) <= 6 * 60  # a few times the target of 60 rows, ties included


def test_buckets_are_monotone_when_mirrored(spark):
    cut = Splits((3.0, 10.0, 11.0))
    df = spark.range(20).select(F.col("id").alias("p"), (-F.col("id")).alias("q"))
    back = cut.mirrored().assign(df, "q", "b").orderBy("q").collect()
    assert [r["b"] for r in back] == sorted(r["b"] for r in back)
    assert Grid(5).mirrored() == Grid(5)


def test_a_hot_null_key_is_cut_like_any_other(spark):
    rows = [(None if i % 3 else i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, pos long")
    got = {r["pos"]: r["prev_pos"] for r in o.with_previous(df, ["k"], ["pos"], ["pos"]).collect()}
    nulls = [p for k, p in rows if k is None]
    assert len(got) == 300
    assert all(got[p] == before for before, p in zip([None, *nulls], nulls))


def test_only_hot_keys_are_cut(spark, frame):
    cut = buckets_for(frame, "pos")
    assert [tuple(k) for k in cut.hot_keys(frame, KEYS)] == [(0,)]
    plan = o.with_previous(frame, KEYS, ORDER, ["v"])._jdf.queryExecution().toString()
    assert "_hot" in plan
    calm = frame.filter("k <> 0").limit(40)
    assert "_hot" not in o.with_previous(calm, KEYS, ORDER, ["v"])._jdf.queryExecution().toString()
