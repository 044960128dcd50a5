"""Stream-to-stream and stream-to-table joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width, buckets_for
from tidemark.plans.ordered import asof_latest, running, with_next, with_previous
from tidemark.plans.skew import broadcast_if_small, salted_join
from tidemark.plans.timing import floor_div, micros, position


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: str | int, upper: str | int, slot: str | int | None = None,
) -> DataFrame:
    """Pairs of one key with ``left_ts + lower <= right_ts <= left_ts + upper``.

    The time axis is cut into slots at least as long as the interval.  A right
    row lies in one slot and a left row's interval touches at most two, so the
    join is an equi-join on key *and* slot: a hot key is spread over its slots
    and each row only meets rows near it in time.  Works on streams when both
    times carry a watermark; the time bound lets Spark drop old state.
    """
    lo, hi = micros(lower), micros(upper)
    span = max(hi - lo, 1)
    width = span if slot is None else max(micros(slot), span)
    left_pos, right_pos = position(left_ts), position(right_ts)
    slots = F.sequence(floor_div(left_pos + F.lit(lo), width), floor_div(left_pos + F.lit(hi), width))
    probes = left.withColumn("_slot", F.explode(slots))
    builds = right.withColumn("_slot", floor_div(right_pos, width))
    bound = F.expr(
        f"{right_ts} >= {left_ts} + INTERVAL {lo} MICROSECOND"
        f" AND {right_ts} <= {left_ts} + INTERVAL {hi} MICROSECOND")
    joined = _equi(probes, builds, [*keys, "_slot"], "inner", bound)
    return joined.drop("_slot")


def _equi(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, extra: Column | None = None) -> DataFrame:
    """Equi-join on same-named columns with an extra condition; keys appear once, from the left."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = F.lit(True) if extra is None else extra
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    size: str, how: str = "inner",
) -> DataFrame:
    """Join rows of the same key and tumbling window.

    ``left`` keeps left rows whose window has no partner (the co-group form).
    """
    probes = left.withColumn("window", F.window(left_ts, size))
    builds = right.withColumn("window", F.window(right_ts, size))
    return probes.join(builds, [*keys, "window"], how)


def match_streams(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    timeout: str, ties: Sequence[tuple[str, str]] = (), width: Width = None,
) -> DataFrame:
    """Pair the records of two sources one-to-one, reporting every record that found no partner.

    Per key the records of both sides form one sequence.  A record waits for the
    next one: if that is of the other side and at most ``timeout`` later, the two
    are ``matched``, otherwise the waiting one is alone (``only_left`` or
    ``only_right``) and the next one waits.  Nothing is dropped.

    Equal times are ordered by ``ties`` (pairs of a left and a right column), then
    left before right, then by the other columns.  Null keys form one key; a
    record without a time stays alone.
    """
    keys = list(keys)
    left_cols = [c for c in left.columns if c not in keys]
    right_cols = [c for c in right.columns if c not in keys]
    tied = [f"_tie_{i}" for i in range(len(ties))]

    def tagged(df, side, ts, columns, ties, name):
        return df.select(
            *keys, position(ts).alias("_pos"), F.lit(side).alias("_side"),
            *[F.col(c).alias(out) for c, out in zip(ties, tied)], F.struct(*columns).alias(name))

    both = tagged(left, 0, left_ts, left_cols, [a for a, _ in ties], "_left").unionByName(
        tagged(right, 1, right_ts, right_cols, [b for _, b in ties], "_right"), allowMissingColumns=True)
    order = ["_pos", *tied, "_side", "_left", "_right"]
    buckets = buckets_for(both, "_pos", width)
    rows = with_previous(both, keys, order, ["_pos", "_side", "_left", "_right"], buckets, "_before")
    follows = (F.col("_side") != F.col("_before_side")) & (
        F.col("_pos") - F.col("_before_pos") <= F.lit(micros(timeout)))
    rows = rows.withColumn("_reset", ~F.coalesce(follows, F.lit(False)))
    # Sides alternate between two resets, so every record of the first one's side waits and the next answers it.
    rows = running(rows.withColumn("_opener", F.when(F.col("_reset"), F.col("_side"))), keys, order,
                   {"_first": ("_opener", "last")}, buckets)
    rows = with_next(rows, keys, order, ["_reset"], buckets, "_after")
    alone = F.when(F.col("_side") == 0, "only_left").otherwise("only_right")
    status = F.when(F.col("_side") != F.col("_first"), F.lit("matched")).when(
        F.coalesce("_after_reset", F.lit(True)), alone)
    told = rows.withColumn("status", status).filter(F.col("status").isNotNull())
    matched = F.col("status") == "matched"
    one = F.when(matched, F.coalesce("_left", "_before_left")).otherwise(F.col("_left"))
    two = F.when(matched, F.coalesce("_right", "_before_right")).otherwise(F.col("_right"))
    return told.select(*keys, "status", one.alias("_one"), two.alias("_two")).select(
        *keys, "status", *[F.col(f"_one.{c}").alias(c) for c in left_cols],
        *[F.col(f"_two.{c}").alias(c) for c in right_cols])


def lookup(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", salted: bool = False,
) -> DataFrame:
    """Enrich rows from a keyed table; ``inner`` drops misses, ``left`` keeps them with nulls.

    The physical join is left to Spark: a dimension that statistics show to be
    small is broadcast, a larger one is shuffled and skewed partitions are split
    at run time.  ``salted`` spreads hot keys by hand where adaptive execution
    is off.
    """
    if salted:
        return salted_join(fact, dim, keys, how)
    return fact.join(dim, list(keys), how)


HIT, STALE, MISS = "hit", "stale", "miss"


def lookup_fresh(
    fact: DataFrame, history: DataFrame, keys: Sequence[str], order: Sequence[str], valid_pos: str,
    values: Sequence[str], max_age: str, width: Width = None, tie: Sequence[str] = (),
) -> DataFrame:
    """Lookup in a dimension's history that takes no row older than ``max_age``.

    Each row sees the version of its key that was newest at its own time, as a cache filled at that time would.  Adds
    ``values`` (null unless found) and ``lookup``: ``hit``, ``stale`` (there is only an older version) or ``miss``.  An
    ordered scan of both sides, so neither a hot key nor a long history meets itself.  Null keys are a key.
    """
    found = asof_latest(fact, history, keys, order, valid_pos, [valid_pos, *values], width, tie)
    age = F.col(order[0]) - F.col(valid_pos)
    state = F.when(F.col(valid_pos).isNull(), MISS).when(age <= micros(max_age), HIT).otherwise(STALE)
    return found.withColumn("lookup", state).select(
        *fact.columns, *[F.when(F.col("lookup") == HIT, F.col(v)).alias(v) for v in values], "lookup")


def composed_key(*parts) -> Column:
    """Store key such as ``userInfo:userId:7:userName``."""
    return F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def replace_by_rules(
    df: DataFrame, rules: DataFrame, column: str, code: str, name: str,
) -> DataFrame:
    """Replace codes by their rule's name; codes without a rule stay as they are."""
    small = broadcast_if_small(
        rules.groupBy(F.col(code).alias(column)).agg(F.max(name).alias("_name")))
    joined = df.join(small, [column], "left")
    return joined.withColumn(column, F.coalesce("_name", column)).select(*df.columns)


def keep_ruled(df: DataFrame, rules: DataFrame, column: str) -> DataFrame:
    """Rows whose value occurs among the rules."""
    small = broadcast_if_small(rules.select(column).distinct())
    return df.join(small, [column], "left_semi")


def map_lookup(df: DataFrame, entries: DataFrame, column: str, value: str) -> DataFrame:
    """Value of the small map for each row, null when the key is absent."""
    return df.join(broadcast_if_small(entries), [column], "left")


def keyword_filter(
    messages: DataFrame, keywords: DataFrame, order: Sequence[str], keyword_pos: str,
    keyword: str, text: str, initial: str, width: Width = None,
) -> DataFrame:
    """Messages containing the newest keyword at their time (``initial`` before the first).

    ``order`` identifies a message.  Only these columns go through the ordered
    scan; the texts meet their keyword in a join afterwards.
    """
    current = asof_latest(messages.select(*order), keywords, [], order, keyword_pos, [keyword], width)
    current = current.withColumn(keyword, F.coalesce(F.col(keyword), F.lit(initial)))
    return messages.join(current, list(order)).filter(F.col(text).contains(F.col(keyword)))
