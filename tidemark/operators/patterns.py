"""Sequence patterns: what comes next, what follows, and what never came.

Within a key events are ordered by ``order`` (BIGINT position first, then a
tie-break).  Patterns bounded by ``within`` take a successor only if it comes
strictly less than ``within`` after the start.  They look a bounded distance
ahead and run over overlapping time buckets, which spreads a hot key over as
many tasks as it has buckets.  ``part_after_part`` needs no such bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import interval_join
from tidemark.plans.buckets import Width, buckets_for
from tidemark.plans.ordered import BUCKET, in_bucket, overlap, running, settle
from tidemark.plans.staging import staged
from tidemark.plans.timing import micros

MATCHED, TIMEOUT, BROKEN = "matched", "timeout", "broken"


def next_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
    within: str, carry: Sequence[str], width: Width = None,
) -> DataFrame:
    """``first`` immediately followed by ``second`` within the limit.

    One row per ``first`` event with ``status``

    * ``matched``  the next event of the key is in time and is ``second``
    * ``timeout``  no event of the key came in time
    * ``broken``   the next event came in time but is something else

    ``carry`` columns of the successor appear as ``next_<name>`` on matches.
    """
    limit = micros(within)
    pos = order[0]
    rows = overlap(
        df.withColumn("_first", first).withColumn("_second", second), keys, pos, width, ahead=within)
    scan = in_bucket(keys, *order)
    ahead = F.lead(F.struct(pos, "_second", *[c for c in carry if c != pos])).over(scan)
    seen = settle(rows.withColumn("_next", ahead)).filter("_first")
    in_time = F.coalesce(F.col(f"_next.{pos}") - F.col(pos) < F.lit(limit), F.lit(False))
    status = (
        F.when(~in_time, TIMEOUT).when(F.col("_next._second"), MATCHED).otherwise(BROKEN)
    )
    out = seen.withColumn("status", status)
    return out.select(
        *df.columns, "status",
        *[F.when(F.col("status") == MATCHED, F.col(f"_next.{c}")).alias(f"next_{c}") for c in carry])


def followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
    within: str, carry: Sequence[str], width: Width = None,
) -> DataFrame:
    """``first`` followed, with anything between, by the first later ``second`` in time.

    One row per ``first`` event, ``matched`` or ``timeout``.
    """
    limit = micros(within)
    pos = order[0]
    rows = overlap(
        df.withColumn("_first", first).withColumn("_second", second), keys, pos, width, ahead=within)
    # Scanned backwards, the nearest follower is the last one met so far; this
    # frame grows row by row, while "rows to the end" is recomputed for every row.
    later = in_bucket(keys, *[F.desc(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    found = F.last(
        F.when(F.col("_second"), F.struct(pos, *[c for c in carry if c != pos])), ignorenulls=True,
    ).over(later)
    seen = settle(rows.withColumn("_next", found)).filter("_first")
    in_time = F.coalesce(F.col(f"_next.{pos}") - F.col(pos) < F.lit(limit), F.lit(False))
    out = seen.withColumn("status", F.when(in_time, MATCHED).otherwise(TIMEOUT))
    return out.select(
        *df.columns, "status",
        *[F.when(F.col("status") == MATCHED, F.col(f"_next.{c}")).alias(f"next_{c}") for c in carry])


def followed_by_any(
    firsts: DataFrame, seconds: DataFrame, keys: Sequence[str], first_ts: str, second_ts: str,
    within: str,
) -> DataFrame:
    """Every later ``second`` in time for every ``first``."""
    return interval_join(firsts, seconds, keys, first_ts, second_ts, 1, micros(within) - 1)


def flat(df: DataFrame, *steps: Column) -> DataFrame:
    """One row per event of a match instead of one row per match."""
    return df.select(F.explode(F.array(*steps)).alias("event")).select("event.*")


def times_then_times(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], event_id: str,
    first: Column, first_times: tuple[int, int], second: Column, second_times: tuple[int, int],
    within: str, width: Width = None,
) -> DataFrame:
    """``first`` x(min..max), then at once ``second`` x(min..max), all within the limit.

    Repetitions are relaxed: other events may lie between two occurrences, but no
    occurrence is skipped.  The first ``second`` must be the very next event
    after the last ``first``.  Conditions and counts are plain arguments, so a
    job may be started with another pattern.

    One row per match with the ids of both parts.  Occurrence lists are window
    frames of at most ``max`` rows, never whole groups.
    """
    limit = micros(within)
    pos = order[0]
    (a_min, a_max), (b_min, b_max) = first_times, second_times
    part = F.when(first, "a").when(second, "b").otherwise("x")
    rows = overlap(
        df.withColumn("_part", part), keys, pos, width, ahead=within, behind=within
    ).repartition(*keys, BUCKET)  # one placement serves both window partitionings
    entry = F.struct(F.col(pos).alias("pos"), F.col(event_id).alias("id"))
    runs = in_bucket([*keys, "_part"], *order)
    scan = in_bucket(keys, *order)
    seen = (
        rows
        .withColumn("_back", F.collect_list(entry).over(runs.rowsBetween(-(a_max - 1), 0)))
        .withColumn("_fwd", F.collect_list(entry).over(runs.rowsBetween(0, b_max - 1)))
    )
    # The match is held by its first `second` event, whose previous event must be a `first`.
    linked = seen.withColumn(
        "_before", F.lag(F.when(F.col("_part") == "a", F.col("_back"))).over(scan))
    held = settle(linked).filter((F.col("_part") == "b") & F.col("_before").isNotNull())
    chosen = (
        held.withColumn("_na", F.explode(F.sequence(F.lit(a_min), F.lit(a_max))))
        .filter(F.size("_before") >= F.col("_na"))
        .withColumn("_nb", F.explode(F.sequence(F.lit(b_min), F.lit(b_max))))
        .filter(F.size("_fwd") >= F.col("_nb"))
        .withColumn("_a", F.slice("_before", -F.col("_na"), F.col("_na")))
        .withColumn("_b", F.slice("_fwd", F.lit(1), F.col("_nb")))
    )
    inside = F.element_at("_b", -1)["pos"] - F.element_at("_a", 1)["pos"] < F.lit(limit)
    ids = lambda c: F.array_join(F.transform(c, lambda e: e["id"].cast("string")), ",")
    return chosen.filter(inside).select(*keys, ids("_a").alias("first_ids"), ids("_b").alias("second_ids"))


def part_after_part(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], event_id: str,
    parts: Sequence[tuple[Column, int, int]], within: str | None = None, width: Width = None,
) -> DataFrame:
    """Any number of parts ``(condition, min, max)``, one at once after the other, with or without a time limit.

    Repetitions within a part are relaxed, as in ``times_then_times``; the first event of a part must be the very next
    event after the last one of the part before.  Every start and every allowed count gives a match of its own.

    Without a limit a match may reach over any stretch of time, so the rows are not cut by time but linked by numbers:
    each event has its number within the key, and each condition's events their rank.  Occurrences of one rank meet
    those up to ``max`` ranks before them, and parts meet where one ends and the next begins.  All these are joins and
    groups by (key, number), in which a hot key is spread like any other.

    One row per match: the keys, ``ids_1`` .. ``ids_n`` (comma-joined), ``first_pos`` and ``last_pos``.  Null conditions
    count as false; null keys form one key.
    """
    keys, order = list(keys), list(order)
    names = [f"_k{i}" for i in range(len(keys))]
    flags = {f"_is{i}": F.coalesce(condition, F.lit(False)).cast("long") for i, (condition, _, _) in enumerate(parts)}
    slim = df.select(
        *[F.struct(F.col(k).alias("k")).alias(n) for k, n in zip(keys, names)],
        *order, F.col(event_id).cast("string").alias("_id"),
        F.lit(1).cast("long").alias("_one"), *[flag.alias(name) for name, flag in flags.items()])
    numbered = running(slim, names, order, {
        "_rn": ("_one", "sum"), **{f"_rank{i}": (f"_is{i}", "sum") for i in range(len(parts))}}, width)
    rows = staged(numbered.filter(reduce(lambda a, b: a | b, [F.col(f) == 1 for f in flags])).select(
        *names, F.col(order[0]).alias("_pos"), "_id", "_rn", *flags, *[f"_rank{i}" for i in range(len(parts))]), "parts")

    def starts(i: int) -> DataFrame:
        """Per event of a part its occurrences from there on, at most ``max``."""
        _, _, most = parts[i]
        own = rows.filter(F.col(f"_is{i}") == 1).select(*names, f"_rank{i}", F.struct("_rn", "_id", "_pos").alias("_o"))
        back = F.sequence(F.greatest(F.lit(1), F.col(f"_rank{i}") - most + 1), F.col(f"_rank{i}"))
        return own.withColumn("_from", F.explode(back)).groupBy(*names, "_from").agg(
            F.sort_array(F.collect_list("_o")).alias("_run")).select(
            *names, F.col("_run")[0]["_rn"].alias("_at"), "_run")

    found = None
    for i, (_, least, most) in enumerate(parts):
        begun = starts(i)
        if found is None:
            joined = begun.withColumn("_first", F.col("_run")[0]["_pos"])
        else:
            joined = found.join(begun, [*names, "_at"])
        counts = F.sequence(F.lit(least), F.least(F.size("_run"), F.lit(most)))
        chosen = joined.filter(F.size("_run") >= least).withColumn("_n", F.explode(counts)).withColumn(
            "_last", F.element_at("_run", F.col("_n")))
        if within is not None:
            chosen = chosen.filter(F.col("_last._pos") - F.col("_first") < micros(within))
        ids = F.array_join(F.transform(F.slice("_run", F.lit(1), F.col("_n")), lambda o: o["_id"]), ",")
        found = chosen.select(
            *names, (F.col("_last._rn") + 1).alias("_at"), "_first", F.col("_last._pos").alias("_end"),
            *[f"ids_{j + 1}" for j in range(i)], ids.alias(f"ids_{i + 1}"))
    return found.select(
        *[F.col(f"{n}.k").alias(k) for k, n in zip(keys, names)],
        *[f"ids_{i + 1}" for i in range(len(parts))], F.col("_first").alias("first_pos"), F.col("_end").alias("last_pos"))


def escalation(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], over: Column, warn_within: str,
    alarm_within: str, width: Width = None,
) -> DataFrame:
    """Two-level alarm: two over-limit events in a row make a warning, two warnings in a row an alarm."""
    pos, tie = order[0], list(order[1:])
    buckets = buckets_for(df, pos, width, apart=8 * max(micros(warn_within), micros(alarm_within)))
    pairs = next_within(df, keys, order, over, over, warn_within, list(order), buckets)
    warnings = pairs.filter(F.col("status") == MATCHED).select(
        *keys, *order, F.col(f"next_{pos}").alias("warned"))
    alarms = next_within(
        warnings, keys, ["warned", pos, *tie], F.lit(True), F.lit(True), alarm_within,
        ["warned", *tie], buckets)
    return alarms.filter(F.col("status") == MATCHED)
