"""Detection jobs: payments, failed logins, blacklists, outages, trends, triggers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import top_n
from tidemark.plans.buckets import Width, buckets_for
from tidemark.plans.ordered import BUCKET, in_bucket, overlap, running, settle, with_next, with_previous
from tidemark.plans.segments import SEGMENT, chain_rows, with_segments
from tidemark.plans.staging import staged
from tidemark.plans.timing import instant, micros

PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
UNPAID = "order timeout"
NO_CREATE = "already payed but not found create log"


def payment_outcome(created: Column, paid: Column, within: str | int) -> Column:
    """Outcome of an order from its first create and first pay position.

    A payment exactly at the deadline is late; a payment before the create counts.
    """
    limit = F.lit(micros(within))
    return (
        F.when(created.isNull(), NO_CREATE)
        .when(paid.isNull(), UNPAID)
        .when(paid < created + limit, PAID)
        .otherwise(PAID_LATE)
    )


def order_outcomes(
    df: DataFrame, keys: Sequence[str], pos: str, is_create: Column, is_pay: Column,
    within: str | int,
) -> DataFrame:
    """One outcome per order, whatever the arrival order (two map-side minima)."""
    firsts = df.groupBy(*keys).agg(
        F.min(F.when(is_create, F.col(pos))).alias("created"),
        F.min(F.when(is_pay, F.col(pos))).alias("paid"),
    ).filter("created IS NOT NULL OR paid IS NOT NULL")
    return firsts.withColumn("outcome", payment_outcome(F.col("created"), F.col("paid"), within))


def fails_at_timer(
    df: DataFrame, keys: Sequence[str], pos: str, is_fail: Column, is_clear: Column,
    wait: str, width: Width = None, at_least: int = 2, ties: Sequence[str] = (),
) -> DataFrame:
    """Failed logins counted by a timer ``wait`` after each failure.

    Every failure sets a timer.  A timer counts the failures collected since the
    previous timer went off and since the last success, alarms from ``at_least``
    on, and empties the list.  So the count at a timer is a difference of running
    counts, and only rows within ``wait`` around the failure matter.  Of failures at the same position the first
    in the order of ``ties`` owns the alarm.
    """
    w = micros(wait)
    rows = overlap(
        df.withColumn("_fail", is_fail.cast("long")).withColumn("_clear", is_clear),
        keys, pos, width, ahead=wait, behind=wait)
    by_time = in_bucket(keys, pos)
    upto = by_time.rangeBetween(Window.unboundedPreceding, w)
    counted = (
        rows.withColumn("_c", F.sum("_fail").over(
            by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_due", F.sum("_fail").over(upto))
    )
    counted = counted.withColumn(
        "_cleared", F.max(F.when(F.col("_clear"), F.col("_c"))).over(upto))
    fails = counted.filter("_fail = 1")
    fails = fails.withColumn("_fired", F.lag("_due").over(in_bucket(keys, pos, *ties)))
    gone = F.greatest(F.coalesce("_fired", F.lit(0)), F.coalesce("_cleared", F.lit(0)))
    return (
        settle(fails.withColumn("fails", F.col("_due") - gone))
        .filter(F.col("fails") >= at_least)
        .withColumn("alert_at", instant(F.col(pos) + F.lit(w)))
        .drop("_fail", "_clear", "_c", "_due", "_cleared", "_fired")
    )


def blacklist(
    df: DataFrame, ts: str, keys: Sequence[str], order: Sequence, max_count: int,
) -> DataFrame:
    """Rows up to the daily limit per key as ``pass``, the first one beyond it as ``warn``.

    Later rows of the day are dropped.  The rank filter is a group limit, so a
    key with any number of rows a day sends at most ``max_count + 1`` per task.
    """
    days = df.withColumn("day", F.date_trunc("day", F.col(ts)))
    ranked = top_n(days, [*keys, "day"], order, max_count + 1, "_rank")
    return ranked.withColumn(
        "verdict", F.when(F.col("_rank") <= max_count, "pass").otherwise("warn")).drop("_rank")


def offline_alerts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], is_offline: Column, every: str,
    width: Width = None,
) -> DataFrame:
    """Alerts ``every`` after an offline message and again until the next message.

    Any later message stops the series (an offline message starts a new one).  A
    series still open at the end runs up to the latest event time of the input.
    """
    pos, step = order[0], micros(every)
    end = df.agg(F.max(pos)).first()[0]
    seen = with_next(df, keys, order, [pos], width).filter(is_offline)
    last = F.coalesce(F.col(f"next_{pos}") - 1, F.lit(end))
    marks = F.when(last >= F.col(pos) + step, F.sequence(F.col(pos) + F.lit(step), last, F.lit(step)))
    return (
        seen.select(*keys, *order, F.posexplode(marks).alias("_i", "_at"))
        .select(*keys, *order, (F.col("_i") + 1).cast("long").alias("alert_no"),
                instant("_at").alias("alert_at"))
    )


def rising_trends(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hold: str,
    width: Width = None,
) -> DataFrame:
    """Alert when a value has not decreased for ``hold`` after it began to rise.

    A rise starts a timer unless one is running; a decrease, or a previous value
    of zero, cancels it.  After an alert the next rise starts a new timer.
    """
    pos, wait = order[0], micros(hold)
    buckets = buckets_for(df, pos, width)
    seen = with_previous(df, keys, order, [value], buckets)
    before = F.col(f"prev_{value}")
    reset = before.isNull() | (before > F.col(value)) | (before == 0)
    # A timer lives until the next reset row.  Scanned backwards, that row is the
    # last reset met so far; its position also names the stretch before it.
    marked = staged(
        seen.select(*keys, *order, (~reset & (before < F.col(value))).alias("_rise"),
                    F.when(reset, F.col(pos)).alias("_reset_at"), (-F.col(pos)).alias("_back"),
                    *[(-F.col(c)).alias(f"_back_{c}") for c in order[1:]]), "rising")
    backwards = ["_back", *[f"_back_{c}" for c in order[1:]]]
    ahead = running(marked, keys, backwards, {SEGMENT: ("_reset_at", "last")}, buckets.mirrored())
    end = -(marked.agg(F.min("_back")).first()[0] or 0)
    rises = ahead.filter("_rise").select(
        *keys, *order, F.coalesce(SEGMENT, F.lit(end + 1)).alias(SEGMENT))
    due = F.col(pos) + F.lit(wait)
    begun = chain_rows(rises, keys, order, pos, wait).filter(due < F.col(SEGMENT))
    return begun.select(*keys, *order, instant(due).alias("alert_at"))


def delta_trigger(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], progress: str, threshold: int,
    measure: str, last: str, width: Width = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Fire whenever ``progress`` has grown by more than ``threshold`` since the last firing.

    Each firing reports the row with the largest ``measure`` among the rows of
    the ``last`` duration up to it.  ``progress`` is a BIGINT that must not decrease.  A row that
    is further than the threshold from its predecessor fires in any case, so the
    scan restarts there and the stretches run in parallel.
    """
    pos = order[0]
    buckets = buckets_for(df, pos, width, apart=8 * micros(last))
    # The evictor's view is a bounded look back: the best row is known before any firing.
    # A range frame would also see later rows of the same position, so those are scanned by rows.
    recent = in_bucket(keys, pos).rangeBetween(-(micros(last) - 1), -1)
    tied = Window.partitionBy(*keys, BUCKET, pos).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fields = list(dict.fromkeys([*order, *keep, measure]))
    # The earliest of the rows that share the largest measure.
    rank = F.struct(F.col(measure).alias("_measure"), *[(-F.col(c)).alias(f"_{c}") for c in order],
                    F.struct(*fields).alias("row"))
    best = settle(overlap(df, keys, pos, buckets, behind=last).withColumn(
        "_best", F.greatest(F.max(rank).over(recent), F.max(rank).over(tied))["row"]))
    flat = staged(best.select(
        *keys, *order, progress, *[F.col(f"_best.{f}").alias(f"best_{f}") for f in fields]), "recent-best")
    seen = staged(with_previous(flat, keys, order, [progress], buckets), "delta")
    before = F.col(f"prev_{progress}")
    jumped = F.col(progress) - before > F.lit(threshold)
    cut = with_segments(seen.withColumn("_first", before.isNull()), keys, order,
                        before.isNull() | jumped, buckets)
    # The very first row of a key only sets the level.
    return chain_rows(cut, keys, order, progress, threshold).filter("NOT _first").drop(
        "_first", f"prev_{progress}", SEGMENT)
