"""Keyed and windowed aggregates beyond a plain ``groupBy``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import tumbling
from tidemark.plans.buckets import Width
from tidemark.plans.ordered import row_numbers, running
from tidemark.plans.staging import staged
from tidemark.plans.timing import position, window_end, window_start


def reduce_window(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], value: str, keep: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Windowed reduce: sum one field, keep the other fields of the first record."""
    first = F.min_by(F.struct(*keep), F.struct(*order))
    out = tumbling(df, ts, size, keys, **{value: F.sum(value), "_first": first})
    return out.select("window", *keys, value, *[F.col(f"_first.{c}").alias(c) for c in keep])


def rolling_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, width: Width = None,
    name: str = "rolling_sum",
) -> DataFrame:
    """Running sum per key, one output row per input row."""
    return running(df, keys, order, {name: (value, "sum")}, width)


def collect_window_text(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], order: Sequence[str], item: Column,
    width: Width = None, per_part: int = 1000, sep: str = ";",
) -> DataFrame:
    """Window contents as ordered text.

    Contents come in numbered parts of at most ``per_part`` rows, so the text of
    a crowded window never has to fit into one cell; an ordinary window has one
    part.
    """
    rows = df.withColumn("_start", window_start(ts, size)).withColumn("_item", item)
    numbered = row_numbers(rows, [*keys, "_start"], order, width, "_rn").withColumn(
        "part", F.call_function("div", F.col("_rn") - 1, F.lit(per_part)).cast("long"))
    packed = numbered.groupBy("_start", *keys, "part").agg(
        F.array_sort(F.collect_list(F.struct("_rn", "_item"))).alias("_items"))
    contents = F.array_join(F.transform("_items", lambda e: e["_item"]), sep)
    label = F.format_string(
        "[%s~%s)", F.date_format("_start", "yyyy-MM-dd HH:mm:ss"),
        F.date_format(window_end("_start", size), "yyyy-MM-dd HH:mm:ss"))
    return packed.select(
        *keys, label.alias("window_label"), "part",
        F.size("_items").cast("long").alias("n"), contents.alias("contents"))


def changelog_counts(
    df: DataFrame, key: str, order: Sequence[str], width: Width = None,
) -> DataFrame:
    """Running count per key as a retract log.

    The first row of a key adds ``(key, 1)``; each later row withdraws the old
    count and adds the new one.
    """
    counted = row_numbers(df, [key], order, width, "_n")
    add = F.struct(F.lit("+").alias("op"), F.col("_n").alias("cnt"))
    withdraw = F.when(F.col("_n") > 1, F.struct(F.lit("-").alias("op"), (F.col("_n") - 1).alias("cnt")))
    steps = F.filter(F.array(withdraw, add), lambda s: s.isNotNull())
    return counted.withColumn("_step", F.explode(steps)).select(
        *order, key, F.col("_step.op").alias("op"), F.col("_step.cnt").alias("cnt"))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
) -> DataFrame:
    """Value of the latest row per key (partial aggregation, no sort)."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def rate_and_distribution(
    df: DataFrame, ts: str, size: str, value: str, seconds: int, accuracy: int = 10_000,
) -> DataFrame:
    """Event rate and distribution summary per window.

    Percentiles are the values at rank ``ceil(p * n)`` of the ``n`` values that are not null: rows are counted per
    window and value, and running counts over the values find the ranks, however many rows a window holds.  A stream
    has no running counts; there they are approximate, to ``1 / accuracy`` of the rows.
    """
    summary = {
        "n": F.count(F.lit(1)),
        "rate_per_second": F.count(F.lit(1)) / F.lit(float(seconds)),
        "min_value": F.min(value),
        "max_value": F.max(value),
        "total": F.sum(value),
    }
    if df.isStreaming:
        return tumbling(
            df, ts, size, [], **summary, p50=F.percentile_approx(value, 0.5, accuracy),
            p99=F.percentile_approx(value, 0.99, accuracy))
    start = position("window.start").alias("_start")
    counted = tumbling(df.filter(F.col(value).isNotNull()), ts, size, [value], _times=F.count(F.lit(1)))
    counted = staged(counted.select(start, F.col(value).alias("_value"), "_times"), "percentile-counts")
    known = counted.groupBy("_start").agg(F.sum("_times").alias("_known"))
    ranked = running(counted, ["_start"], ["_value"], {"_upto": ("_times", "sum")}).join(known, "_start")

    def at(share: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.ceil(F.lit(share) * F.col("_known")), F.col("_value")))

    picked = ranked.groupBy("_start").agg(at(0.5).alias("p50"), at(0.99).alias("p99"))
    whole = tumbling(df, ts, size, [], **summary)
    return whole.select("*", start).join(picked, "_start", "left").select(*whole.columns, "p50", "p99")


def parse_quality(df: DataFrame, text: str, parsed: Column, keys: Sequence[str] = ()) -> DataFrame:
    """How many records parse and how many do not, per key."""
    ok = parsed.isNotNull()
    return df.groupBy(*keys).agg(
        F.count_if(ok).alias("parsed"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col(text).isNull()).alias("missing"),
    )


def quantile_sketches(df: DataFrame, ts: str, size: str, value: str, keys: Sequence[str] = (), k: int = 800) -> DataFrame:
    """One mergeable quantile sketch of a BIGINT column per window; also for streams."""
    return tumbling(df, ts, size, keys, sketch=F.kll_sketch_agg_bigint(value, F.lit(k)))


def merged_quantiles(sketches: DataFrame, group: Sequence[Column], ranks: dict[str, float], k: int = 800) -> DataFrame:
    """Quantiles of coarser groups from merged sketches, without reading the values again."""
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("_sketch"))
    names = [c for c in merged.columns if c != "_sketch"]
    return merged.select(*names, F.kll_sketch_get_n_bigint("_sketch").alias("n"), *[
        F.kll_sketch_get_quantile_bigint("_sketch", F.lit(rank)).alias(name) for name, rank in ranks.items()])


def quantiles_checked(values: DataFrame, estimates: DataFrame, on: Sequence[str], value: str, ranks: dict[str, float],
                      bound: float = 0.01) -> DataFrame:
    """``on, n`` and for every quantile whether its true rank is within ``bound`` of the one asked for.

    An estimate that many rows share has a range of ranks; the nearest of them counts.
    """
    below = {f"_below_{q}": F.sum((F.col(value) < F.col(q)).cast("long")) for q in ranks}
    upto = {f"_upto_{q}": F.sum((F.col(value) <= F.col(q)).cast("long")) for q in ranks}
    counted = values.join(estimates.drop("n"), list(on)).groupBy(*on).agg(
        F.count(value).alias("n"), *[c.alias(n) for n, c in {**below, **upto}.items()])
    slack = F.col("n") * bound + 1
    return counted.select(*on, "n", *[
        ((F.col(f"_below_{q}") <= F.col("n") * rank + slack) & (F.col(f"_upto_{q}") >= F.col("n") * rank - slack)).alias(f"{q}_within")
        for q, rank in ranks.items()])
