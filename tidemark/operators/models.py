"""Iteration and model jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import asof_latest
from tidemark.plans.panes import tumbling_totals
from tidemark.plans.staging import staged
from tidemark.plans.timing import instant, position


def steps_to_bound(a: Column, b: Column, bound: int = 100) -> Column:
    """Fibonacci steps ``(a, b) -> (b, a + b)`` until one value reaches ``bound``.

    The step runs once before the test.  After n steps both values are fixed
    combinations ``p * a + q * b`` of the start, so the loop unrolls into one
    generated CASE expression per row: no shuffle, no driver loop.  Inputs must
    not be negative; the pair (0, 0) never ends and gives null.
    """
    a, b = a.cast("long"), b.cast("long")
    x, y = (0, 1), (1, 1)  # coefficients of (a, b) after the first step
    result, n, slowest = None, 1, (1, 0)  # (1, 0) needs the most steps
    while True:
        reached = ((x[0] * a + x[1] * b) >= bound) | ((y[0] * a + y[1] * b) >= bound)
        result = F.when(reached, n) if result is None else result.when(reached, n)
        if max(x[0] * slowest[0] + x[1] * slowest[1], y[0] * slowest[0] + y[1] * slowest[1]) >= bound:
            return result
        x, y, n = y, (x[0] + y[0], x[1] + y[1]), n + 1


def iterate_until(
    df: DataFrame, step: Callable[[DataFrame], DataFrame], again: Column, max_rounds: int,
    checkpoint_every: int = 5,
) -> DataFrame:
    """Feedback loop over whole frames, for steps that cannot run inside a row.

    Rows that satisfy ``again`` go back into ``step``; the others leave.  Lineage
    is cut with ``checkpoint()``, so the session needs a checkpoint folder.
    """
    finished, feedback = None, df
    for round_no in range(1, max_rounds + 1):
        stepped = step(feedback)
        if round_no % checkpoint_every == 0:
            stepped = stepped.checkpoint()
        done = stepped.filter(~again)
        finished = done if finished is None else finished.unionByName(done)
        feedback = stepped.filter(again)
        if round_no % checkpoint_every == 0 and feedback.isEmpty():
            return finished
    if not feedback.isEmpty():
        raise RuntimeError(f"rows left after {max_rounds} rounds")
    return finished


def iterate_frontier(
    df: DataFrame, step: Callable[[DataFrame], DataFrame], state: Sequence[str], again: Column, max_rounds: int,
) -> DataFrame:
    """Feedback loop that keeps only the open rows: adds ``rounds`` and ``outcome`` to every row of ``df``.

    ``step`` replaces the columns ``state`` and keeps the others.  After each round rows that no longer satisfy ``again``
    leave as ``done`` and rows that the step left as they were, and would for ever, as ``fixed``; the rest is written to
    the shared folder and goes on.  What is open after ``max_rounds`` is reported as ``open``.  So a round costs what is
    still open, and no plan grows with the number of rounds.
    """
    finished, frontier = [], df
    before = [F.struct(*state).alias("_before")]
    for round_no in range(1, max_rounds + 1):
        stepped = step(frontier.select("*", *before)).withColumn(
            "outcome", F.when(~F.coalesce(again, F.lit(False)), "done").when(
                F.struct(*state) == F.col("_before"), "fixed").otherwise("open")).drop("_before")
        stepped = staged(stepped.withColumn("rounds", F.lit(round_no).cast("long")), "frontier")
        finished.append(stepped.filter("outcome <> 'open'"))
        frontier = stepped.filter("outcome = 'open'").drop("outcome", "rounds")
        if frontier.isEmpty():
            break
    else:
        finished.append(stepped.filter("outcome = 'open'"))
    return reduce(lambda a, b: a.unionByName(b), finished)


def window_linear_models(df: DataFrame, ts: str, size: str, x: str, y: str) -> DataFrame:
    """Least-squares line per window from exact integer sums of ``x`` and ``y``.

    A window's model becomes usable at the window's end.
    """
    sums = tumbling_totals(df, ts, [], size, {
        "n": F.count(F.lit(1)), "sx": F.sum(x), "sy": F.sum(y),
        "sxx": F.sum(F.col(x) * F.col(x)), "sxy": F.sum(F.col(x) * F.col(y))})
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("n", "sx", "sy", "sxx", "sxy")}  # products exceed 64 bits
    spread = wide["n"] * wide["sxx"] - wide["sx"] * wide["sx"]
    common = wide["n"] * wide["sxy"] - wide["sx"] * wide["sy"]
    slope = F.when(spread != 0, common.cast("double") / spread.cast("double")).otherwise(0.0)
    return sums.withColumn("slope", slope).select(
        position("window.end").alias("model_pos"), "slope",
        ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept"))


def score_with_latest(
    df: DataFrame, models: DataFrame, order: Sequence[str], x: str, width: Width = None,
) -> DataFrame:
    """Score each row with the newest model at its time (null before the first)."""
    tagged = asof_latest(df, models, [], order, "model_pos", ["model_pos", "slope", "intercept"], width)
    return tagged.withColumn(
        "prediction", F.col("intercept") + F.col("slope") * F.col(x)).withColumn(
        "model_at", instant("model_pos"))


def linear_scorer(weights: Sequence[float], bias: float):
    """Iterator UDF scoring vectors in Arrow batches; the model is set up once per task."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = np.asarray(weights, dtype="float64")
        for vectors in batches:
            matrix = np.stack(vectors.to_numpy()).astype("float64")
            yield pd.Series(matrix @ model + bias)

    return score
