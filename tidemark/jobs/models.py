"""Queries over iteration and model jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.jobs.registry import DAY, EVENTS, events, query, table
from tidemark.operators import models as m
from tidemark.plans.staging import staged
from tidemark.plans.timing import plain

# Weights of the demonstration model: alternating signs over the vector's positions.
BIAS = 0.25


def weights(n: int) -> list[float]:
    return [1.0 if i % 2 == 0 else -1.0 for i in range(n)]


@query("iterate_fibonacci", """
WITH RECURSIVE p AS (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS a, CAST(l_linenumber AS BIGINT) AS b FROM lineitem),
r AS (SELECT a, b, a AS x, b AS y, 0 AS n FROM p
      UNION ALL SELECT a, b, y, x + y, n + 1 FROM r WHERE n = 0 OR (x < 100 AND y < 100)),
s AS (SELECT a, b, max(n) AS steps FROM r GROUP BY a, b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a, b, steps
FROM lineitem JOIN s ON a = CAST(l_quantity AS BIGINT) AND b = l_linenumber""")
def iterate_fibonacci(spark, sf_dir):
    a, b = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", a.alias("a"), b.alias("b"),
        m.steps_to_bound(a, b).alias("steps"))


@query("iterate_feedback", """
WITH RECURSIVE p AS (SELECT CAST(l_linenumber AS BIGINT) % 3 AS a, CAST(l_quantity AS BIGINT) % 5 AS b, count(*) AS lines
                     FROM lineitem GROUP BY ALL),
r AS (SELECT a, b, lines, a AS x, b AS y, CAST(0 AS BIGINT) AS n FROM p
      UNION ALL SELECT a, b, lines, y, x + y, n + 1 FROM r WHERE n < 9 AND (n = 0 OR (x < 100 AND y < 100 AND x + y > 0)))
SELECT a, b, lines, max(n) AS rounds, arg_max(x, n) AS x, arg_max(y, n) AS y,
       CASE WHEN greatest(arg_max(x, n), arg_max(y, n)) >= 100 THEN 'done' WHEN max(x) + max(y) = 0 THEN 'fixed' ELSE 'open' END AS outcome
FROM r GROUP BY a, b, lines""")
def iterate_feedback(spark, sf_dir):
    """The same steps as a feedback loop over the distinct pairs; pairs that never get there are reported as such."""
    pairs = table(spark, sf_dir, "lineitem").groupBy(
        (F.col("l_linenumber").cast("long") % 3).alias("a"), (F.col("l_quantity").cast("long") % 5).alias("b")).agg(
        F.count(F.lit(1)).alias("lines"))
    return m.iterate_frontier(
        pairs.withColumns({"x": F.col("a"), "y": F.col("b")}),
        lambda open_rows: open_rows.withColumns({"x": F.col("y"), "y": F.col("x") + F.col("y")}),
        ["x", "y"], (F.col("x") < 100) & (F.col("y") < 100), 9)


@query("window_model_predict", f"""
WITH {EVENTS},
s AS (SELECT (pos // {DAY} + 1) * {DAY} AS model_pos, count(*) AS n, sum(item)::BIGINT AS sx, sum(cents)::BIGINT AS sy,
             sum(item * item)::BIGINT AS sxx, sum(item * cents)::BIGINT AS sxy FROM ev GROUP BY ALL),
k AS (SELECT model_pos, n, sx, sy, CASE WHEN n * sxx - sx * sx <> 0
             THEN (n * sxy - sx * sy)::DOUBLE / (n * sxx - sx * sx)::DOUBLE ELSE 0.0::DOUBLE END AS slope FROM s),
mo AS (SELECT model_pos, slope, (sy - slope * sx) / n AS intercept FROM k)
SELECT event_id, make_timestamp(model_pos) AS model_at, round(intercept + slope * item, 4) AS prediction
FROM ev ASOF LEFT JOIN mo ON pos >= model_pos""")
def window_model_predict(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "ts", "pos", "item", "cents")
    models = staged(m.window_linear_models(rows, "ts", "1 day", "item", "cents"), "models")
    scored = m.score_with_latest(rows, models, ["pos", "event_id"], "item")
    return scored.select("event_id", plain("model_at").alias("model_at"),
                         F.round("prediction", 4).alias("prediction"))


@query("batch_score", f"""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i: CASE WHEN i % 2 = 1 THEN x::DOUBLE ELSE -x::DOUBLE END)) + {BIAS}, 6) AS score
FROM embeddings""")
def batch_score(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    width = len(vectors.select("embedding").first()[0])  # every vector has the same length
    score = m.linear_scorer(weights(width), BIAS)
    return vectors.select("vec_id", F.round(score("embedding"), 6).alias("score"))
