"""Query registry and the inputs shared by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.timing import position
from tidemark.session import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Position in SQL: microseconds since the epoch.
POS = "epoch_us(ts)"

# The event table with the columns the oracles use.
EVENTS = """
ev AS (
  SELECT event_id, ts, epoch_us(ts) AS pos, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
  FROM events)"""


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same result."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def with_event_columns(df: DataFrame) -> DataFrame:
    """Add position, item id and the value in whole cents."""
    return (
        df.withColumn("pos", position("ts"))
        .withColumn("item", F.get_json_object("props", "$.k").cast("long"))
        .withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_columns(table(spark, sf_dir, "events"))


def tumble_sql(size_us: int, ts: str = "ts") -> str:
    """Start of the tumbling window of a time column, in SQL."""
    return f"make_timestamp((epoch_us({ts}) // {size_us}) * {size_us})"


MINUTE = 60_000_000
HOUR = 3_600_000_000
DAY = 86_400_000_000
