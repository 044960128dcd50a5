import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import rows_apart, rows_of


@pytest.fixture
def rows(spark):
    """Rows with repeated and null keys."""
    rows = [(k, f"text {n}") for k in (*range(40), 7, None) for n in range(2)]
    return spark.createDataFrame(rows, "key long, text string")


@pytest.fixture
def ids(spark):
    return spark.createDataFrame([(k,) for k in (3, 7, 7, None, 99)], "key long")


def found(df):
    return sorted(((r["key"], r["text"]) for r in df.collect()), key=str)


def test_rows_of_and_apart(rows, ids):
    assert found(rows_of(rows, ids, "key")) == found(rows.filter("key in (3, 7)"))
    hit, others = rows_apart(rows, ids, "key")
    assert hit.columns == others.columns == rows.columns
    assert found(hit.unionByName(others)) == found(rows)
    assert found(hit.filter("key in (3, 7)")) == found(rows.filter("key in (3, 7)"))
    assert not others.filter("key in (3, 7)").count()


def test_only_marked_rows_are_shuffled(spark, rows, ids):
    """The exact join comes after the bitmap's, also when it cannot be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows_of(rows.filter(F.length("text") > 0), ids, "key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.split("\n") if "SortMergeJoin" in line or "BroadcastHashJoin" in line]
    assert "SortMergeJoin" in joins[0] and "BroadcastHashJoin" in joins[1]
