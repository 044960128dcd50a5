"""Every registered query against its SQL, or at least runnable where there is none."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_approximate_counts_are_close(spark, sf_dir):
    exact = {r["day"]: r["uv"] for r in QUERIES["sql_uv_daily"](spark, sf_dir).collect()}
    sketched = {r["day"]: r["uv"] for r in QUERIES["uv_hll"](spark, sf_dir).collect()}
    approx = {str(r["window_start"].date()): r["uv"] for r in QUERIES["uv_approx"](spark, sf_dir).collect()}
    assert exact.keys() == sketched.keys() == approx.keys()
    for day, uv in exact.items():
        assert abs(sketched[day] - uv) <= max(1, 0.05 * uv)
        assert abs(approx[day] - uv) <= max(1, 0.05 * uv)
