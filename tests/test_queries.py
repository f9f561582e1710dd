"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
import compare
from conftest import TESTDATA

SQL = contract.oracle_sql()
QUERIES = contract.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(TESTDATA)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert compare.differences(QUERIES[name](spark, TESTDATA), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, TESTDATA).count() > 0


def test_approximate_fences_keep_the_rank_error(spark, con):
    """Fences give back the quartiles; each must lie within 5 % of its rank."""
    n = con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    for row in QUERIES["approx_fences"](spark, TESTDATA).collect():
        spread = (row.upper - row.lower) / 4
        for quartile, share in ((row.lower + 1.5 * spread, 0.25), (row.median, 0.5), (row.upper - 1.5 * spread, 0.75)):
            q = f"{quartile:.9f}"
            below, upto = con.execute(
                f"SELECT count(*) FILTER ({row.column} < {q} - 1e-6), count(*) FILTER ({row.column} <= {q} + 1e-6) FROM lineitem"
            ).fetchone()
            assert below / n <= share + 0.05 and upto / n >= share - 0.05


def test_entry(spark):
    assert contract.entry(spark).count() > 0
