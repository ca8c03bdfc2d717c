"""Every registered query with SQL against that SQL; the others run and give rows."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, spark_rows, sql_rows
from tidemark.plans import queries as registry
from tidemark.plans.bed import Bed

FOLDER = "/root/testdata/sf0.001"
SQL = entry_point.oracle_sql()
SLOW: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def shared_bed():
    """One set of staged tables for the whole module."""
    beds = {}
    original = registry.Bed
    registry.Bed = lambda spark, folder: beds.setdefault(folder, Bed(spark, folder))
    yield
    registry.Bed = original


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    names, rows = spark_rows(entry_point.queries()[name](spark, FOLDER))
    sql_names, expected = sql_rows(con, SQL[name])
    assert names == sql_names
    assert rows == expected
    assert [list(map(type, r)) for r in rows[:1]] == [list(map(type, r)) for r in expected[:1]]


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert entry_point.queries()[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    out = entry_point.entry(spark)
    assert out.columns == ["loyalty_card", "churned", "members", "churn_rate"]
    assert out.count() == 3
