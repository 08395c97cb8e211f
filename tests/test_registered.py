"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry
from duelframe.plans.catalog import QUERIES
from duelframe.plans.oracle import ORACLE_SQL as SQL
from tests.compare import difference
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_check_query(spark, small_duck, name):
    assert difference(spark, small_duck, SMALL, QUERIES[name], SQL[name]) is None


def test_every_query_has_a_check_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_comparison_notices_a_difference(spark, small_duck):
    wrong = SQL["total_wins"].replace("n AS total_wins", "n + 1 AS total_wins")
    assert wrong != SQL["total_wins"]
    assert difference(spark, small_duck, SMALL, QUERIES["total_wins"], wrong) is not None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    scores = [r.weighted_score for r in rows]
    assert len(rows) == 10 and scores == sorted(scores, reverse=True)
