"""Every registered query that has SQL gives the same rows on the smallest tables."""

import check_sql
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(folder):
    return check_sql.connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, folder, con, name):
    assert check_sql.compare(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_gives_rows(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
