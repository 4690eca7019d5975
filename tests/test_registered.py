"""Every registered query runs; those with reference SQL give its rows."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()
SLOW = {"topic_labels", "topic_terms", "topic_sizes"}  # covered by test_topics on small input


def test_oracle_names_are_registered():
    assert set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def connection(testdata):
    return compare.connect(testdata)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, testdata, connection, name):
    assert compare.difference(QUERIES[name](spark, testdata), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_runs(spark, testdata, name):
    assert QUERIES[name](spark, testdata).count() > 0


def test_entry(spark, testdata):
    assert contract.entry(spark).columns == [
        "review_date", "category", "review_count", "avg_rating", "avg_review_length"]
