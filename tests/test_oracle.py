"""Every query with SQL gives what the SQL gives; every other query gives rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import compare


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    ours = contract.queries()[name](spark, sf_dir).toArrow()
    theirs = duck.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert compare.differences(ours, theirs) == []
    assert ours.num_rows > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["total", "title"]
    assert contract.entry(spark).count() > 0
