"""Every registered query against its SQL over the whole tables."""

import compare
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


def test_every_query_has_sql():
    assert set(ORACLE) == set(NAMES)
    assert set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, folder, name):
    frame = QUERIES[name](spark, folder)
    assert compare.difference(frame, con, ORACLE[name]) is None


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[:3] == ["windowStart", "windowEnd", "windowSize"]
    assert rows.count() > 0
