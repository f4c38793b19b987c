"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from dimkeeper.queries import ORACLES, QUERIES
from tests.compare import oracle_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got_names, got = spark_rows(contract.queries()[name](spark, FOLDER))
    want_names, want = oracle_rows(contract.oracle_sql()[name], FOLDER)
    assert got_names == want_names
    assert sum(got.values()) == sum(want.values())
    assert got == want


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
