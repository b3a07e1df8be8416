"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks import oracle, registry
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    from checks.compare import database

    return database(SMALL)


def test_each_query_has_sql():
    assert set(oracle.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(contract.queries())
    assert len(registry.queries()) >= 71


def test_entry(spark):
    assert contract.entry(spark).count() == 20


@pytest.mark.parametrize("name", list(registry.queries()))
def test_same_rows_as_sql(spark, con, name):
    from checks.compare import compare

    verdict, _, _ = compare(spark, con, SMALL, name)
    assert verdict.startswith("ok"), verdict
