"""Every registered query against its SQL statement on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SMALL, name) == ""


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_one_row(spark):
    assert contract.entry(spark).count() == 1
