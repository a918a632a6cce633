"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as contract
import check
from snapmart import registry


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


OWN = set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(OWN & set(contract.oracle_sql())))
def test_query_equals_its_sql(spark, con, name):
    assert check.differences(spark, con, name, SF) is None


@pytest.mark.parametrize("name", sorted(OWN - set(contract.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert "total_engagement" in frame.columns


def test_every_check_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
