"""Every named query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from meterline.queries import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    assert compare.compare(spark, con, name, SF) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(contract.queries())
    assert set(REGISTRY) <= set(contract.oracle_sql())
