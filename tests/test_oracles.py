"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, oracle  # noqa: E402

from barloom.checks.oracles import ORACLES  # noqa: E402
from barloom.checks.queries import REGISTRY  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    diff = compare(queries()[name](spark, SF), duck, oracle_sql()[name])
    assert diff == ""


def test_entry(spark):
    assert entry(spark).columns == ["ticker", "company_name", "total_return_pct"]
    assert entry(spark).count() == 10
