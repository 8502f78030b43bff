"""Every registered query against its SQL, on the smallest tables."""

import pytest

from conftest import ROOT  # noqa: F401
from tools import check_oracle

import __spark_entry__ as entry
from workload.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    good, message = check_oracle.compare(spark, oracle, SF, name)
    assert good, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "symbol", "date", "open_price", "high_price", "low_price", "close_price", "total_volume"
    ]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
