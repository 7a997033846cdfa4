"""Every registered query that has an SQL twin gives the twin's rows."""

import pytest

import __spark_entry__ as contract
from checks import oracle, registry
from checks.compare import differences, duck

TEXTS = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_twin(spark, small, connection, name):
    verdict, _, _ = differences(spark, connection, small, name, TEXTS.get(name))
    # the smallest tables leave a few thresholds without rows
    assert verdict.startswith(("ok", "rows only")), verdict


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:3] == ["YEAR", "MONTH", "TOTAL_FLIGHTS"]
