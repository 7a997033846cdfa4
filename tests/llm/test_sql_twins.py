"""Queries with an SQL form give its rows, and all are registered."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import duck, sorted_rows
from tarmac.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_twin(spark, small, name):
    relation = duck(small).execute(ORACLE_SQL[name])
    names = [column[0] for column in relation.description]
    frame = QUERIES[name](spark, small)
    assert sorted(frame.columns) == sorted(names)
    got = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert got == sorted_rows(names, relation.fetchall()) and got


def test_all_operators_and_the_pipeline_are_registered():
    numbers = {int(m[1]) for m in map(re.compile(r"op(\d+)_").match, contract.queries()) if m}
    assert numbers == set(range(1, 14)) and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())
