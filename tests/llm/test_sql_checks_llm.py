"""Every registered text query against its SQL check on the given tables."""

import pytest

from fixtures import compare
from wardloom.llm import oracle, queries


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(oracle.registered()))
def test_matches_sql(spark, small, con, name):
    assert compare.differences(queries.registered()[name](spark, small), con, oracle.registered()[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))
