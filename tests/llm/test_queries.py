"""The registered queries of the operators against their SQL, where SQL can state them."""

import pytest

import oracle
from caudal.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, name):
    assert oracle.compare(QUERIES[name](spark, sf), oracle.connect(sf), SQL[name]) == []
