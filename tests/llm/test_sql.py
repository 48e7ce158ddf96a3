"""Queries of the package that SQL can express, against their DuckDB texts."""

import pytest

from oracle import check
from quire.llm import queries as q


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query(spark, name):
    check(spark, name, q.QUERIES[name], q.ORACLES[name])
