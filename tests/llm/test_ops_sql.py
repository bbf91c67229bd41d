"""Queries with SQL against DuckDB on the smallest tables."""

import pytest
from compare import same

from threadloom.llm import entry


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql(name, spark, duck, sf):
    same(entry.queries()[name](spark, sf), duck.execute(entry.oracle_sql()[name]))
