"""Queries that SQL can state, value by value against another engine."""

import pytest
from parity import connect, difference

from likertlake.llm.queries import all_oracles, all_queries


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_same_rows(spark, sf_dir, name):
    assert difference(all_queries()[name](spark, sf_dir), connect(sf_dir), all_oracles()[name]) is None
