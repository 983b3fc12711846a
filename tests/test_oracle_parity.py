"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

from oracle import compare
from tessera.plans.registry import load_all

BASE = "/root/testdata/sf0.001"
QUERIES, ORACLE = load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    if name not in ORACLE:
        assert QUERIES[name](spark, BASE).count() >= 0
        return
    problems, _ = compare(spark, name, QUERIES[name], ORACLE[name], BASE, verbose=False)
    assert not problems, problems
