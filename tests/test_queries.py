"""Registered queries against their SQL at the smallest scale."""

import os

import pytest
from compare import TABLES, check, oracle

from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, name):
    _, _, problem = check(spark, oracle(SF), name, QUERIES[name], ORACLES.get(name), SF)
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(TABLES) == 14
