"""The queries that SQL can express, against DuckDB."""

import pytest

from recsignals.llm.queries import ORACLES, QUERIES
from tests.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    sf = "/root/testdata/sf0.001"
    want = duck(sf).execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf).toPandas()
    assert rows_of(got) == rows_of(want)
