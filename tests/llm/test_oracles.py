"""The operators' registered queries that SQL can express equal their DuckDB oracles."""

import pytest

from oracle_check import run
from pagelens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert run(spark, "/root/testdata/sf0.01", [name], verbose=False)[name][0] is True


def test_registered():
    import __spark_entry__ as E
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
