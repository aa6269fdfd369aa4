"""Every registered query equals its DuckDB oracle (the driver's check), on sf0.001."""

import pytest

from oracle_check import run

SF = "/root/testdata/sf0.001"


@pytest.mark.slow
def test_all_queries_match_oracles(spark):
    from pagelens.registry import QUERIES
    res = run(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] is not True}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
