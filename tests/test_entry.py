"""The driver contract: entry() runs; every query has a callable."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 3


def test_oracles_are_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 50
