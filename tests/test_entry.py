"""Driver contract: flagship runs, every query has a callable, oracles are named alike."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["request_number", "changed", "columns_changed"]
    assert df.count() > 0


def test_registry_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30
