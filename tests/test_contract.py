"""Driver contract: entry runs, queries and oracles line up."""
import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "top_skills" in df.columns


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
