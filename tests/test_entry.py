"""Driver contract: entry smoke run and registry consistency."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "n_turns", "reason", "reason_class"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45
