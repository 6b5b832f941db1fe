import __spark_entry__ as entry


def test_entry_and_names(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "day" in df.columns
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 120
