import __spark_entry__ as E


def test_contract_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"orig_type", "source_articles", "duplicates"}
