import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 175  # 200 documents, 25 removed at 0.8
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_sql_checked_query_has_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(E._QUERIES) <= set(s)
