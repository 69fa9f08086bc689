from twinsift.operators.quality import foreign_key_check, not_null_check, unique_key_check


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, None)], "a long, b string")
    assert {r.column_name: r.null_count for r in not_null_check(df, ["a", "b"]).collect()} == {"a": 1, "b": 2}


def test_unique_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "k long, l long")
    got = [(r.k, r.l, r.occurrences) for r in unique_key_check(df, ["k", "l"]).collect()]
    assert got == [(1, 1, 2)]


def test_foreign_key_null_passes(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, fk long")
    parent = spark.createDataFrame([(10,)], "pk long")
    assert [r.id for r in foreign_key_check(child, "fk", parent, "pk").collect()] == [3]
