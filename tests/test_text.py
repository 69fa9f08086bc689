import pytest
from pyspark.sql import functions as F

from twinsift.functions.text import included_columns, with_combined_text, with_features, word_shingles


def test_combined_text_skips_nulls(spark):
    df = spark.createDataFrame([(1, "a", None, "b"), (2, None, None, None)], "id long, x string, y string, z string")
    got = {r.id: r.combined_data for r in with_combined_text(df, ["id"]).collect()}
    assert got == {1: "a,b", 2: ""}


def test_combined_text_types_and_null_marker(spark):
    df = spark.sql("SELECT 1L AS id, DATE'2024-01-02' AS d, 1.5D AS x, array('p', 'q') AS a, true AS b,"
                   " CAST(NULL AS STRING) AS n")
    assert with_combined_text(df, ["id"]).first().combined_data == "2024-01-02,1.5,p,q,true"
    assert with_combined_text(df, ["id"], null_marker="<null>").first().combined_data == \
        "2024-01-02,1.5,p,q,true,<null>"


def test_exclude_is_list_membership_not_substring(spark):
    df = spark.createDataFrame([(1, 5, 7)], "id long, net_id long, payer_net_id long")
    assert included_columns(df, ["id", "payer_net_id"]) == ["net_id"]
    assert with_combined_text(df, ["id", "payer_net_id"]).first().combined_data == "5"


def test_unknown_excluded_column_raises(spark):
    df = spark.createDataFrame([(1, "a")], "id long, x string")
    with pytest.raises(ValueError):
        included_columns(df, ["id", "patient_id"])


def test_shingles(spark):
    df = spark.createDataFrame([("The cat, sat on", ), ("two words",), ("",)], "t string")
    toks = df.select(F.filter(F.split(F.lower("t"), r"[^\p{L}\p{N}]+"), lambda x: x != "").alias("w"))
    got = [sorted(r.s) for r in toks.select(word_shingles(F.col("w")).alias("s")).collect()]
    assert got == [["cat sat on", "the cat sat"], ["two words"], []]


def test_features_are_distinct_hashes(spark):
    df = spark.createDataFrame([(1, "a b c a b c")], "id long, t string")
    f = with_features(df, "t", "shingles", keep=["id"]).first().f
    assert len(f) == len(set(f)) == 3  # "a b c", "b c a", "c a b"


def test_combined_text_nested_columns(spark):
    df = spark.sql("SELECT 1L AS id, map('k', 1) AS m, named_struct('a', 2, 'b', 'x') AS s, array(1, 2) AS a,"
                   " CAST(NULL AS ARRAY<STRING>) AS n")
    assert with_combined_text(df, ["id"]).first().combined_data == '{"k":1},{"a":2,"b":"x"},1,2'
    assert with_combined_text(df, ["id"], null_marker="-").first().combined_data == '{"k":1},{"a":2,"b":"x"},1,2,-'
