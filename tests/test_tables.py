"""Vector table, typed load, comments, rules in one scan, merged statistics."""

import datetime
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinsift.functions import vectorize
from twinsift.operators import analyze, quality
from twinsift.sources import schemas
from twinsift.sources.tables import column_comments, write_overwrite
from twinsift.sources.vector_table import VectorTable


def test_unchanged_texts_are_not_embedded_again(spark, scratch):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]
        return model

    fn = vectorize.model_embedder(load)
    rows = [(1, "a"), (2, "bb"), (3, "a"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    table = VectorTable(spark, f"{scratch}/vectors", "lengths")
    assert table.sync(df, fn) == 3 and calls.value == 3  # "a" once, null as empty
    assert table.sync(df, fn) == 0 and calls.value == 3
    more = df.unionByName(spark.createDataFrame([(6, "ccc")], df.schema))
    assert table.sync(more, fn) == 1 and calls.value == 4
    got = {r.id: list(r.vec) for r in table.vectors(more).collect()}
    assert got == {1: [1, 1], 2: [2, 1], 3: [1, 1], 4: [0, 1], 5: [0, 1], 6: [3, 1]}
    assert VectorTable(spark, f"{scratch}/vectors", "other").sync(df, fn) == 3  # another model has its own rows


def test_model_by_name_is_loaded_once_a_task(spark):
    module = types.ModuleType("some_local_model")
    module.load = lambda: (lambda texts: np.array([[len(t)] for t in texts]))
    sys.modules["some_local_model"] = module
    fn = vectorize.embedder("hashed-char-ngrams")
    assert fn is vectorize.hash_embed
    with pytest.raises(ValueError, match="no embedding model"):
        vectorize.embedder("unknown")
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda texts: [[1.0] for _ in texts]

    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        df = spark.range(0, 100, 1, 2).select(F.col("id").cast("string").alias("t"))
        assert df.select(vectorize.model_embedder(load)(F.col("t")).alias("v")).collect()[0].v == [1.0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert loads.value == 2  # two tasks, ten batches each


def test_typed_load_reports_bad_cells(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    loose = spark.createDataFrame([("1", "2024-02-29"), ("2", "2023-02-29"), ("x", None), ("3", "2023-02-29"), (None, "")], "id string, day string")
    for _ in range(2):
        bad = schemas.load_table(spark, f"{scratch}/t", loose, schema)
    rows = spark.read.parquet(f"{scratch}/t").collect()
    assert sorted((r.id, r.day) for r in rows if r.id) == [(1, datetime.date(2024, 2, 29)), (2, None), (3, None)] and len(rows) == 5
    assert {(r.column_name, r.value, r.n) for r in bad.collect()} == {("id", "x", 1), ("day", "2023-02-29", 2), ("day", "", 1)}


def test_comments_come_back(spark, scratch):
    write_overwrite(spark.range(3).withColumn("b", F.lit("x")), f"{scratch}/t", comments={"b": "it's b"})
    assert {tuple(r) for r in column_comments(spark, f"{scratch}/t").collect()} == {("id", "bigint", None), ("b", "string", "it's b")}


def test_rules_of_a_table_from_one_scan(spark, scratch):
    rows = [(1, "a", 1), (1, None, 2), (2, "b", 9), (None, "c", None), (None, "c", 9), (3, None, 1)]
    spark.createDataFrame(rows, "k int, name string, parent int").write.parquet(f"{scratch}/child")
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long").write.parquet(f"{scratch}/parent")
    child, parent = spark.read.parquet(f"{scratch}/child"), spark.read.parquet(f"{scratch}/parent")
    out = quality.table_rules(child, ["k", "name", "parent"], "k", [("parent", parent, "id")])
    assert {tuple(r) for r in out.collect()} == {("not_null", "k", 2), ("not_null", "name", 2), ("not_null", "parent", 1),
                                                 ("primary_key", "k", 2), ("foreign_key", "parent", 2)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"Relation [k#") == 1 and plan.count("Relation [id#") == 1
    assert {tuple(r) for r in quality.table_rules(child.limit(0), ["k"], "k", [("parent", parent, "id")]).collect()} == {
        ("not_null", "k", 0), ("primary_key", "k", 0), ("foreign_key", "parent", 0)}
    assert quality.table_rules(child).count() == 0


def test_merged_histograms_equal_the_whole(spark):
    rows = [(i % 40, 100 + i, round((i * 37 % 101) / 100, 6)) for i in range(160)] + [(None, 1, 0.995), (7, 8, 1.0), (9, 8, None)]
    cands = spark.createDataFrame(rows, "original_id long, potential_duplicate_id long, search_score double")
    base = spark.range(57)
    whole = analyze.analyze_candidates(cands, base, "e").collect()
    split = [cands.where(F.coalesce(F.col("original_id"), F.lit(0)) % 3 == i) for i in range(3)]
    bases = [base.where(F.col("id") % 3 == i) for i in range(3)]
    got = analyze.analysis_of_histogram(analyze.merged_histograms(*[analyze.score_histogram(c, b, "e") for c, b in zip(split, bases, strict=True)])).collect()
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in analyze.ANALYSIS_COLUMNS))
    assert sorted(map(key, got)) == sorted(map(key, whole))
    empty = analyze.analysis_of_histogram(analyze.score_histogram(cands.limit(0), base, "e")).collect()
    assert sorted(map(key, empty)) == sorted(map(key, analyze.analyze_candidates(cands.limit(0), base, "e").collect()))
