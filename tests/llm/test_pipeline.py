import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from twinsift.llm import common, decontaminate, mixing, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The tables before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.stored(stage(spark, out[-1], SF), "test-" + name.replace(" ", "-")))
    return [t.cache() for t in out]


def rows(t):
    return sorted(tuple(r) for r in t.select(*COLUMNS).collect())


def test_documents_come_out_whole(stages):
    whole = set(rows(stages[0]))
    for t in stages[1:-1]:
        assert t.columns == COLUMNS and set(rows(t)) <= whole
    assert 0 < len(rows(stages[3])) < len(rows(stages[2])) < len(rows(stages[0]))


def test_toxicity(spark, stages):
    model = toxicity.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    gone = {r["doc_id"] for r in toxicity.scored(stages[0], model).where("toxicity >= 0.5").collect()}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] not in gone]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(gone & toxic) <= 1


def test_one_of_each_group(stages):
    fp = {r[0]: simhash.fingerprint(r[1]) for r in rows(stages[1])}
    group = {i: i for i in fp}
    for i in sorted(fp):  # repeated passes over all pairs: the smallest id wins
        for j in sorted(fp):
            if (fp[i] ^ fp[j]).bit_count() <= simhash.MAX_BITS:
                a, b = group[i], group[j]
                for k in fp:
                    if group[k] in (a, b):
                        group[k] = min(a, b)
    assert rows(stages[2]) == [r for r in rows(stages[1]) if group[r[0]] == r[0]]


def test_benchmark(spark, stages):
    found = {r["doc_id"] for r in decontaminate.contaminated(stages[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {r[0] for r in rows(stages[2]) if any(t in r[1] for t in items)}
    assert whole <= found and rows(stages[3]) == [r for r in rows(stages[2]) if r[0] not in found]


def test_mix(stages):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(stages[3]).collect()}
    assert rows(stages[4]) == sorted(r for r in rows(stages[3]) for _ in range(copies[r[0]]))


def test_tokens(stages):
    t, want, start = Tokenizer.from_file(queries.word_tokenizer()), [], 0
    for r in rows(stages[4]):
        ids = t.encode(r[1], add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in stages[5].orderBy("start").collect()] == want


def test_repeated_rows_nulls_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).unionByName(spark.createDataFrame(
        [(1, "one text of its own", "en", "a", 1), (1, "one text of its own", "en", "a", 1), (2, None, None, None, None),
         (3, "", "en", "a", 0), (None, "no id here", "en", "b", 3)], spark.read.parquet(f"{SF}/documents.parquet").schema))
    docs = docs.withColumn("score", F.lit(1)).withColumn("toxicity", F.lit("a")).withColumn("copies", F.lit(2))
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF), "edge")
        if name == "simhash near-dedup":
            assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "None"]
        if out.columns == docs.columns:
            assert out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "none")
        assert docs.count() == 0
        if docs.columns != COLUMNS:
            break


def test_decisions_are_by_row(spark):
    """Copies without an id go, a different text under a repeated id stays,
    contaminated rows without an id go."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    own = ["a lone grey heron waits by the still water of the old mill", "nobody counted seven brass buttons under that creaking stair"]
    docs = spark.createDataFrame([(5, own[0], "en", "a", 1), (5, own[1], "en", "a", 1), (9, own[1], "en", "a", 1),
                                  (None, own[0], "en", "a", 1), (None, item, "en", "a", 1), (None, item, "en", "a", 1)], table.schema)
    once = common.stored(corpus_pipeline.one_of_each_group(spark, docs, SF), "by-row")
    assert sorted(map(str, (tuple(r)[:2] for r in once.collect()))) == sorted(map(str, [(5, own[0]), (5, own[1]), (None, item)]))
    # Word weights come from the table: it is searched with them.
    more = once.unionByName(table.where("doc_id > 50"))
    left = corpus_pipeline.benchmark_out(spark, more, SF).where("doc_id is null or doc_id = 5").collect()
    assert sorted(r["text"] for r in left) == sorted(own)
