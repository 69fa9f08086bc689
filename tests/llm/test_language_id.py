import numpy as np
import pytest
from pyspark.sql import functions as F

from twinsift.llm import language_id as L
from twinsift.llm import queries

DOC = "doc_id long, text string, lang string"


def test_weighted_vectors_by_hand():
    a, b = L.gram_counts("Ab ab"), L.gram_counts("ab, AB!")
    assert (a == b).all() and L.gram_counts("123 .") is None and L.gram_counts("") is None and L.gram_counts(None) is None
    assert a.sum() == 7 + 6 + 5  # _ab_ab_ has 7 marks and letters
    idf = np.linspace(1, 2, L.FEATURES).astype(np.float32)
    w = L.weighted(a[None, :], idf)[0]
    x = np.where(a > 0, 1 + np.log(np.maximum(a, 1)), 0) * idf
    np.testing.assert_allclose(w, x / np.linalg.norm(x), rtol=1e-5)


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert r[0] >= 0.95 and r[1] > 200
    assert got.count() == 1000 and got.where("score < 0 or score > 1").count() == 0


def test_edge_rows_and_rejection(spark, frame):
    rows = [(i, t * 20, l) for i, (t, l) in enumerate([("the cat and the dog ", "en"), ("le chat et la souris ", "fr")] * 15)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "12 34 !", "en"), (103, "x", None), (0, "the cat and the dog ", "en"), (None, "le chat", "fr")]
    docs = frame(rows, DOC)
    model = L.fit(docs)
    out = {(r["doc_id"], r["nearest"], r["rejected"], r["lang"]) for r in L.predict(docs, model).collect()}
    assert {(100, "und", False, "und"), (101, "und", False, "und"), (102, "und", False, "und"), (0, "en", False, "en")} <= out
    far = frame([(1, "щука плывёт под водой " * 20, None)], DOC)
    r = L.predict(far, model).first()
    assert r["rejected"] and r["lang"] == "und" and r["nearest"] in ("en", "fr")


def test_empty_and_nothing_to_learn(spark, frame):
    empty = frame([], DOC)
    model = L.fit(empty)
    assert L.predict(empty, model).count() == 0
    assert L.predict(frame([(1, "some text", None)], DOC), model).first()["nearest"] == "und"


def test_no_language_is_dropped_silently(spark, frame, monkeypatch):
    rows = [(i, f"some words of language {i % 3}", f"l{i % 3}") for i in range(30)]
    df = frame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    assert set(L.fit(df)["langs"]) == {"l0", "l1", "l2"}
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="MAX_LANGUAGES"):
        L.fit(df)
