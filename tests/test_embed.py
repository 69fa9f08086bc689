import numpy as np
from pyspark.sql import functions as F

from twinsift.config import EntitySpec
from twinsift.functions.vectorize import embed
from twinsift.operators.candidates import detect_candidates

from paths import SF0001


def test_hash_embed_is_deterministic_and_normalised(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, "hello world"), (3, ""), (4, None)], "id long, t string")
    rows = {r.id: r.embedding for r in embed(df, "t").collect()}
    a, b = np.array(rows[1]), np.array(rows[2])
    assert len(a) == 64 and abs(np.linalg.norm(a) - 1) < 1e-5
    assert np.allclose(a, b)  # lower-cased first
    assert not np.any(rows[3]) and not np.any(rows[4])
    again = {r.id: r.embedding for r in embed(df, "t").collect()}
    assert all(np.allclose(rows[k], again[k]) for k in rows)


def test_dense_detect_matches_numpy(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    spec = EntitySpec("documents", "doc_id", ("doc_id", "source", "n_chars"))
    got = detect_candidates(docs, spec, 2, method="dense").collect()
    emb = embed(docs.select("doc_id", F.concat_ws(",", "text", "lang").alias("t")), "t").orderBy("doc_id").collect()
    ids = np.array([r.doc_id for r in emb])
    m = np.array([r.embedding for r in emb], dtype=np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1
    s = np.clip((m / n) @ (m / n).T, 0, 1)
    np.fill_diagonal(s, -1)
    for r in got:
        i = int(np.where(ids == r.original_id)[0][0])
        j = int(np.where(ids == r.potential_duplicate_id)[0][0])
        assert abs(round(s[i, j], 6) - r.search_score) < 2e-6
        assert r.search_score >= np.sort(s[i])[-2] - 2e-6
