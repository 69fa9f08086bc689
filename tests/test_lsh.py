import numpy as np
import pytest
from pyspark.sql import functions as F

from twinsift.operators.knn import sparse_cosine_topk
from twinsift.operators.lsh import hyperplane_bands, hyperplane_rows, hyperplane_topk, minhash_topk, packed_bits

from paths import SF0001


def _doc_texts(spark):
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    return d.select(F.col("doc_id").alias("id"), F.concat_ws(",", "text", "lang").alias("text"))


def test_minhash_scores_are_exact_and_recall_is_high(spark):
    texts = _doc_texts(spark)
    n = texts.count()
    full = {(r.original_id, r.potential_duplicate_id): r.search_score
            for r in sparse_cosine_topk(texts, "id", "text", n).collect()}
    exact = {(r.original_id, r.potential_duplicate_id): r.search_score
             for r in sparse_cosine_topk(texts, "id", "text", 3).collect()}
    approx = {(r.original_id, r.potential_duplicate_id): r.search_score
              for r in minhash_topk(texts, "id", "text", 3).collect()}
    # every LSH pair is one of the exact pairs, with its exact score
    assert set(approx) <= set(full)
    assert all(abs(full[p] - s) < 1e-9 for p, s in approx.items())
    high = [p for p, s in exact.items() if s >= 0.8]
    found = sum(1 for p in high if p in approx)
    assert high and found / len(high) >= 0.9


@pytest.mark.parametrize("collapse", [True, False])
def test_minhash_hot_bucket(spark, collapse):
    rows = [(i, "the very same document text body") for i in range(60)] + [(100, "another thing entirely else")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = minhash_topk(df, "id", "text", 2, block_rows=8, collapse_copies=collapse).collect()
    per = {}
    for r in got:
        per.setdefault(r.original_id, []).append(r.potential_duplicate_id)
    assert len(per) == 60 and per[0] == [1, 2] and per[59] == [0, 1]


def test_hyperplane_lsh_subset_with_exact_scores(spark):
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    rows = emb.orderBy("vec_id").collect()
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    cos = m @ m.T
    np.fill_diagonal(cos, -1)
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = hyperplane_topk(emb, "vec_id", "embedding", 3).collect()
    assert got and all(r.original_id != r.potential_duplicate_id for r in got)
    found = set()
    for r in got:
        i, j = at[r.original_id], at[r.potential_duplicate_id]
        assert abs(max(0.0, cos[i, j]) - r.search_score) < 1e-6
        found.add((i, j))
    best = {(i, j) for i in range(len(rows)) for j in np.argsort(-cos[i])[:3]}
    assert len(best & found) >= 0.9 * len(best)


def test_hyperplane_work_grows_with_the_rows():
    # bits follow the rows: about the same number of random rows a bucket
    for n in (10**3, 10**6, 10**9):
        assert 4 <= n / 2 ** hyperplane_rows(n) <= 16


@pytest.mark.parametrize("n", [10**5, 10**7])
def test_hyperplane_recall_holds_at_the_bits_of_many_rows(n):
    rng = np.random.default_rng(4)
    a, b = rng.standard_normal((2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.8 * a + 0.6 * b / np.linalg.norm(b, axis=1, keepdims=True)  # cosine 0.8
    rows = hyperplane_rows(n)
    bands = hyperplane_bands(rows)
    same = (packed_bits(a, bands, rows) == packed_bits(b, bands, rows)).any(axis=1)
    assert same.mean() >= 0.88  # 0.9 less nearly four standard errors
    assert hyperplane_bands(hyperplane_rows(1000)) == 48


def test_minhash_collapse_equals_plain(spark):
    rows = [(i, "the very same document text body") for i in range(0, 90, 3)]
    rows += [(i, f"some words {i % 7} and more words {i % 5}") for i in range(1, 90) if i % 3]
    df = spark.createDataFrame(rows, "id long, text string")
    key = lambda r: (r.original_id, r.potential_duplicate_id, r.search_score)
    a = sorted(map(key, minhash_topk(df, "id", "text", 3, collapse_copies=True).collect()))
    b = sorted(map(key, minhash_topk(df, "id", "text", 3, collapse_copies=False).collect()))
    assert a == b and len(a) > 0


def test_small_buckets_of_a_pack_are_scored_together():
    """A pair in several buckets is scored once, with the scores and ranks of
    the buckets one by one."""
    import numpy as np
    import pandas as pd

    from twinsift.operators import tiles

    rng = np.random.default_rng(4)
    feats = {i: np.sort(rng.choice(30, rng.integers(0, 12), replace=False)) for i in range(60)}
    rows = [(g, int(i)) for g in range(50) for i in rng.choice(60, rng.integers(1, 10), replace=False)]
    rows += [(g + 100, i) for g, i in rows[:60]]  # the same buckets of another band
    pdf = pd.DataFrame([(g, i, feats[i], -1, -1, -1) for g, i in rows], columns=["grp", "id", "f", "_b", "_ti", "_tj"]).sample(frac=1, random_state=1)
    got = tiles._bucket_function("binary_cosine", 2)(pdf)
    want = {}
    for g in set(pdf["grp"]):
        ids = [i for h, i in rows if h == g]
        for a in ids:
            for b in ids:
                if a != b and (c := len(np.intersect1d(feats[a], feats[b]))):
                    want.setdefault(a, {})[b] = c / np.sqrt(len(feats[a]) * len(feats[b]))
    best = lambda scores: sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:2]
    found = {a: dict(zip(g["potential_duplicate_id"], g["score"])) for a, g in got.groupby("original_id")}
    assert {a: best(x) for a, x in found.items()} == {a: best(x) for a, x in want.items()}
    assert len(got) < len(tiles._few_rows(pdf.reset_index(drop=True), 10 ** 6)) + 10 ** 4 and len(tiles._few_rows(pdf.iloc[:0], 2)) == 0
    small = pdf[pdf.groupby("grp")["id"].transform("size") <= tiles.FEW_ROWS].reset_index(drop=True)
    assert not tiles._few_rows(small, 100).duplicated(["original_id", "potential_duplicate_id"]).any()
