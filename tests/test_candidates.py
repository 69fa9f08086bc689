import math

import pytest

import numpy as np
from pyspark.sql import functions as F

from twinsift.config import EntitySpec
from twinsift.operators.candidates import best_k, detect_candidates, similarity_pairs
from twinsift.operators.knn import dense_knn_topk, sparse_cosine_topk
from twinsift.operators.tiles import tiled_topk

from paths import SF0001


def _brute_topk(feats: dict, k: int):
    """Reference: all pairs by plain Python, same rounding and tie rule."""
    out = {}
    for a, fa in feats.items():
        sc = []
        for b, fb in feats.items():
            if a == b:
                continue
            c = len(fa & fb)
            if c:
                sc.append((-round(c / math.sqrt(len(fa) * len(fb)) + 1e-12, 6), b))
        out[a] = [b for _, b in sorted(sc)[:k]]
    return out


def test_no_self_pairs_and_at_most_k(spark):
    rows = [(i, "alpha beta gamma delta") for i in range(6)] + [(9, "other words here now")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = sparse_cosine_topk(df, "id", "t", 3).collect()
    assert all(r.original_id != r.potential_duplicate_id for r in got)
    per = {}
    for r in got:
        per.setdefault(r.original_id, []).append(r.potential_duplicate_id)
    assert all(len(v) == 3 for k, v in per.items() if k < 6)
    # equal scores: the smallest other ids win, whatever k is
    assert sorted(per[5]) == [0, 1, 2] and sorted(per[0]) == [1, 2, 3]
    assert 9 not in per  # shares no shingle


def test_short_rows_find_their_exact_copies(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "x y"), (3, "p q r"), (4, "p q r"), (5, "10,20"), (6, "10,20"), (7, "one"),
                                (8, "One!"), (9, ""), (10, ""), (11, None), (12, "b a")], "id long, t string")
    for collapse in (True, False):
        got = sorted((r.original_id, r.potential_duplicate_id, r.search_score)
                     for r in sparse_cosine_topk(df, "id", "t", 3, collapse_copies=collapse).collect())
        # texts without a word overlap with nothing
        assert got == [(3, 4, 1.0), (4, 3, 1.0), (5, 6, 1.0), (6, 5, 1.0), (7, 8, 1.0), (8, 7, 1.0)]


def test_repeated_keys_are_one_record(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (2, "zz"), (3, "a b c x"), (4, "q r s t")], "id long, text string")
    got = sorted((r.original_id, r.potential_duplicate_id) for r in similarity_pairs(df, 2, "exact").collect())
    assert got == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]


def test_decimal_keys_tie_by_value(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal(i), "x y z") for i in range(1, 13)], "id decimal(10,0), t string")
    for collapse in (True, False):
        got = {int(r.original_id): int(r.potential_duplicate_id)
               for r in sparse_cosine_topk(df, "id", "t", 1, collapse_copies=collapse, block_rows=5).collect()}
        assert got == {1: 2} | {i: 1 for i in range(2, 13)}


def test_own_vectors_reach_detection(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [1.0, 0.1]), (3, "c", [0.0, 1.0])], "id long, t string, v array<double>")
    spec = EntitySpec("t", "id", ("id",), vector_column="v")
    got = {r.original_id: (r.potential_duplicate_id, r.original_combined_data) for r in detect_candidates(df, spec, 1, "dense").collect()}
    assert got == {1: (2, "a"), 2: (1, "b"), 3: (2, "c")}
    from pyspark.sql import functions as G
    same = detect_candidates(df.drop("v"), EntitySpec("t", "id", ("id",)), 1, "dense", embed_fn=lambda c: G.array(G.length(c).cast("double"), G.lit(1.0)))
    assert same.count() == 3


def test_collapse_equals_plain_tiles(spark):
    part = spark.read.parquet(f"{SF0001}/part.parquet")
    texts = part.select(F.col("p_partkey").alias("id"), F.concat_ws(",", "p_name", "p_type").alias("t"))
    key = lambda r: (r.original_id, r.potential_duplicate_id, r.search_score)
    a = sorted(map(key, sparse_cosine_topk(texts, "id", "t", 3, mode="tokens").collect()))
    b = sorted(map(key, sparse_cosine_topk(texts, "id", "t", 3, mode="tokens", collapse_copies=False).collect()))
    assert a == b and len(a) > 0


def test_tie_on_score_lower_partner_id(spark):
    df = spark.createDataFrame([(1, "x y z"), (3, "x y z"), (2, "x y z")], "id long, t string")
    got = {r.original_id: r.potential_duplicate_id for r in sparse_cosine_topk(df, "id", "t", 1).collect()}
    assert got == {1: 2, 2: 1, 3: 1}


def test_exact_topk_matches_brute_force_and_block_size(spark):
    part = spark.read.parquet(f"{SF0001}/part.parquet")
    texts = part.select(F.col("p_partkey").alias("id"),
                        F.concat_ws(",", "p_name", "p_brand", "p_type", "p_size").alias("t"))
    one = sparse_cosine_topk(texts, "id", "t", 3, mode="tokens").collect()
    many = sparse_cosine_topk(texts, "id", "t", 3, mode="tokens", block_rows=17).collect()
    key = lambda r: (r.original_id, r.potential_duplicate_id, r.search_score)
    assert sorted(map(key, one)) == sorted(map(key, many))
    import re
    feats = {r.id: set(x for x in re.split(r"[^a-z0-9#]+", r.t.lower()) if x) for r in texts.collect()}
    brute = _brute_topk(feats, 3)
    got = {}
    for r in sorted(one, key=lambda r: (r.original_id, -r.search_score, r.potential_duplicate_id)):
        got.setdefault(r.original_id, []).append(r.potential_duplicate_id)
    assert got == {a: b for a, b in brute.items() if b}


@pytest.mark.parametrize("collapse", [True, False])
def test_hot_copy_cluster_is_split_into_bounded_tiles(spark, collapse):
    # a third of the rows are one text; the plan must still give every row
    # its k smallest-id copies, computed in tiles of at most 2 * block_rows
    rows = [(i, "same old record text here") for i in range(0, 300, 3)]
    rows += [(i, f"unique {i} words {i * 7} and {i * 13}") for i in range(1, 300) if i % 3]
    df = spark.createDataFrame(rows, "id long, t string")
    got = sparse_cosine_topk(df, "id", "t", 3, block_rows=32, collapse_copies=collapse).where(
        "original_id % 3 = 0").collect()
    per = {}
    for r in got:
        per.setdefault(r.original_id, []).append((r.potential_duplicate_id, r.search_score))
    assert len(per) == 100
    for o, lst in per.items():
        expect = [i for i in (0, 3, 6, 9) if i != o][:3]
        assert sorted(p for p, _ in lst) == expect and all(s == 1.0 for _, s in lst)


def test_plan_has_no_cartesian_product(spark):
    df = spark.createDataFrame([(i, f"a b c {i}") for i in range(20)], "id long, t string")
    plan = sparse_cosine_topk(df, "id", "t", 3, collapse_copies=False)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "FlatMapGroupsInPandas" in plan or "FlatMapGroupsInArrow" in plan


def test_dense_knn_against_numpy(spark):
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    got = dense_knn_topk(emb, "vec_id", "embedding", 3, block_rows=40).collect()
    rows = emb.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = np.clip(m @ m.T, 0, 1)
    np.fill_diagonal(s, -1)
    for r in got[:50]:
        i = int(np.where(ids == r.original_id)[0][0])
        j = int(np.where(ids == r.potential_duplicate_id)[0][0])
        assert abs(s[i, j] - r.search_score) < 1e-6
        assert r.search_score >= np.sort(s[i])[-3] - 1e-6


def test_detect_candidates_schema(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    spec = EntitySpec("documents", "doc_id", ("doc_id", "source", "n_chars"))
    c = detect_candidates(docs, spec, 3)
    assert c.columns == ["original_id", "original_combined_data", "potential_duplicate_id",
                         "potential_duplicate_combined_data", "search_score"]
    assert c.count() == 482  # documents sf0.001, k = 3


def test_best_k_string_keys(spark):
    pairs = spark.createDataFrame([("a", "10", 0.5), ("a", "9", 0.5), ("a", "b", 0.4)],
                                  "original_id string, potential_duplicate_id string, score double")
    got = [r.potential_duplicate_id for r in best_k(pairs, 2).orderBy("potential_duplicate_id").collect()]
    assert got == ["10", "9"]


def test_tiled_queries_vs_corpus(spark):
    q = spark.createDataFrame([(1, [1, 2, 3])], "id long, f array<bigint>")
    c = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2]), (3, [7])], "id long, f array<bigint>")
    got = tiled_topk(q, "binary_cosine", 5, right=c, exclude_same_id=False).collect()
    assert sorted((r.potential_duplicate_id, round(r.score, 6)) for r in got) == [(1, 1.0), (2, 0.816497)]
