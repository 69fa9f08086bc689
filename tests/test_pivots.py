"""Dense top-k over pivot partitions against all pairs in tiles."""

import numpy as np
import pytest

from twinsift.operators import pivots
from twinsift.operators.knn import dense_knn_topk
from paths import SF0001


def _frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], f"id {'string' if isinstance(next(iter(ids)), str) else 'long'}, vec array<double>")


def _key(df):
    return sorted((r.original_id, r.potential_duplicate_id, r.search_score) for r in df.collect())


def _clusters(seed, n, dim=12, spread=0.08, centres=10):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("k", [1, 3])
def test_equals_all_pairs(spark, k):
    x = _clusters(k, 400)
    x[:130] = x[0]  # a third are copies
    x[200:205] = 0
    df = _frame(spark, x)
    assert _key(dense_knn_topk(df, "id", "vec", k, 24, "pivots")) == _key(dense_knn_topk(df, "id", "vec", k, plan="tiles"))


def test_random_vectors_strings_few_rows_and_empty(spark):
    x = np.random.default_rng(5).normal(size=(90, 6))
    df = _frame(spark, x, [f"r{i}" for i in range(90)])
    assert _key(dense_knn_topk(df, "id", "vec", 3, 20, "pivots")) == _key(dense_knn_topk(df, "id", "vec", 3, plan="tiles"))
    for some in (df.limit(2), df.limit(1), df.limit(0)):
        assert _key(dense_knn_topk(some, "id", "vec", 3, 20, "pivots")) == _key(dense_knn_topk(some, "id", "vec", 3, plan="tiles"))
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    assert _key(dense_knn_topk(emb, "vec_id", "embedding", 3, 64, "pivots")) == _key(dense_knn_topk(emb, "vec_id", "embedding", 3, plan="tiles"))


def test_most_block_pairs_of_clusters_are_skipped(spark, monkeypatch):
    seen = {}
    kept = pivots.kept_pairs

    def counting(blocks, bars, n):
        out = kept(blocks, bars, n).checkpoint()
        seen.update(n=n, kept=out.count())
        return out

    monkeypatch.setattr(pivots, "kept_pairs", counting)
    x = _clusters(9, 1500, dim=16, spread=0.03)
    df = _frame(spark, x)
    assert _key(dense_knn_topk(df, "id", "vec", 3, 64, "pivots")) == _key(dense_knn_topk(df, "id", "vec", 3, plan="tiles"))
    every = seen["n"] * (seen["n"] - 1) / 2
    print("kept", seen["kept"], "of", every)
    assert seen["kept"] < 0.3 * every


def test_groups_of_blocks_meet_in_rounds(spark, monkeypatch):
    """A few copies of the blocks are sent at once; the rows stay the same."""
    sent = []
    store = pivots.store
    monkeypatch.setattr(pivots, "release_shuffles", lambda spark: None)
    monkeypatch.setattr(pivots, "store", lambda df, path: sent.append(path) or store(df, path))
    monkeypatch.setattr(pivots, "ROUND_BLOCKS", 0)
    monkeypatch.setattr(pivots, "GROUPS", 5)
    monkeypatch.setattr(pivots, "COPIES", 2)
    x = np.random.default_rng(8).normal(size=(330, 5))
    x[:40] = x[0]
    df = _frame(spark, x)
    assert _key(dense_knn_topk(df, "id", "vec", 3, 24, "pivots")) == _key(dense_knn_topk(df, "id", "vec", 3, plan="tiles"))
    assert len(sent) >= 3 and len(set(sent)) == 1
