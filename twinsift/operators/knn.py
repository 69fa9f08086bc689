"""Exact k-nearest neighbours: sparse token cosine (J6) and dense vectors (J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.functions.vectorize import binary_features, hash_embed
from twinsift.operators.candidates import best_k
from twinsift.operators.tiles import DEFAULT_BLOCK_ROWS, text_size_hint, tiled_topk
from twinsift.sources.tables import ensure_parallel, materialize


def sparse_cosine_topk(df: DataFrame, id_col: str, text_col: str, k: int, mode: str = "shingles",
                       block_rows: int | None = None, collapse_copies: bool = True, plan: str = "prefix") -> DataFrame:
    """Best k other rows by cosine of binary feature sets, |A∩B| / sqrt(|A||B|).

    Pairs sharing no feature are no candidates. Exact, without a frequency
    cap: by the prefix-filtered inverted join (``operators/prefix.py``), or
    with ``plan="tiles"`` by scoring every pair of rows in some tile.
    Rows with identical feature sets are scored once
    (``operators/copies.py``), which keeps a huge group of copies linear;
    without ``collapse_copies`` the result is the same.
    """
    from twinsift.operators.copies import topk_with_copies_collapsed
    from twinsift.operators.prefix import prefix_topk

    if plan not in ("prefix", "tiles"):
        raise ValueError(f"unknown plan {plan!r}")
    feats = binary_features(df, id_col, text_col, mode)
    if plan == "prefix":
        if not collapse_copies:
            return prefix_topk(materialize(feats), k, block_rows=block_rows)
        return topk_with_copies_collapsed(feats, k, lambda reps, kk, done: prefix_topk(reps, kk, block_rows=block_rows, done=done))
    hint = text_size_hint(df.where(df[id_col].isNotNull()), text_col)
    if not collapse_copies:
        return best_k(tiled_topk(feats, "binary_cosine", k, block_rows=block_rows, left_hint=hint), k)

    def inner(reps: DataFrame, kk: int, _done) -> DataFrame:
        return best_k(tiled_topk(reps, "binary_cosine", kk, block_rows=block_rows, left_hint=(reps.count(), hint[1])), kk)

    return topk_with_copies_collapsed(feats, k, inner)


def embedded(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, vec) with the default hashed embedding of a text column."""
    rows = ensure_parallel(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
                           .where(F.col("id").isNotNull()))
    return rows.select("id", hash_embed(F.col("_text")).alias("vec"))


SMALL_BLOCKS = 8


def dense_knn_topk(df: DataFrame, id_col: str, vec_col: str, k: int, block_rows: int | None = None, plan: str | None = None) -> DataFrame:
    """Best k other rows by cosine of dense vectors, clamped to [0, 1].

    ``plan``: "pivots" (``operators/pivots.py``) leaves out pairs of blocks that
    cannot hold a partner, "tiles" scores all pairs. The rows are the same. By
    default tiles where all rows fit into ``SMALL_BLOCKS`` blocks, which costs
    less than making the partitions, else pivots."""
    from twinsift.operators.pivots import pivot_topk

    if plan not in (None, "pivots", "tiles"):
        raise ValueError(f"unknown plan {plan!r}")
    vecs = (df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull()))
    n = vecs.count()  # column-pruned scan of the key only
    if plan == "pivots" or plan is None and n > SMALL_BLOCKS * DEFAULT_BLOCK_ROWS:
        return pivot_topk(vecs, k, n, block_rows)
    return best_k(tiled_topk(vecs, "dense_cosine", k, block_rows=block_rows, left_hint=(n, 1.0)), k)
