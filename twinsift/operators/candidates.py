"""Top-k merge (W1), candidate shaping (P4, J7) and detection (C1, C2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.config import COMBINED_COLUMN, DEFAULT_NUM_RESULTS, EntitySpec
from twinsift.functions.text import with_combined_text

CANDIDATE_COLUMNS = ["original_id", "original_combined_data", "potential_duplicate_id",
                     "potential_duplicate_combined_data", "search_score"]


def best_k(pairs: DataFrame, k: int, score_col: str = "score", out_col: str = "search_score",
           keep_rank: bool = False) -> DataFrame:
    """Best ``k`` partners per original: score rounded to 6 decimals, ties by
    the smaller partner id. Written as ``row_number() <= k`` so Spark plans a
    partial ``WindowGroupLimit`` before the shuffle."""
    scored = pairs.withColumn(out_col, F.round(F.col(score_col), 6))
    w = Window.partitionBy("original_id").orderBy(F.desc(out_col), F.asc("potential_duplicate_id"))
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    cols = ["original_id", "potential_duplicate_id", out_col] + (["rank"] if keep_rank else [])
    return ranked.select(*cols)


def attach_texts(top: DataFrame, texts: DataFrame, k: int = DEFAULT_NUM_RESULTS, n_rows: int | None = None) -> DataFrame:
    """J7: both texts joined *after* top-k, so text never rides through the
    pair computation. ``texts`` is (id, text).

    An original appears at most k times, but one partner may be named by a
    third of the table (the smallest id of a big copy cluster), so the
    partner-side join is skew-safe: that partner's text is replicated to a
    few salted tasks instead of all its rows meeting in one.
    """
    from twinsift.operators.tiles import skew_join
    from twinsift.sources.tables import materialize

    n = n_rows if n_rows is not None else texts.count()
    top = materialize(top)  # thin (N * k rows); read by the key counts and the join
    o = texts.select(F.col("id").alias("original_id"), F.col("text").alias("original_combined_data"))
    p = texts.select(F.col("id").alias("potential_duplicate_id"),
                     F.col("text").alias("potential_duplicate_combined_data"))
    with_o = top.join(o, "original_id")
    counts = top.groupBy("potential_duplicate_id").agg(F.count(F.lit(1)).alias("_n"))  # on the thin rows
    return skew_join(with_o, p, "potential_duplicate_id", n * k, salt_by="original_id",
                     counts=counts).select(*CANDIDATE_COLUMNS)


def unique_keys(texts: DataFrame) -> DataFrame:
    """One row a key: of rows that repeat it, the one with the smallest text
    (NULL only if all are). Only the keys are counted; texts of keys that do
    not repeat are not shuffled."""
    from twinsift.sources.tables import materialize

    again = materialize(texts.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"))
    if again.isEmpty():
        return texts
    least = texts.join(again, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return texts.join(again, "id", "left_anti").select("id", "text").unionByName(least)


def similarity_pairs(texts: DataFrame, k: int, method: str = "exact", text_mode: str = "shingles",
                     block_rows: int | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """(original_id, potential_duplicate_id, search_score), best k per original.

    ``texts`` is (id, text). Methods: exact (sparse cosine over features),
    dense (cosine of hashed embeddings, or of ``vectors`` (id, vec) if given),
    hybrid (rank fusion of exact cosine and BM25, cosine reported),
    minhash / lsh (approximate candidates for features / vectors, exact
    cosine). The method is the caller's choice at every size. Rows that repeat
    a key are one record (``unique_keys``). Every method reports a score in [0, 1], 1 = identical.
    """
    return _pairs(unique_keys(texts), k, method, text_mode, block_rows, vectors)


def _pairs(texts: DataFrame, k: int, method: str, text_mode: str, block_rows: int | None, vectors: DataFrame | None) -> DataFrame:
    """``similarity_pairs`` of texts with one row a key."""
    from twinsift.operators import hybrid, knn, lsh

    if method == "exact":
        return knn.sparse_cosine_topk(texts, "id", "text", k, mode=text_mode, block_rows=block_rows)
    if method == "dense":
        vecs = vectors if vectors is not None else knn.embedded(texts, "id", "text")
        return knn.dense_knn_topk(vecs, "id", "vec", k, block_rows=block_rows)
    if method == "hybrid":
        return hybrid.hybrid_topk(texts, "id", "text", k, text_mode=text_mode, block_rows=block_rows).drop("rrf_score")
    if method == "minhash":
        return lsh.minhash_topk(texts, "id", "text", k, mode=text_mode)
    if method == "lsh":
        vecs = vectors if vectors is not None else knn.embedded(texts, "id", "text")
        return lsh.hyperplane_topk(vecs, "id", "vec", k)
    raise ValueError(f"unknown method {method!r}")


def similarity_topk(df: DataFrame, primary_key: str, text_col: str = COMBINED_COLUMN,
                    k: int = DEFAULT_NUM_RESULTS, method: str = "exact", text_mode: str = "shingles",
                    block_rows: int | None = None, vectors: DataFrame | None = None, vector_col: str | None = None,
                    embed_fn=None) -> DataFrame:
    """C2: candidate records for a table that already has a text column.

    Own embeddings for the methods dense and lsh: a table ``vectors`` (id,
    vec), a column ``vector_col`` of ``df``, or ``embed_fn``, any Column ->
    Column over the text."""
    texts = unique_keys(df.select(F.col(primary_key).alias("id"), F.col(text_col).alias("text"))
                        .where(F.col("id").isNotNull()))
    if vectors is None and vector_col is not None:
        vectors = df.select(F.col(primary_key).alias("id"), F.col(vector_col).alias("vec")).where(F.col("id").isNotNull())
    if vectors is None and embed_fn is not None:
        vectors = texts.select("id", embed_fn(F.col("text")).alias("vec"))
    top = _pairs(texts, k, method, text_mode, block_rows, vectors)
    return attach_texts(top, texts, k)


def detect_candidates(df: DataFrame, spec: EntitySpec, k: int = DEFAULT_NUM_RESULTS, method: str = "exact",
                      block_rows: int | None = None, vectors: DataFrame | None = None, embed_fn=None) -> DataFrame:
    """C1: combined text -> best k other records -> five-column candidates.
    The entity's ``vector_column`` is no part of the text."""
    exclude = [*spec.exclude, *([spec.vector_column] if spec.vector_column and spec.vector_column not in spec.exclude else [])]
    silver = with_combined_text(df, exclude)
    return similarity_topk(silver, spec.primary_key, COMBINED_COLUMN, k, method, spec.text_mode, block_rows, vectors,
                           spec.vector_column, embed_fn)
