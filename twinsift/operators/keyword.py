"""Keyword leg (J4): BM25 ranking of a corpus for query texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.functions.text import with_features
from twinsift.functions.vectorize import bm25_index, bm25_query_vectors
from twinsift.operators.candidates import best_k
from twinsift.operators.tiles import skew_join, text_size_hint, tiled_topk
from twinsift.sources.tables import ensure_parallel, materialize


def bm25_topk(queries: DataFrame, query_id: str, query_text: str, docs: DataFrame, doc_id: str, doc_text: str,
              k: int, block_rows: int | None = None, exclude_same_id: bool = False, keep_rank: bool = False,
              self_search: bool = False, plan: str = "tiles") -> DataFrame:
    """Best k documents per query by BM25 over distinct query words.

    Output (original_id = query id, potential_duplicate_id = doc id,
    bm25_score rounded to 6 decimals). Documents sharing no word with the
    query are no candidates. ``plan="tiles"``: sparse dot products of
    idf-weighted query vectors with tf-weighted document vectors, block by
    block, so a stop word in every document never becomes a hot join key; the
    better plan for long queries, and the only one for self-search, where every
    document is a query. ``plan="max_score"``: postings (``max_score_topk``), for
    short queries with rare words, of which few postings are expanded.
    """
    if plan not in ("tiles", "max_score") or self_search and plan != "tiles":
        raise ValueError(f"plan {plan!r} is not possible here")
    if plan == "max_score":
        pairs = max_score_topk(queries, query_id, query_text, docs, doc_id, doc_text, k, exclude_same_id)
        return best_k(pairs, k, out_col="bm25_score", keep_rank=keep_rank)
    q, vectors, q_hint, hint = bm25_sides(queries, query_id, query_text, docs, doc_id, doc_text, self_search)
    pairs = tiled_topk(q, "dot", k, right=vectors, block_rows=block_rows, exclude_same_id=exclude_same_id,
                       left_hint=q_hint, right_hint=hint)
    return best_k(pairs, k, out_col="bm25_score", keep_rank=keep_rank)


def bm25_sides(queries: DataFrame, query_id: str, query_text: str, docs: DataFrame, doc_id: str, doc_text: str, self_search: bool = False):
    """The query and document vectors whose dot product is the BM25 score,
    each with (rows, mean terms)."""
    vectors, doc_freq, n, avgdl = bm25_index(docs, doc_id, doc_text)
    if self_search:
        vectors = materialize(vectors)  # read by the tiles and as the query terms
        q_hint = (n, avgdl)
    else:
        q_hint = text_size_hint(queries.where(queries[query_id].isNotNull()), query_text)
    q = bm25_query_vectors(queries, query_id, query_text, doc_freq, n,
                           n_query_terms=max(1, int(q_hint[0] * q_hint[1])), self_search=self_search,
                           doc_vectors=vectors if self_search else None)
    return q, vectors, q_hint, (n, avgdl)


def bm25_self_topk(texts: DataFrame, id_col: str, text_col: str, k: int, block_rows: int | None = None,
                   keep_rank: bool = False) -> DataFrame:
    """Each row's text as the query against all other rows (hybrid's keyword leg)."""
    return bm25_topk(texts, id_col, text_col, texts, id_col, text_col, k, block_rows=block_rows,
                     exclude_same_id=True, keep_rank=keep_rank, self_search=True)


SEED_POSTINGS = 1024  # of a query's rarest words, to find its first threshold
HEADS = 4  # times k documents a query are looked up first
SLACK = 2e-6  # scores are compared after rounding to 6 decimals


def max_score_topk(queries: DataFrame, query_id: str, query_text: str, docs: DataFrame, doc_id: str, doc_text: str, k: int,
                   exclude_same_id: bool = False) -> DataFrame:
    """(original_id, potential_duplicate_id, score): at least the best k by
    max-score over postings.

    * Postings are kept for the queries' words only, before anything is
      shuffled; each word has its greatest contribution, idf * max weight.
    * A query's rarest words give its first threshold, a k-th best partial sum.
    * Its words whose greatest contributions add up to less than the threshold
      cannot lift a document over it by themselves. Their postings, the
      longest, are never expanded: a document must hold one of the other words.
    * For the best documents by partial sum the rest is looked up, which gives
      a k-th best score. Another document stays, and is looked up, if its
      partial sum and the greatest contributions of the rest reach it.

    A word in a third of the documents is spread over tasks by document.
    """
    postings, terms = _postings(queries, query_id, query_text, docs, doc_id, doc_text)
    essential, rest = _essential(postings, terms, k)
    total = terms.agg(F.sum("df")).first()[0] or 0
    per = Window.partitionBy("q")

    def expanded(words: DataFrame) -> DataFrame:
        out = skew_join(postings, words.select("q", "h", "idf"), "h", total, counts=terms.select("h", F.col("df").alias("_n")).distinct())
        out = out.where("q != id") if exclude_same_id else out
        return out.groupBy("q", "id").agg(F.sum(F.col("idf") * F.col("w")).alias("s"))

    def resolved(found: DataFrame) -> DataFrame:
        asked = found.select("q", "id").join(rest.select("q", "h", "idf"), "q")
        more = asked.join(postings, ["h", "id"]).groupBy("q", "id").agg(F.sum(F.col("idf") * F.col("w")).alias("more"))
        return found.join(more, ["q", "id"], "left").select("q", "id", (F.col("s") + F.coalesce("more", F.lit(0.0))).alias("s"))

    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("_r", F.row_number().over(per.orderBy(F.desc("s"), "id")))

    partial = materialize(expanded(essential))
    # The best by partial sum are looked up first: their k-th score is the bar.
    head = materialize(resolved(place(partial).where(F.col("_r") <= HEADS * k).drop("_r")))
    bar = place(head).where(F.col("_r") == k).select("q", F.col("s").alias("bar"))
    left = rest.groupBy("q").agg(F.sum("u").alias("most"))
    found = partial.join(bar, "q", "left").join(left, "q", "left").join(head.select("q", "id"), ["q", "id"], "left_anti")
    found = found.where(F.col("bar").isNull() | (F.col("s") + F.coalesce("most", F.lit(0.0)) >= F.col("bar") - F.lit(SLACK))).select("q", "id", "s")
    out = head.unionByName(resolved(materialize(found)))
    return out.select(F.col("q").alias("original_id"), F.col("id").alias("potential_duplicate_id"), F.col("s").alias("score"))


def _postings(queries: DataFrame, query_id: str, query_text: str, docs: DataFrame, doc_id: str, doc_text: str) -> tuple[DataFrame, DataFrame]:
    """Postings (h, id, w) of the queries' words, and the queries' words
    (q, h, df, idf, u: the greatest contribution)."""
    vectors, _, n, _ = bm25_index(docs, doc_id, doc_text)
    rows = queries.select(F.col(query_id).alias("q"), F.col(query_text).alias("_text")).where(F.col("q").isNotNull())
    # A repeated query id is one query with the words of all its rows.
    asked = materialize(with_features(ensure_parallel(rows), "_text", "words", keep=["q"]).select("q", F.explode("f").alias("h")).distinct())
    each = vectors.select("id", F.explode(F.arrays_zip("f", "w")).alias("p")).select(F.col("p.f").alias("h"), "id", F.col("p.w").alias("w"))
    postings = materialize(each.join(asked.select("h").distinct(), "h", "left_semi"))
    stats = postings.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.max("w").alias("most"))
    idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    terms = asked.join(stats, "h").select("q", "h", "df", idf.alias("idf"), (idf * F.col("most")).alias("u"))
    return postings, materialize(terms)


def _essential(postings: DataFrame, terms: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(words to expand, the rest)."""
    per = Window.partitionBy("q")
    seeds = terms.withColumn("_c", F.sum("df").over(per.orderBy("df", "h"))).where(F.col("_c") <= SEED_POSTINGS)
    first = seeds.join(postings, "h").groupBy("q", "id").agg(F.sum(F.col("idf") * F.col("w")).alias("s"))
    # One more than k: the query may be among them where it is a document.
    theta = (first.withColumn("_r", F.row_number().over(per.orderBy(F.desc("s"), "id"))).where(F.col("_r") == k + 1)
             .select("q", F.col("s").alias("theta")))
    marked = terms.join(theta, "q", "left").withColumn("_u", F.sum("u").over(per.orderBy("u", "h")))
    marked = materialize(marked.withColumn("rest", F.coalesce(F.col("_u") < F.col("theta") - F.lit(SLACK), F.lit(False))).drop("_u", "theta"))
    return marked.where("not rest").drop("rest"), marked.where("rest").drop("rest")
