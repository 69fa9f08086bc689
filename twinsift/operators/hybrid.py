"""Hybrid search (J5): reciprocal-rank fusion of the vector and keyword legs.

RRF (Cormack et al. 2009) chooses the partners; the reported
``search_score`` stays the exact cosine, so the [0, 1] score contract of the
analysis and dedupe steps holds whatever method produced the candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.functions.vectorize import binary_features
from twinsift.operators.candidates import best_k
from twinsift.operators.keyword import bm25_sides
from twinsift.operators.prefix import shared_features
from twinsift.operators.tiles import best_in_rounds, stored_rounds, tile_rounds, tiled_leg, tiled_pairs, tiled_ranks, tiled_topk
from twinsift.session import release_shuffles
from twinsift.sources.tables import drop_table, materialize, scratch_path, store

RRF_K = 60  # fixed constant of reciprocal-rank fusion
PAIR = ["original_id", "potential_duplicate_id"]


def hybrid_topk(texts: DataFrame, id_col: str, text_col: str, k: int, text_mode: str = "shingles",
                depth: int | None = None, block_rows: int | None = None) -> DataFrame:
    """(original_id, potential_duplicate_id, search_score, rrf_score): the
    best k by the sum of 1 / (60 + rank) over the complete rankings of both
    legs (rrf rounded to 9 decimals desc, partner id asc).

    Each leg lists its best ``depth`` partners. At depth 60 + 2k a partner in
    neither list sums to less than 2 / (121 + 2k) < 1 / (60 + k), the least sum
    of any leg's best k: it cannot be among the best. A partner in one list
    only lacks a rank below ``depth`` in the other leg. Its score there is
    looked up (for the keyword leg in the pass that makes the list; for the
    vector leg pair by pair), which settles partners that share nothing; where
    the rank could still matter (the greatest possible sum reaches the k-th of
    the sums known), it is counted exactly in the tiles.
    """
    depth = max(int(depth or 0), RRF_K + 2 * k)
    feats = materialize(shared_features(materialize(binary_features(texts, id_col, text_col, text_mode))))
    size = feats.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("f")).alias("m")).first()
    hint = (int(size["n"]), float(size["m"] or 0.0))
    cores = texts.sparkSession.sparkContext.defaultParallelism
    vec = materialize(best_in_rounds(
        tile_rounds("subset_cosine", depth, hint, None, block_rows, cores), depth,
        lambda part: tiled_topk(feats, "subset_cosine", depth, block_rows=block_rows, left_hint=hint, part=part), keep_rank=True))
    q, d, q_hint, d_hint = bm25_sides(texts, id_col, text_col, texts, id_col, text_col, self_search=True)
    q, d = materialize(q), materialize(d)
    # One pass of the keyword leg: its list, and the scores of the other list's pairs.
    asked = vec.groupBy("original_id").agg(F.collect_list("potential_duplicate_id").alias("req"))
    sides = q.join(asked, q["id"] == asked["original_id"], "left").drop("original_id")
    lists, known = _leg(sides, d, depth, q_hint, d_hint)
    kw = best_k(lists, depth, out_col="bm25_score", keep_rank=True).withColumnRenamed("rank", "r_kw")
    known = known.select(*PAIR, F.round("score", 6).alias("s_kw"))
    fused = vec.withColumnRenamed("rank", "r_vec").join(kw, PAIR, "full_outer").join(known, PAIR, "left")
    # A leg that lists fewer than ``depth`` partners lists them all. A pair
    # without a keyword score that was looked up has no rank in that leg.
    per = Window.partitionBy("original_id")
    fused = fused.withColumns({"more_vec": F.col("r_vec").isNull() & (F.count("r_vec").over(per) >= depth),
                               "more_kw": F.col("r_kw").isNull() & F.col("s_kw").isNotNull() & (F.count("r_kw").over(per) >= depth)})
    # Thin (at most 2 * depth rows an original); read by the look-ups.
    pairs = materialize(_open(fused, k, depth).withColumn("s_vec", F.lit(None).cast("double")))
    pairs = _looked_up(pairs, feats, hint)
    pairs = materialize(_open(pairs, k, depth))  # what was found to have no rank lowered some sums for good
    pairs = _counted(pairs, "vec", feats, feats, "subset_cosine", hint, hint)
    pairs = _open(pairs, k, depth)  # ranks of one leg raise the bar for the other
    pairs = _counted(materialize(pairs), "kw", q, d, "dot", q_hint, d_hint)
    scored = pairs.withColumn("rrf_score", F.round(_share("r_vec") + _share("r_kw"), 9))
    w = Window.partitionBy("original_id").orderBy(F.desc("rrf_score"), F.asc("potential_duplicate_id"))
    top = scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return top.select(*PAIR, F.coalesce("search_score", F.lit(0.0)).alias("search_score"), "rrf_score")


def _leg(sides: DataFrame, d: DataFrame, depth: int, q_hint: tuple[int, float], d_hint: tuple[int, float]) -> tuple[DataFrame, DataFrame]:
    """The lists and the requested scores of the keyword leg. In rounds, the
    best of the lists so far and all requested scores are stored, and the
    shuffles of a round deleted before the next."""
    spark = sides.sparkSession
    rounds = tile_rounds("dot", depth, q_hint, d_hint, None, spark.sparkContext.defaultParallelism)
    if rounds == 1:
        leg = materialize(tiled_leg(sides, d, "dot", depth, q_hint, d_hint))
        return leg.where("not asked"), leg.where("asked")
    sides = materialize(sides)  # read in each round
    known_at, lists, at = scratch_path(spark, "leg-known"), None, None
    for r in range(rounds):
        leg_at, last, at = scratch_path(spark, "leg"), at, scratch_path(spark, "leg-lists")
        leg = store(tiled_leg(sides, d, "dot", depth, q_hint, d_hint, (r, rounds)), leg_at)
        known = store(leg.where("asked").select(*PAIR, "score"), known_at)
        some = leg.where("not asked").select(*PAIR, "score")
        lists = store(best_k(some if lists is None else some.unionByName(lists), depth, out_col="score"), at)
        del leg, some
        for done in (leg_at, last):
            if done:
                drop_table(spark, done)
    release_shuffles(spark)
    return lists, known


def _open(pairs: DataFrame, k: int, depth: int) -> DataFrame:
    """The pairs whose greatest possible sum reaches the k-th of the least
    sums; a rank still to be counted is beyond ``depth``."""
    beyond = F.lit(1.0 / (RRF_K + depth + 1))
    low = _share("r_vec") + _share("r_kw")
    high = low + F.when(F.col("more_vec"), beyond).otherwise(F.lit(0.0)) + F.when(F.col("more_kw"), beyond).otherwise(F.lit(0.0))
    per = Window.partitionBy("original_id")
    out = pairs.withColumns({"low": low, "high": high})
    out = out.withColumn("place", F.row_number().over(per.orderBy(F.desc("low"))))
    out = out.withColumn("bar", F.min(F.when(F.col("place") <= k, F.col("low"))).over(per))
    return out.where(F.col("high") >= F.col("bar") - F.lit(2e-9)).drop("low", "high", "place", "bar")


def _share(rank: str) -> F.Column:
    return F.coalesce(F.lit(1.0) / (F.lit(RRF_K) + F.col(rank)), F.lit(0.0))


def _rounds(df: DataFrame, kind: str, left_hint: tuple[int, float], right_hint: tuple[int, float]) -> int:
    return tile_rounds(kind, 1, left_hint, right_hint, None, df.sparkSession.sparkContext.defaultParallelism)


def _with_requests(left: DataFrame, requests: DataFrame, what) -> DataFrame:
    req = requests.groupBy("original_id").agg(F.collect_list(what).alias("req"))
    return left.join(req, left["id"] == req["original_id"]).drop("original_id")


def _looked_up(pairs: DataFrame, feats: DataFrame, hint: tuple[int, float]) -> DataFrame:
    """``pairs`` with the cosines that the list did not reach; a pair that
    shares nothing has no rank."""
    asked = pairs.where("more_vec")
    n = asked.select("original_id").distinct().count()
    if not n:
        return pairs
    left = materialize(_with_requests(feats, asked, F.col("potential_duplicate_id")))
    found = stored_rounds(_rounds(feats, "subset_cosine", (n, hint[1]), hint), lambda part: tiled_pairs(left, feats, "subset_cosine", (n, hint[1]), hint, part)
                          .select(*PAIR, F.round("score", 6).alias("s")))
    out = pairs.join(found, PAIR, "left").withColumns(
        {"search_score": F.coalesce("search_score", "s"), "s_vec": F.col("s"), "more_vec": F.col("more_vec") & F.col("s").isNotNull()})
    return out.drop("s")


def _counted(pairs: DataFrame, leg: str, left: DataFrame, right: DataFrame, kind: str, left_hint: tuple[int, float],
             right_hint: tuple[int, float]) -> DataFrame:
    """``pairs`` with the ranks in a leg that its list did not reach."""
    asked = pairs.where(f"more_{leg}")
    n = asked.select("original_id").distinct().count()
    if not n:
        return pairs
    what = F.struct(F.col("potential_duplicate_id").alias("id"), F.col(f"s_{leg}").alias("s"))
    sides = materialize(_with_requests(left, asked, what))
    before = stored_rounds(_rounds(right, kind, (n, left_hint[1]), right_hint), lambda part: tiled_ranks(sides, right, kind, (n, left_hint[1]), right_hint, part)
                           .groupBy(*PAIR).agg(F.sum("value").alias("value")))
    before = materialize(before.groupBy(*PAIR).agg(F.sum("value").cast("int").alias("n")))
    out = pairs.join(before, PAIR, "left")
    rank = F.when(F.col(f"more_{leg}"), F.coalesce("n", F.lit(0)) + 1)
    return out.withColumns({f"r_{leg}": F.coalesce(f"r_{leg}", rank), f"more_{leg}": F.lit(False)}).drop("n")
