"""Exact collapse of identical records before the similarity step.

Deduplication inputs are full of exact copies, and one group of copies may
hold a third of the table. Scoring every copy against every other is
quadratic in the group size; instead:

1. rows with an identical feature set form a group (a partial aggregate on
   the SHA-256 of the sorted feature array, so that neither the join key nor
   the bounded hot list carries arrays); the smallest id represents it;
2. the similarity top-k runs over representatives only;
3. each member's list is rebuilt from its own group's k+1 smallest ids
   (score exactly 1.0) and, for each neighbouring group, that group's k
   smallest ids at the representatives' score.

This is exact. Order groups by (score desc, smallest id asc), the order the
representatives' top-k uses. Suppose a partner B of a member A is missing:
then k better-ranked groups exist, and each one's smallest id ranks above B
for A. So B is not in A's top k. Inside a group only its k smallest ids can
matter. Every step is a partial aggregate, a per-group limit
(``WindowGroupLimit``) or a skew-safe join with one row per group, so a hot
group costs linear work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.operators.candidates import best_k
from twinsift.session import release_shuffles
from twinsift.sources.tables import drop_table, materialize, scratch_path, store

PIECE_ROWS = 10_000  # rows of a piece of the features, of MOST_PIECES at most
MOST_PIECES = 8


def expand(rep_top: DataFrame, members: DataFrame, groups: DataFrame, k: int, n_rows: int) -> DataFrame:
    """Member-level best k from the representatives' best k (see module doc).

    ``members`` (id, rep), ``groups`` (rep, _n): every join below has one row
    per group on its small side and is skew-safe on its big side.
    """
    from twinsift.operators.tiles import skew_join

    w = Window.partitionBy("rep").orderBy("id")
    smallest = (members.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
                .groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    counts = groups.select("rep", "_n")
    # 1) copies of the row itself: score exactly 1.0
    own = (skew_join(members.select("id", "rep"), smallest, "rep", n_rows, counts=counts)
           .select(F.col("id").alias("original_id"), F.explode("ids").alias("potential_duplicate_id"))
           .where(F.col("original_id") != F.col("potential_duplicate_id"))
           .withColumn("score", F.lit(1.0)))
    # 2) neighbouring groups: their k smallest ids at the representatives' score
    partner_ids = smallest.select(F.col("rep").alias("potential_duplicate_id"), "ids")
    nb = (skew_join(rep_top, partner_ids, "potential_duplicate_id", n_rows * k, salt_by="original_id")
          .select(F.col("original_id").alias("rep"),
                  F.struct(F.slice("ids", 1, k).alias("ids"), F.col("search_score").alias("s")).alias("n"))
          .groupBy("rep").agg(F.collect_list("n").alias("nbrs")))
    cross = (skew_join(members.select("id", "rep"), nb, "rep", n_rows, counts=counts)
             .select(F.col("id").alias("original_id"), F.explode("nbrs").alias("n"))
             .select("original_id", F.explode("n.ids").alias("potential_duplicate_id"), F.col("n.s").alias("score"))
             .where(F.col("original_id") != F.col("potential_duplicate_id")))
    return best_k(own.unionByName(cross), k)


def topk_with_copies_collapsed(feats: DataFrame, k: int, inner) -> DataFrame:
    """Run ``inner(representatives (id, f), k, done) -> best-k pairs`` on one
    row per distinct feature set and expand the result to every row. ``inner``
    may call ``done()`` once it has read the representatives for the last time.

    Rows group on the digest of their sorted feature array (a partial
    aggregate, so a hot group is pre-aggregated before the shuffle). The
    canonical features, the groups, the member map and the representatives'
    top-k are each stored once, since several steps read them. The features
    are most of what is on disk: those of the representatives replace those of
    all rows piece by piece (by id), and are deleted in their turn.
    """
    from twinsift.operators.tiles import skew_join

    spark = feats.sparkSession
    pieces = max(1, min(MOST_PIECES, feats.select("id").count() // PIECE_ROWS))
    piece = F.pmod(F.xxhash64("id"), F.lit(pieces)).cast("int")
    # An empty feature set overlaps with nothing: such rows have no candidates.
    # The filter reads what is stored; before it, it would move below the
    # projection and make the features a second time.
    canon_at, reps_at = scratch_path(spark, "features"), scratch_path(spark, "representatives")
    canon = feats.select("id", F.array_sort("f").alias("f")).withColumns({"_key": F.sha2(F.to_json("f"), 256), "_piece": piece})
    canon = store(canon, canon_at, "_piece").where(F.size("f") > 0)
    groups = materialize(canon.groupBy("_key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("_n")))
    n_rows = groups.agg(F.sum("_n")).first()[0] or 0
    members = materialize(skew_join(canon.select("id", "_key"), groups, "_key", n_rows, counts=groups.select("_key", "_n"))
                          .select("id", "rep"))
    # One row a group keeps its features: those of its representative.
    for i in range(pieces):
        own = members.where("id = rep").where(piece == i).select("id")
        reps = store(canon.where(F.col("_piece") == i).join(own, "id", "left_semi").select("id", "f"), reps_at)
        drop_table(spark, f"{canon_at}/_piece={i}")
    drop_table(spark, canon_at)
    if pieces > 1:
        release_shuffles(spark)
    rep_top = materialize(inner(reps, k, lambda: drop_table(spark, reps_at)))
    drop_table(spark, reps_at)
    return expand(rep_top, members, groups, k, n_rows)
