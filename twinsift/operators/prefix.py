"""Exact sparse top-k through a prefix-filtered inverted join (J6).

For a row A with n features whose k-th best score is at least s, every partner
at s or above shares at least ceil(s^2 n) features with A
(c / sqrt(n m) >= s and c <= m). So it shares one of the n - ceil(s^2 n) + 1
rarest features of A, and A's commoner features need no look-up at all.

1. A feature is *rare* if it is in at most ``d`` rows, else *hot*. ``d`` is the
   largest power of two for which the lists of rare features hold no more than
   ``PAIRS_PER_FEATURE`` partners for each feature of the table, so the join
   grows as the table does.
2. The lists of rare features go to the blocks of their members, as one array
   each. A block counts the shared rare features of each of its rows with all
   partners. A partner stays if its greatest possible score (all of the row's
   hot features shared as well) reaches the k-th of the least scores.
3. Hot features of the pairs that stay are compared exactly.
4. A row with h hot features is *closed* if h < s^2 n: its prefix is rare, so
   all partners at s are known. Rows that are not, or have fewer than k
   partners (no bound), meet the rows with hot features by their hot features
   alone. Of rows with equal hot features and size only the k + 1 smallest ids
   take part: the others rank behind them.
5. Rows of at most ``FEW_HOT`` hot features meet by subsets: a set of features
   lists, for each size m, the k + 1 smallest ids of the rows of that size that
   hold it. A row looks up the subsets of its own features, the largest first,
   until fewer shared ones cannot reach its k-th best score. A partner beyond
   the list of what it shares has k others before it, with the same score or
   more and a smaller id. So the work is rows times subsets, where short
   records of few words (all of them hot) would be all pairs in tiles.
   Rows of more hot features meet the others in tiles.

The result is the same as that of all pairs in tiles; the tests hold one
against the other.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.operators.candidates import best_k
from twinsift.operators.tiles import best_in_rounds, skew_join, tile_rounds, tiled_topk
from twinsift.session import release_shuffles, ship_package
from twinsift.sources.tables import drop_table, materialize, scratch_path, store

PAIRS_PER_FEATURE = 8
PAIRS_PER_BLOCK = 1 << 22
PAIRS_PER_ROUND = 1 << 24  # entries of the lists sent to blocks at once,
PART_OF_FEATURES = 4  # or a feature in so many of the table's, if that is more
HOT_BYTES = 1 << 27  # of hot features that travel with pairs at once, or a byte a feature
FEW_PAIRS = 1 << 23  # pairs of rows that tiles take at once, for less than the subsets cost
PLACES_PER_SLICE = 1 << 22  # features shuffled at once, in MOST_SLICES at most
MOST_SLICES = 16
FEW_HOT = 8  # hot features of a row that finds its partners by subsets
SLACK = 2e-6  # scores are compared after rounding to 6 decimals


def rare_limit(doc_freq: DataFrame, most: int) -> tuple[int, int]:
    """(d, partners in the lists of features in 2 to d rows)."""
    level = F.ceil(F.log2("df")).cast("int")
    levels = doc_freq.groupBy(level.alias("level")).agg(F.sum(F.col("df") * (F.col("df") - 1)).alias("p")).collect()
    d, pairs = 1, 0
    for level, p in sorted((r["level"], r["p"]) for r in levels):
        if pairs + p > most:
            break
        d, pairs = 2 ** level, pairs + p
    return d, pairs


def _shared(rows: DataFrame, n_features: int, path: str) -> tuple[DataFrame, DataFrame]:
    """(id, n, x, df): the places of the features in two rows or more, and
    (x, df). The features are dealt into slices by hash and shuffled a slice at
    a time, so that the shuffles of one slice are on disk at once."""
    slices = max(1, min(MOST_SLICES, n_features // PLACES_PER_SLICE))
    places = rows.select("id", F.size("f").alias("n"), F.explode("f").alias("x"))
    parts = []
    for i in range(slices):
        some = places.where(F.pmod(F.xxhash64("x"), F.lit(slices)) == i) if slices > 1 else places
        parts.append(materialize(some.groupBy("x").agg(F.count(F.lit(1)).alias("df")).where("df > 1")))
        out = store(skew_join(some, parts[-1], "x", n_features, counts=parts[-1].withColumnRenamed("df", "_n")), path)
    doc_freq = parts[0]
    for part in parts[1:]:
        doc_freq = doc_freq.unionByName(part)
    return out, doc_freq


def shared_features(rows: DataFrame) -> DataFrame:
    """(id, n, f): of the ``n`` features of each stored row (id, f) those that
    another row has as well. The others make up most of a text's shingles and
    count for nothing but ``n``."""
    n_features = int(rows.agg(F.sum(F.size("f"))).first()[0] or 0)
    shared, _ = _shared(rows, n_features, scratch_path(rows.sparkSession, "shared"))
    return shared.groupBy("id", "n").agg(F.collect_list("x").alias("f"))


def prefix_topk(rows: DataFrame, k: int, pairs_per_feature: int = PAIRS_PER_FEATURE, block_rows: int | None = None, done=None) -> DataFrame:
    """Best ``k`` partners of each row of ``rows`` (id, f: distinct features) by
    |A ∩ B| / sqrt(|A| |B|); rows that share nothing are no partners. ``rows``
    is read several times and should be stored; ``done()`` is called after the
    last read."""
    spark = rows.sparkSession
    ship_package(spark)
    n_features = int(rows.agg(F.sum(F.size("f"))).first()[0] or 0)
    shared_at = scratch_path(spark, "shared")
    shared, doc_freq = _shared(rows, n_features, shared_at)
    if done:
        done()
    d, pairs = rare_limit(doc_freq, pairs_per_feature * n_features)
    split = shared.groupBy("id", "n").agg(F.collect_list(F.when(F.col("df") <= d, F.col("x"))).alias("rare"),
                                          F.array_sort(F.collect_list(F.when(F.col("df") > d, F.col("x")))).alias("hot"))
    split_at, known_at = scratch_path(spark, "split"), scratch_path(spark, "known")
    split = store(split, split_at)
    drop_table(spark, shared_at)
    if n_features > PLACES_PER_SLICE:
        release_shuffles(spark)  # and the checkpoints of the steps before
    hot = split.where(F.size("hot") > 0).select("id", "n", "hot", F.size("hot").alias("h"))
    known = _with_hot(*_from_lists(split, doc_freq.where(F.col("df") <= d), k, pairs, n_features), hot, known_at, n_features)
    found = best = materialize(best_k(known, k, out_col="score"))
    drop_table(spark, known_at)
    bar = (best.groupBy("original_id").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
           .select(F.col("original_id").alias("id"), "s"))
    open_ = hot.join(bar, "id", "left").where(F.col("s").isNull() | (F.sqrt(F.col("h") / F.col("n")) + SLACK >= F.col("s")))
    open_ = materialize(open_.select("id", F.col("hot").alias("f"), "n", "s"))
    if not open_.isEmpty():
        w = Window.partitionBy(F.sha2(F.to_json("hot"), 256), "n").orderBy("id")
        some = hot.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
        some = materialize(some.select("id", F.col("hot").alias("f"), "n"))
        found = best.unionByName(_by_hot(open_, some, k, block_rows))
        found = found.groupBy("original_id", "potential_duplicate_id").agg(F.max("score").alias("score"))
    # Of the pairs known only the best can be among the best of both.
    top = best_k(found, k)
    if n_features > PLACES_PER_SLICE:
        top = store(top, scratch_path(spark, "list-pairs"))
    drop_table(spark, split_at)
    return top


def _by_hot(open_: DataFrame, some: DataFrame, k: int, block_rows: int | None) -> DataFrame:
    """(original_id, potential_duplicate_id, score): at least the best ``k`` of
    ``some`` (id, f: hot features, n) for the rows ``open_`` (and s: the k-th
    best score known), by shared hot features alone."""
    def tiles(a: DataFrame, b: DataFrame) -> DataFrame | None:
        hints = [(int(x["n"]), float(x["m"] or 0)) for x in sizes(a, b)]
        if not all(n for n, _ in hints):
            return None
        rounds = tile_rounds("subset_cosine", k, *hints, block_rows, a.sparkSession.sparkContext.defaultParallelism)

        def run(part: tuple[int, int] | None) -> DataFrame:
            return tiled_topk(a, "subset_cosine", k, right=b, block_rows=block_rows, left_hint=hints[0], right_hint=hints[1], part=part)

        return run(None) if rounds == 1 else best_in_rounds(rounds, k, run, out_col="score")

    def sizes(*frames: DataFrame) -> list:
        return [df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("f")).alias("m")).first() for df in frames]

    n_open, n_some = (x["n"] for x in sizes(open_, some))
    if n_open * n_some <= FEW_PAIRS:
        return tiles(open_, some)
    few = F.size("f") <= FEW_HOT
    many, rows = some.where(~few), open_.where(few)
    out, rows = _by_subsets(rows, some.where(few), k)
    # A row of few hot features meets those of many where it shares enough.
    least = many.agg(F.min("n")).first()[0]
    reach = F.size("f") / F.sqrt(F.col("n") * F.lit(float(least or 1)))
    left = rows.where(F.col("s").isNull() | (reach + SLACK >= F.col("s")))
    for pairs in (tiles(open_.where(~few), some), tiles(left, many)):
        out = out if pairs is None else out.unionByName(pairs)
    return out


def _subsets(size: int) -> F.Column:
    """A row for each subset of ``size`` of the features ``f`` (sorted, at
    most ``FEW_HOT``)."""
    places = ", ".join("array(" + ", ".join(f"array({', '.join(map(str, c))})" for c in combinations(range(h), size)) + ")"
                       for h in range(size, FEW_HOT + 1))
    return F.expr(f"explode(transform(element_at(array({places}), size(f) - {size - 1}), c -> transform(c, i -> f[i])))")


def _by_subsets(rows: DataFrame, partners: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that hold the best ``k`` of ``partners`` (id, f, n) for ``rows``
    (id, f, n, s), and ``rows`` with the k-th best score now known."""
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.sparkSession.createDataFrame([], f"original_id {kind}, potential_duplicate_id {kind}, score double")
    most = rows.agg(F.max(F.size("f"))).first()[0]
    size = partners.agg(F.max(F.size("f")).alias("f"), F.min("n").alias("n")).first()
    if most is None or size["n"] is None:
        return found, rows
    for c in range(min(most, size["f"]), 0, -1):
        reach = F.lit(float(c)) / F.sqrt(F.col("n") * F.lit(float(max(c, size["n"]))))
        asked = rows.where((F.size("f") >= c) & (F.col("s").isNull() | (reach + SLACK >= F.col("s"))))
        asked = materialize(asked.select("id", "n", _subsets(c).alias("x")))
        n_asked = asked.count()
        if not n_asked:
            continue
        w = Window.partitionBy("x", "m").orderBy("id")
        lists = (partners.where(F.size("f") >= c).select("id", F.col("n").alias("m"), _subsets(c).alias("x"))
                 .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
                 .groupBy("x").agg(F.collect_list(F.struct("m", "id")).alias("e")))  # k + 1 a size
        pairs = (skew_join(asked, lists, "x", n_asked).select(F.col("id").alias("original_id"), "n", F.explode("e").alias("e"))
                 .select("original_id", F.col("e.id").alias("potential_duplicate_id"),
                         (F.lit(float(c)) / F.sqrt(F.col("n").cast("double") * F.col("e.m"))).alias("score"))
                 .where("original_id != potential_duplicate_id"))
        every = found.unionByName(pairs).groupBy("original_id", "potential_duplicate_id").agg(F.max("score").alias("score"))
        found = materialize(best_k(every, k, out_col="score"))
        kth = (found.groupBy("original_id").agg(F.min("score").alias("_s"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
               .select(F.col("original_id").alias("id"), "_s"))
        rows = materialize(rows.join(kth, "id", "left").select("id", "f", "n", F.greatest("s", "_s").alias("s")))
    return found, rows


def _from_lists(split: DataFrame, doc_freq: DataFrame, k: int, pairs: int, n_features: int) -> tuple[DataFrame, str]:
    """(original_id, potential_duplicate_id, n, m, c, both), and the folder it
    is in: partners by shared rare features that may be among the best k;
    ``both`` if both rows have hot features, which ``c`` does not count yet.
    ``doc_freq`` (x, df) are the rare features."""
    # Two tasks a core, fewer where there is little to do.
    spark = split.sparkSession
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(pairs / PAIRS_PER_BLOCK), min(2 * cores, math.ceil(pairs / 50_000)))
    # A list goes to each block of its members: many more entries than it
    # holds once there are many blocks.
    sent = doc_freq.agg(F.sum(F.col("df") * F.least("df", F.lit(blocks)))).first()[0] or 0
    rounds = max(1, math.ceil(sent / max(PAIRS_PER_ROUND, n_features // PART_OF_FEATURES)))
    blocks = max(blocks, cores * rounds) if rounds > 1 else blocks
    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    split = split.withColumns({"h": F.size("hot"), "b": place})
    entry = F.struct("id", "n", "h", "b")
    lists = (split.select(F.explode("rare").alias("x"), entry.alias("e"))
             .groupBy("x").agg(F.collect_list("e").alias("e")))  # at most d entries
    kind = split.schema["id"].dataType.simpleString()

    def pairs_of(lists: DataFrame, own: F.Column, blocks: int) -> DataFrame:
        sent = lists.select(F.explode(own).alias("b"), *[F.col(f"e.{c}").alias(f"{c}s") for c in ("id", "n", "h", "b")])
        return sent.repartition(blocks, "b").groupBy("b").applyInArrow(
            lambda table: _block_pairs(table, k), f"original_id {kind}, potential_duplicate_id {kind}, n int, m int, c int, both boolean")

    def in_round(r: int):
        return lambda b: b % rounds == r

    lists_at, out_at = scratch_path(spark, "lists"), scratch_path(spark, "block-pairs")
    if rounds == 1:
        return store(pairs_of(lists, F.array_distinct("e.b"), blocks), out_at), out_at
    # The lists that are sent to some of the blocks are on disk at once.
    lists = store(lists, lists_at)
    for r in range(rounds):
        own = F.array_distinct(F.filter("e.b", in_round(r)))
        out = store(pairs_of(lists, own, math.ceil(blocks / rounds)), out_at)
    drop_table(spark, lists_at)
    return out, out_at


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(values of all lists, their lengths)."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return lists.flatten(), np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)


def _block_pairs(table: pa.Table, k: int) -> pa.Table:
    """The pairs of one block's rows with all partners in the lists."""
    block = table.column("b")[0].as_py()
    ids, lens = _flat(table.column("ids"))
    coded = ids.dictionary_encode()
    code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    sizes, hots, of_block = (_flat(table.column(c))[0].to_numpy(zero_copy_only=False) for c in ("ns", "hs", "bs"))
    n_of, h_of = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    n_of[code], h_of[code] = sizes, hots
    own = np.flatnonzero(of_block == block)
    of_list = np.repeat(np.arange(len(lens)), lens)[own]
    times = lens[of_list]
    start = (np.cumsum(lens) - lens)[of_list]
    right = np.arange(times.sum()) + np.repeat(start - (np.cumsum(times) - times), times)
    key = np.sort(np.repeat(code[own], times) * len(names) + code[right])
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    c, key = np.diff(np.r_[at, len(key)]), key[at]
    a, b = np.divmod(key, max(1, len(names)))
    other = a != b
    a, b, c = a[other], b[other], c[other]
    root = np.sqrt((n_of[a] * n_of[b]).astype(np.float64))
    least = c / root
    most = (c + np.minimum(h_of[a], h_of[b])) / root
    order = np.lexsort((-least, a))
    new = np.r_[True, a[order][1:] != a[order][:-1]] if len(a) else np.zeros(0, bool)
    rank = np.arange(len(a)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    bar = np.zeros(len(names))
    kth = order[rank == k - 1]
    bar[a[kth]] = least[kth]
    stay = most + SLACK >= bar[a]
    a, b, c = a[stay], b[stay], c[stay]
    return pa.table({"original_id": names.take(pa.array(a)), "potential_duplicate_id": names.take(pa.array(b)),
                     "n": pa.array(n_of[a], pa.int32()), "m": pa.array(n_of[b], pa.int32()), "c": pa.array(c, pa.int32()),
                     "both": pa.array((h_of[a] > 0) & (h_of[b] > 0))})


def _with_hot(pairs: DataFrame, pairs_at: str, hot: DataFrame, path: str, n_features: int) -> DataFrame:
    """``pairs`` scored, with the hot features that both rows have, stored at
    ``path``; some pairs at a time, since the features of both rows travel with
    a pair. The folder of ``pairs`` is deleted."""
    a = hot.select(F.col("id").alias("original_id"), F.col("hot").alias("ha"))
    b = hot.select(F.col("id").alias("potential_duplicate_id"), F.col("hot").alias("hb"))
    scored = ["original_id", "potential_duplicate_id", (F.col("c") / F.sqrt(F.col("n").cast("double") * F.col("m").cast("double"))).alias("score")]
    out = store(pairs.where("not both").select(*scored), path)
    met = pairs.where("both")
    taken = met.count() * (32 + 8 * float(hot.agg(F.avg("h")).first()[0] or 0))
    rounds = max(1, math.ceil(taken / max(HOT_BYTES, n_features)))
    for r in range(rounds) if taken else ():
        def own(df: DataFrame, r: int = r) -> DataFrame:
            return df.where(F.pmod(F.xxhash64("original_id"), F.lit(rounds)) == r) if rounds > 1 else df

        some = own(met).join(own(a), "original_id").join(b, "potential_duplicate_id")
        out = store(some.withColumn("c", F.col("c") + F.size(F.array_intersect("ha", "hb"))).select(*scored), path)
    drop_table(pairs.sparkSession, pairs_at)
    return out
