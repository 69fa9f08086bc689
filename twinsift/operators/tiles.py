"""Tiled top-k: the exact all-pairs similarity primitive.

Rows are hashed into blocks of at most ``block_rows`` rows; every pair of
blocks is one tile, computed in one ``applyInPandas`` task as a numpy matrix
product, and each tile emits only the best ``k`` partners per row. The plan
therefore never materialises a pair list and never gathers a hot feature, a
hot bucket or a cluster of copies into one group: a group is a block pair
whose size is bounded by construction (the same layout as a distributed
block-matrix product). A final ``row_number() <= k`` window
(``WindowGroupLimit``, partial before the shuffle) merges the tiles.

Score kinds
  binary_cosine  |A ∩ B| / sqrt(|A| |B|) over distinct hashed features ``f``
  subset_cosine  the same where ``f`` holds some of the ``n`` features of a row
  dot            sum of weight products over ``f`` / ``w`` (BM25, weighted cosine)
  dense_cosine   cosine of ``vec`` arrays, float64
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.functions import kernels
from twinsift.session import release_shuffles, ship_package
from twinsift.sources.tables import drop_table, materialize, scratch_path, store

KINDS = ("binary_cosine", "subset_cosine", "dot", "dense_cosine")
DEFAULT_BLOCK_ROWS = 2048
FEATURES_PER_BLOCK = 6_000_000  # caps a tile's memory for long texts (~100 MB of features per tile)


def _payload_cols(kind: str) -> list[str]:
    return {"binary_cosine": ["f"], "subset_cosine": ["f", "n"], "dot": ["f", "w"], "dense_cosine": ["vec"]}[kind]


def _rank(ids: np.ndarray) -> np.ndarray:
    if ids.dtype.kind in "iuf":
        return ids.astype(np.float64) if ids.dtype.kind == "f" else ids.astype(np.int64)
    # Decimals, dates and strings in their own order, which is Spark's.
    return np.unique(ids, return_inverse=True)[1]


def _scores(kind: str, lp: pd.DataFrame, rp: pd.DataFrame):
    """(score matrix, candidate mask) for left rows x right rows."""
    nl, nr = len(lp), len(rp)
    if kind == "dense_cosine":
        s = kernels.dense_cosine(kernels.stack_vectors(list(lp["vec"])), kernels.stack_vectors(list(rp["vec"])))
        return np.clip(s, 0.0, 1.0), np.ones((nl, nr), dtype=bool)
    if kind in ("binary_cosine", "subset_cosine"):
        l_rows, l_f, l_w, l_len = kernels.flatten(list(lp["f"]))
        r_rows, r_f, r_w, r_len = kernels.flatten(list(rp["f"]))
        if kind == "subset_cosine":
            l_len, r_len = lp["n"].to_numpy(), rp["n"].to_numpy()
        cnt = kernels.sparse_dot(l_rows, l_f, l_w, nl, r_rows, r_f, r_w, nr)
        denom = np.sqrt(l_len.astype(np.float64)[:, None] * r_len.astype(np.float64)[None, :])
        valid = cnt > 0
        s = np.divide(cnt, denom, out=np.zeros_like(cnt), where=valid)
        return s, valid
    l_rows, l_f, l_w, _ = kernels.flatten(list(lp["f"]), list(lp["w"]))
    r_rows, r_f, r_w, _ = kernels.flatten(list(rp["f"]), list(rp["w"]))
    s = kernels.sparse_dot(l_rows, l_f, l_w, nl, r_rows, r_f, r_w, nr)
    return s, s > 0


def _emit(lp, rp, s, valid, k, exclude_same_id):
    lid = lp["id"].to_numpy()
    rid = rp["id"].to_numpy()
    if exclude_same_id and len(lid) and len(rid):
        valid = valid & (lid[:, None] != rid[None, :])
    r, c = kernels.topk_per_row(s, valid, _rank(rid), k)
    return pd.DataFrame({"original_id": lid[r], "potential_duplicate_id": rid[c], "score": s[r, c]})


def _tile_function(kind: str, k: int, self_mode: bool, exclude_same_id: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if self_mode:
            ti, tj = pdf["_ti"].iat[0], pdf["_tj"].iat[0]
            if ti == tj:
                return _emit(pdf, pdf, *_scores(kind, pdf, pdf), k, True)
            lp = pdf[pdf["_b"] == ti].reset_index(drop=True)
            rp = pdf[pdf["_b"] == tj].reset_index(drop=True)
            s, valid = _scores(kind, lp, rp)
            return pd.concat([_emit(lp, rp, s, valid, k, exclude_same_id),
                              _emit(rp, lp, s.T, valid.T, k, exclude_same_id)], ignore_index=True)
        lp = pdf[pdf["_side"] == 0].reset_index(drop=True)
        rp = pdf[pdf["_side"] == 1].reset_index(drop=True)
        return _emit(lp, rp, *_scores(kind, lp, rp), k, exclude_same_id)
    return run


def _size_stats(df: DataFrame, kind: str):
    """(rows, mean payload length) in one aggregate: scalars only."""
    col = "vec" if kind == "dense_cosine" else "f"
    row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(col)).alias("m")).first()
    return int(row["n"]), float(row["m"] or 0.0)


def choose_block_rows(mean_len: float, block_rows: int | None, n_rows: int = 0, parallelism: int = 1) -> int:
    """Rows per block: bounded by the feature budget of one tile, and small
    enough that the self join has at least ~2 tiles per core."""
    if block_rows:
        return int(block_rows)
    by_memory = DEFAULT_BLOCK_ROWS if mean_len <= 0 else FEATURES_PER_BLOCK // max(1.0, mean_len)
    nb_min = 1
    while nb_min * (nb_min + 1) // 2 < 2 * parallelism:
        nb_min += 1
    by_cores = math.ceil(n_rows / nb_min) if n_rows else DEFAULT_BLOCK_ROWS
    return int(max(64, min(DEFAULT_BLOCK_ROWS, by_memory, by_cores)))


ROUND_BYTES = 256 << 20  # of rows sent to tiles and lists that come back at once,
ROUND_COPIES = 2  # or so many times what the rows and their lists take, if that is more


def tile_rounds(kind: str, k: int, left_hint: tuple[int, float], right_hint: tuple[int, float] | None, block_rows: int | None, parallelism: int) -> int:
    """Rounds that the tiles are dealt to: all of them together send each row
    to many tiles, and each of them returns a list, which is far more than
    the input once there are many blocks."""
    def taken(hint: tuple[int, float]) -> float:
        return 8.0 * hint[1] * (2 if kind == "dot" else 1) + 32

    other = right_hint or left_hint
    br = choose_block_rows(max(left_hint[1], other[1]), block_rows, max(left_hint[0], other[0]), parallelism)
    bl, b_right = max(1, math.ceil(left_hint[0] / br)), max(1, math.ceil(other[0] / br))
    row, lists = taken(left_hint), 24.0 * k
    own, sent = left_hint[0] * (row + lists), left_hint[0] * b_right * (row + lists)
    if right_hint:
        own, sent = own + right_hint[0] * taken(right_hint), sent + right_hint[0] * bl * taken(right_hint)
    return min(max(bl, b_right), math.ceil(sent / max(ROUND_BYTES, ROUND_COPIES * own))) if sent > ROUND_BYTES else 1


def _partners(block: Column, count: int, part: tuple[int, int] | None) -> Column:
    """A row for each of ``count`` blocks that ``block`` meets, in a round
    ``(r, rounds)`` those with a sum of both numbers that is ``r`` modulo ``rounds``."""
    if part is None:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    first = F.pmod(F.lit(part[0]) - block, F.lit(part[1])).cast("int")
    return F.explode(F.when(first < count, F.sequence(first, F.greatest(first, F.lit(count - 1)), F.lit(part[1]))))


def best_in_rounds(rounds: int, k: int, run, out_col: str = "search_score", keep_rank: bool = False) -> DataFrame:
    """``best_k`` of the tiles ``run(part)``; in rounds, the best so far are
    stored and the shuffles of a round deleted before the next."""
    from twinsift.operators.candidates import best_k

    if rounds <= 1:
        return best_k(run(None), k, out_col=out_col, keep_rank=keep_rank)
    found = at = None
    for r in range(rounds):
        pairs = run((r, rounds)).select("original_id", "potential_duplicate_id", "score")
        spark, last, at = pairs.sparkSession, at, scratch_path(pairs.sparkSession, "tiles-best")
        found = store(best_k(pairs if found is None else pairs.unionByName(found), k, out_col="score"), at)
        del pairs
        if last:
            drop_table(spark, last)
    release_shuffles(spark)
    out = materialize(best_k(found, k, out_col=out_col, keep_rank=keep_rank))
    drop_table(spark, at)
    return out


def stored_rounds(rounds: int, run) -> DataFrame:
    """All rows of ``run(part)``, stored round by round."""
    at = None
    for r in range(rounds):
        rows = run((r, rounds) if rounds > 1 else None)
        if rounds <= 1:
            return materialize(rows)
        at = at or scratch_path(rows.sparkSession, "tiles-rows")
        spark, out = rows.sparkSession, store(rows, at)
        del rows
    release_shuffles(spark)
    return out


MAX_TILE_PARTITIONS = 200_000


def _spread_tiles(tiles: DataFrame, keys: list[str], n_tiles: int) -> DataFrame:
    """One shuffle partition per tile or so, fixed by us: a tile is small in
    bytes but heavy in CPU, and AQE would otherwise coalesce many tiles into
    a few tasks. ``groupBy`` on the same keys then reuses this partitioning."""
    spark = tiles.sparkSession
    n = min(MAX_TILE_PARTITIONS, max(2 * n_tiles, spark.sparkContext.defaultParallelism))
    return tiles.repartition(n, *keys)


def _out_schema(df: DataFrame) -> str:
    t = df.schema["id"].dataType.simpleString()
    return f"original_id {t}, potential_duplicate_id {t}, score double"


def text_stats(df: DataFrame, text_col: str, chars_per_feature: float = 6.0):
    """(rows, estimated features per row, approximate distinct texts) from
    the raw text in one cheap aggregate (no tokenising): sizes the blocks and
    tells whether exact copies are common enough to collapse first."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.length(text_col)).alias("c"),
                 F.approx_count_distinct(F.xxhash64(text_col)).alias("d")).first()
    return int(row["n"]), float(row["c"] or 0.0) / chars_per_feature, int(row["d"] or 0)


def text_size_hint(df: DataFrame, text_col: str, chars_per_feature: float = 6.0):
    """(rows, estimated features per row) for block sizing."""
    n, m, _ = text_stats(df, text_col, chars_per_feature)
    return n, m


def tiled_topk(left: DataFrame, kind: str, k: int, right: DataFrame | None = None,
               block_rows: int | None = None, exclude_same_id: bool = True,
               left_hint: tuple[int, float] | None = None, right_hint: tuple[int, float] | None = None,
               part: tuple[int, int] | None = None) -> DataFrame:
    """Best ``k`` partners per left row (pairs with no overlap are no candidates
    for sparse kinds). ``right=None`` is the self join: each unordered block
    pair is computed once and serves both directions.

    Input columns: ``id`` plus ``f`` / ``f, w`` / ``vec`` for the kind.
    Output: ``original_id, potential_duplicate_id, score`` (raw, unrounded),
    at most ``k`` per original *per tile*; merge with ``best_k``.

    Block counts need the row counts: ``*_hint`` = (rows, mean features per
    row) from a cheap aggregate upstream; without a hint one aggregate runs
    over the given frame. ``part`` (r, rounds): the tiles of one round only
    (``best_in_rounds``).
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    ship_package(left.sparkSession)
    cols = ["id"] + _payload_cols(kind)
    fn_schema = _out_schema(left)
    if right is None:
        rows = left.select(*cols)
        n, mean_len = left_hint or _size_stats(rows, kind)
        br = choose_block_rows(mean_len, block_rows, n, left.sparkSession.sparkContext.defaultParallelism)
        nb = max(1, math.ceil(n / br))
        tiles = rows.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int"))
        tiles = tiles.withColumn("_j", _partners(F.col("_b"), nb, part))
        tiles = tiles.select(*cols, "_b", F.least("_b", "_j").alias("_ti"), F.greatest("_b", "_j").alias("_tj"))
        tiles = _spread_tiles(tiles, ["_ti", "_tj"], nb * (nb + 1) // 2 // (part[1] if part else 1))
        fn = _tile_function(kind, k, True, True)
        return tiles.groupBy("_ti", "_tj").applyInPandas(fn, fn_schema)
    l_rows = left.select(*cols)
    r_rows = right.select(*cols)
    nl, ml = left_hint or _size_stats(l_rows, kind)
    nr, mr = right_hint or _size_stats(r_rows, kind)
    br = choose_block_rows(max(ml, mr), block_rows, max(nl, nr), left.sparkSession.sparkContext.defaultParallelism)
    bl, bR = max(1, math.ceil(nl / br)), max(1, math.ceil(nr / br))
    lt = l_rows.withColumn("_ti", F.pmod(F.xxhash64("id"), F.lit(bl)).cast("int"))
    lt = lt.select(*cols, F.lit(0).alias("_side"), "_ti", _partners(F.col("_ti"), bR, part).alias("_tj"))
    rt = r_rows.withColumn("_tj", F.pmod(F.xxhash64("id"), F.lit(bR)).cast("int"))
    rt = rt.select(*cols, F.lit(1).alias("_side"), _partners(F.col("_tj"), bl, part).alias("_ti"), "_tj")
    fn = _tile_function(kind, k, False, exclude_same_id)
    tiles = _spread_tiles(lt.unionByName(rt), ["_ti", "_tj"], bl * bR // (part[1] if part else 1))
    return tiles.groupBy("_ti", "_tj").applyInPandas(fn, fn_schema)


def _request_tiles(left: DataFrame, right: DataFrame, kind: str, left_hint: tuple[int, float], right_hint: tuple[int, float], run, schema: str,
                   part: tuple[int, int] | None = None) -> DataFrame:
    """``run(left rows, right rows)`` in each tile of ``left`` (with its
    requests ``req``) x ``right``."""
    ship_package(left.sparkSession)
    cols = ["id"] + _payload_cols(kind)
    br = choose_block_rows(max(left_hint[1], right_hint[1]), None, max(left_hint[0], right_hint[0]),
                           left.sparkSession.sparkContext.defaultParallelism)
    bl, b_right = max(1, math.ceil(left_hint[0] / br)), max(1, math.ceil(right_hint[0] / br))
    lt = left.withColumn("_ti", F.pmod(F.xxhash64("id"), F.lit(bl)).cast("int"))
    lt = lt.select(*cols, "req", F.lit(0).alias("_side"), "_ti", _partners(F.col("_ti"), b_right, part).alias("_tj"))
    rt = right.withColumn("_tj", F.pmod(F.xxhash64("id"), F.lit(b_right)).cast("int"))
    rt = rt.select(*cols, F.lit(None).cast(left.schema["req"].dataType).alias("req"), F.lit(1).alias("_side"),
                   _partners(F.col("_tj"), bl, part).alias("_ti"), "_tj")

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        return run(pdf[pdf["_side"] == 0].reset_index(drop=True), pdf[pdf["_side"] == 1].reset_index(drop=True))

    tiles = _spread_tiles(lt.unionByName(rt), ["_ti", "_tj"], bl * b_right // (part[1] if part else 1))
    return tiles.groupBy("_ti", "_tj").applyInPandas(tile, schema)


def _asked(lp: pd.DataFrame, rp: pd.DataFrame):
    """(left row, right row) of the requested pairs that lie in this tile."""
    lens = np.fromiter((0 if r is None else len(r) for r in lp["req"]), np.int64, len(lp))
    if not lens.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i = np.repeat(np.arange(len(lp)), lens)
    j = pd.Index(rp["id"]).get_indexer(np.concatenate([np.asarray(r) for r in lp["req"] if r is not None and len(r)]))
    return i[j >= 0], j[j >= 0]


def tiled_leg(left: DataFrame, right: DataFrame, kind: str, k: int, left_hint: tuple[int, float], right_hint: tuple[int, float], part: tuple[int, int] | None = None) -> DataFrame:
    """One pass for a ranked list and for given pairs: the best ``k`` other
    rows of each left row in each tile (``asked`` false), and the scores above
    0 of the pairs in the left rows' ``req``, an array of ids (``asked`` true)."""
    def run(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        score, valid = _scores(kind, lp, rp)
        top = _emit(lp, rp, score, valid, k, True).assign(asked=False)
        i, j = _asked(lp, rp)
        i, j = i[valid[i, j]], j[valid[i, j]]
        pairs = pd.DataFrame({"original_id": lp["id"].to_numpy()[i], "potential_duplicate_id": rp["id"].to_numpy()[j], "score": score[i, j], "asked": True})
        return pd.concat([top, pairs], ignore_index=True) if len(pairs) else top

    return _request_tiles(left, right, kind, left_hint, right_hint, run, _out_schema(left) + ", asked boolean", part)


def tiled_pairs(left: DataFrame, right: DataFrame, kind: str, left_hint: tuple[int, float], right_hint: tuple[int, float], part: tuple[int, int] | None = None) -> DataFrame:
    """The scores above 0 of the pairs in the left rows' ``req`` (ids): only
    those pairs are multiplied, not whole tiles."""
    def run(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        i, j = _asked(lp, rp)
        score = _pair_scores(kind, lp, rp, i, j)
        i, j, score = i[score > 0], j[score > 0], score[score > 0]
        return pd.DataFrame({"original_id": lp["id"].to_numpy()[i], "potential_duplicate_id": rp["id"].to_numpy()[j], "score": score})

    return _request_tiles(left, right, kind, left_hint, right_hint, run, _out_schema(left), part)


def _pair_scores(kind: str, lp: pd.DataFrame, rp: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of single pairs of a sparse kind."""
    weighted = kind == "dot"
    l_rows, l_f, l_w, l_len = kernels.flatten(list(lp["f"]), list(lp["w"]) if weighted else None)
    r_rows, r_f, r_w, r_len = kernels.flatten(list(rp["f"]), list(rp["w"]) if weighted else None)
    sums = kernels.pair_dot(l_rows, l_f, l_w, l_len, r_rows, r_f, r_w, i, j)
    if weighted:
        return sums
    n = (lp["n"].to_numpy(), rp["n"].to_numpy()) if kind == "subset_cosine" else (l_len, r_len)
    return np.divide(sums, np.sqrt(n[0][i].astype(np.float64) * n[1][j].astype(np.float64)), out=np.zeros(len(i)), where=sums > 0)


def tiled_ranks(left: DataFrame, right: DataFrame, kind: str, left_hint: tuple[int, float], right_hint: tuple[int, float], part: tuple[int, int] | None = None) -> DataFrame:
    """How many rows of ``right`` rank before each pair in the left rows'
    ``req``, an array of (id, s): a greater rounded score than ``s``, or the
    same and a smaller id. Rows (original_id, potential_duplicate_id, value),
    to be added up over the tiles."""
    def run(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        out_o, out_p, out_n = [], [], []
        if len(lp) and len(rp):
            score, valid = _scores(kind, lp, rp)
            rid = rp["id"].to_numpy()
            place = np.argsort(rid, kind="stable")
            for i, (o, req) in enumerate(zip(lp["id"], lp["req"], strict=True)):
                fit = place[(valid[i] & (rid != o))[place]]  # by id
                if not len(fit):
                    continue
                p = np.array([r["id"] for r in req], rid.dtype)
                units = np.rint(kernels.round6(score[i, fit]) * 1e6)[None, :]
                s = np.rint(np.array([r["s"] for r in req]) * 1e6)[:, None]
                smaller = np.arange(len(fit))[None, :] < np.searchsorted(rid[fit], p)[:, None]
                n = ((units > s) | ((units == s) & smaller)).sum(axis=1)
                out_o += [o] * int((n > 0).sum())
                out_p += p[n > 0].tolist()
                out_n += n[n > 0].astype(float).tolist()
        return pd.DataFrame({"original_id": out_o, "potential_duplicate_id": out_p, "value": np.array(out_n, float)})

    return _request_tiles(left, right, kind, left_hint, right_hint, run, _out_schema(left).replace("score double", "value double"), part)


FEW_ROWS = 6  # of a bucket whose pairs are scored one by one, with those of other buckets


def _few_rows(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` partners of each row in any of many small buckets; a
    pair that several buckets hold is scored once."""
    ids, first, code = np.unique(_rank(pdf["id"].to_numpy()), return_index=True, return_inverse=True)
    order = np.argsort(pd.factorize(pdf["grp"])[0], kind="stable")
    code, grp = code[order], pdf["grp"].to_numpy()[order]
    pairs = []
    for step in range(1, FEW_ROWS):
        same = grp[step:] == grp[:-step]
        a, b = code[:-step][same], code[step:][same]
        pairs.append(np.minimum(a, b) * len(ids) + np.maximum(a, b))
    a, b = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(ids)))
    a, b = a[a != b], b[a != b]
    rows = pdf.iloc[first]
    score = _pair_scores("binary_cosine", rows, rows, a, b)
    a, b, score = np.r_[a, b][np.r_[score, score] > 0], np.r_[b, a][np.r_[score, score] > 0], np.r_[score, score][np.r_[score, score] > 0]
    order = np.lexsort((b, -kernels.round6(score), a))  # codes are in the order of the ids
    a, b, score = a[order], b[order], score[order]
    new = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    keep = np.arange(len(a)) - np.repeat(new, np.diff(np.r_[new, len(a)])) < k
    names = rows["id"].to_numpy()
    return pd.DataFrame({"original_id": names[a[keep]], "potential_duplicate_id": names[b[keep]], "score": score[keep]})


def _bucket_function(kind: str, k: int):
    """Tile function for bucket tiles: a packed group of small buckets (each
    scored on its own) or one block pair of a large bucket."""
    tile = _tile_function(kind, k, True, True)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["_ti"].iat[0] >= 0:
            return tile(pdf)
        parts = []
        if kind == "binary_cosine":  # counts are whole numbers: the same scores pair by pair
            few = pdf.groupby("grp")["id"].transform("size") <= FEW_ROWS
            parts.append(_few_rows(pdf[few].reset_index(drop=True), k))
            pdf = pdf[~few]
        parts += [_emit(g, g, *_scores(kind, g, g), k, True)
                  for _, g in pdf.groupby("grp", sort=False) if len(g) > 1]
        parts = [p for p in parts if len(p)]
        if not parts:
            return pd.DataFrame({"original_id": pdf["id"].iloc[:0], "potential_duplicate_id": pdf["id"].iloc[:0],
                                 "score": np.zeros(0)})
        return pd.concat(parts, ignore_index=True)
    return run


def grouped_tiled_topk(rows: DataFrame, kind: str, k: int, block_rows: int | None = None,
                       salts: int = 16, n_rows: int | None = None, payload: DataFrame | None = None) -> DataFrame:
    """``tiled_topk`` inside each value of ``grp`` (LSH buckets).

    ``rows`` are thin memberships (grp, id); ``payload`` is (id, features),
    one row per id, joined only to memberships of buckets with two or more
    rows (``rows`` may carry the payload itself when ``payload`` is None).

    * Bucket sizes are a partial aggregate of the thin memberships;
      singleton buckets drop out before any feature is attached.
    * Buckets of at most ``block_rows`` rows (nearly all) are packed: grouped
      by ``hash(grp) mod P`` with P = rows / block_rows, so one task scores
      many small buckets.
    * A bucket above ``block_rows`` -- one holding a third of the table
      included -- is split into blocks and scored block pair by block pair,
      never expanded into all its pairs; its memberships reach the size
      table through ``hot_key_join`` (salted), not through one task.
    """
    cols = ["id"] + _payload_cols(kind)
    br = int(block_rows or DEFAULT_BLOCK_ROWS)
    ship_package(rows.sparkSession)
    memb = rows.select("grp", "id")
    n = n_rows if n_rows is not None else memb.count()
    packs = max(1, math.ceil(n / br))
    sizes = memb.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    multi = hot_key_join(memb, sizes, "grp", n, salts)
    data = payload if payload is not None else rows.select(*cols).dropDuplicates(["id"])
    sized = multi.join(data.select(*cols), "id")
    is_large = F.col("_n") > F.lit(br)
    small = (sized.where(~is_large)
             .select(F.pmod(F.xxhash64("grp"), F.lit(packs)).alias("_key"), "grp", *cols,
                     F.lit(-1).alias("_b"), F.lit(-1).alias("_ti"), F.lit(-1).alias("_tj")))
    nb = F.ceil(F.col("_n") / F.lit(br)).cast("int")
    big = sized.where(is_large).withColumn("_nb", nb).withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_nb")).cast("int"))
    big = big.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    big = big.select(F.col("grp").alias("_key"), "grp", *cols, "_b",
                     F.least("_b", "_j").alias("_ti"), F.greatest("_b", "_j").alias("_tj"))
    tiles = _spread_tiles(small.unionByName(big), ["_key", "_ti", "_tj"], packs)
    return tiles.groupBy("_key", "_ti", "_tj").applyInPandas(_bucket_function(kind, k), _out_schema(data))


MAX_HOT_KEYS = 10_000


def skew_join(big: DataFrame, small: DataFrame, key: str, n_big: int, salts: int = 16,
              salt_by: str = "id", counts: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``small`` (one row per key) so that a key holding a
    third of ``big`` is spread over ``salts`` tasks instead of one.

    Hot keys are those with more than ``n_big / MAX_HOT_KEYS`` rows in
    ``big``; there are at most ``MAX_HOT_KEYS`` of them whatever the data
    size, and that list is the only broadcast. Rows of hot keys get a salt
    from ``salt_by``; the matching ``small`` rows are replicated ``salts``
    times; every other key joins unsalted. ``counts`` (key, ``_n``) may be
    passed when known; otherwise it is a partial aggregate over ``big``.
    """
    limit = float(max(n_big, 1)) / MAX_HOT_KEYS
    if counts is None:
        counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > F.lit(limit)).select(key, F.lit(True).alias("_hot"))
    b = (big.join(F.broadcast(hot), key, "left")
         .withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_by), F.lit(salts)))
                     .otherwise(F.lit(0)).cast("int")).drop("_hot"))
    s = (small.join(F.broadcast(hot), key, "left")
         .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                       .otherwise(F.array(F.lit(0))))).drop("_hot"))
    return b.join(s, [key, "_salt"], how).drop("_salt")


def hot_key_join(big: DataFrame, counts: DataFrame, key: str, n_big: int, salts: int = 16,
                 salt_by: str = "id") -> DataFrame:
    """``skew_join`` of memberships with their own bucket sizes (``_n``)."""
    return skew_join(big, counts, key, n_big, salts, salt_by, counts=counts)
