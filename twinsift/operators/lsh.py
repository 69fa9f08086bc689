"""Approximate candidate generation (J3): MinHash bands for feature sets
(Broder 1997) and random-hyperplane bands for dense vectors (Charikar 2002).

Rows sharing a band bucket are candidates; each bucket is scored exactly in
bounded tiles (a bucket holding a third of the table is split into blocks,
never expanded into all its pairs), duplicates across bands collapse, and the
best k remain. The result is a subset of the exact join's pairs with exact
scores.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.functions.text import token_column, word_shingles
from twinsift.functions.vectorize import binary_features
from twinsift.operators.candidates import best_k
from twinsift.operators.tiles import grouped_tiled_topk
from twinsift.session import ship_package
from twinsift.sources.tables import ensure_parallel, materialize

MINHASH_BANDS, MINHASH_ROWS = 16, 4
HYPERPLANE_MIN_BITS = 6
HYPERPLANE_BANDS = 48  # at least
# Pairs at this cosine share a band with at least this chance, at any size.
HYPERPLANE_COSINE, HYPERPLANE_RECALL = 0.8, 0.9
PRIME = 2**31 - 1  # fixed: the hash family (a x + b) mod p


def coefficients(num: int) -> tuple[list[int], list[int]]:
    """a and b of the hash family, from MD5, so that SQL can state the same."""
    number = lambda name: int(hashlib.md5(name.encode()).hexdigest()[:7], 16)
    return [number(f"a{i}") + 1 for i in range(num)], [number(f"b{i}") for i in range(num)]


def minhash_signature(features: Column, num: int = MINHASH_BANDS * MINHASH_ROWS) -> Column:
    """array<bigint> of ``num`` minima of (a x + b) mod (2^31 - 1) over the
    portable hashes of the features; flat over the batch, one hash at a time."""
    a, b = coefficients(num)
    ship_package()

    @F.pandas_udf("array<bigint>")
    def _sig(s: pd.Series) -> pd.Series:
        lens = np.fromiter((0 if f is None else len(f) for f in s), np.int64, len(s))
        out = pd.Series([None] * len(s), dtype=object)
        full = np.flatnonzero(lens)
        if len(full):
            flat = np.concatenate([np.asarray(s.iloc[i], np.int64) for i in full])
            starts = np.cumsum(lens[full]) - lens[full]
            sig = np.stack([np.minimum.reduceat((flat * x + y) % PRIME, starts) for x, y in zip(a, b, strict=True)], axis=1)
            for i, row in zip(full, sig, strict=True):
                out.iloc[i] = row
        return out

    return _sig(features)


def portable_hashes(df: DataFrame, id_col: str, text_col: str, mode: str) -> DataFrame:
    """(id, x): the distinct features of ``binary_features`` as the first 28
    bits of their MD5."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).where(F.col("id").isNotNull())
    toks = ensure_parallel(rows).select("id", token_column(F.col("_text"), mode).alias("_toks"))
    grams = word_shingles(F.col("_toks")) if mode == "shingles" else F.array_distinct("_toks")
    return toks.select("id", grams.alias("g")).select("id", F.array_distinct(F.transform(
        "g", lambda g: F.conv(F.substring(F.md5(g), 1, 7), 16, 10).cast("long"))).alias("x"))


@functools.lru_cache(maxsize=4)
def hyperplanes(dim: int, num: int) -> np.ndarray:
    """dim x num signs from MD5 bits (random +-1 planes)."""
    bit = lambda i, j: int(hashlib.md5(f"{i}:{j}".encode()).hexdigest()[:1], 16) & 1
    return np.array([[1.0 - 2.0 * bit(i, j) for j in range(num)] for i in range(dim)])


def packed_bits(m: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """vectors x bands: the sign bits of each band as one number."""
    planes, place = hyperplanes(m.shape[1], bands * rows), 1 << np.arange(rows, dtype=np.int64)
    out = np.empty((len(m), bands), np.int64)
    for at in range(0, len(m), 256):  # bounds the bits held at once
        bits = m[at:at + 256] @ planes >= 0
        out[at:at + 256] = bits.reshape(-1, bands, rows) @ place
    return out


def hyperplane_bits(vec: Column, bands: int, rows: int) -> Column:
    """array<bigint> sign bits of the vector, a number a band: matrix products
    for the vectors of a length."""
    if rows > 62:
        raise ValueError("at most 62 bits a band")
    ship_package()

    @F.pandas_udf("array<bigint>")
    def _bits(s: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(s), dtype=object)
        lens = np.fromiter((0 if v is None else len(v) for v in s), np.int64, len(s))
        for d in np.unique(lens[lens > 0]):
            at = np.flatnonzero(lens == d)
            m = np.stack([np.asarray(s.iloc[i], np.float64) for i in at])
            for i, row in zip(at, packed_bits(m, bands, rows), strict=True):
                out.iloc[i] = row
        return out

    return _bits(vec)


def band_keys(signature: Column, bands: int, rows: int) -> Column:
    """One 64-bit bucket key per band: hash of (band index, band slice)."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda i: F.xxhash64(i, F.slice(signature, i * rows + 1, F.lit(rows))))


def _bucketed_topk(memberships: DataFrame, payload: DataFrame, kind: str, k: int, block_rows: int | None,
                   n_rows: int) -> DataFrame:
    pairs = grouped_tiled_topk(memberships, kind, k, block_rows=block_rows, n_rows=n_rows, payload=payload)
    pairs = pairs.groupBy("original_id", "potential_duplicate_id").agg(F.max("score").alias("score"))
    return best_k(pairs, k)


def minhash_features_topk(feats: DataFrame, hashes: DataFrame, k: int, bands: int = MINHASH_BANDS, rows: int = MINHASH_ROWS,
                          block_rows: int | None = None) -> DataFrame:
    """MinHash LSH over (id, f) feature sets with their (id, x) hashes."""
    sig = materialize(hashes.select("id", minhash_signature(F.col("x"), bands * rows).alias("sig")))
    keyed = sig.where(F.col("sig").isNotNull()).select(
        "id", F.explode(band_keys(F.col("sig"), bands, rows)).alias("grp"))
    return _bucketed_topk(keyed, feats.select("id", "f"), "binary_cosine", k, block_rows, sig.count() * bands)


def minhash_topk(texts: DataFrame, id_col: str, text_col: str, k: int, mode: str = "shingles",
                 bands: int = MINHASH_BANDS, rows: int = MINHASH_ROWS, block_rows: int | None = None,
                 collapse_copies: bool = True) -> DataFrame:
    """Best k partners among rows sharing a MinHash band (exact cosine).

    Exact copies share every band, so a big group of copies would make one
    huge bucket; as in the exact path they are collapsed first (identical
    sets always collide, so the expansion is the same LSH result).
    """
    from twinsift.operators.copies import topk_with_copies_collapsed

    feats = materialize(binary_features(texts, id_col, text_col, mode))
    hashes = portable_hashes(texts, id_col, text_col, mode)
    if not collapse_copies:
        return minhash_features_topk(feats, hashes, k, bands, rows, block_rows)
    return topk_with_copies_collapsed(
        feats, k, lambda reps, kk, _done: minhash_features_topk(reps, hashes.join(reps.select("id"), "id", "left_semi"), kk, bands, rows, block_rows))


def hyperplane_rows(n: int) -> int:
    """Bits a band: buckets of about 8 random rows at any size, so that the
    scored pairs grow with the rows, not with their square."""
    return max(HYPERPLANE_MIN_BITS, math.ceil(math.log2(max(1, n) / 8)))


def hyperplane_bands(rows: int, cosine: float = HYPERPLANE_COSINE, recall: float = HYPERPLANE_RECALL) -> int:
    """Bands of ``rows`` bits for the recall of pairs at the cosine: a pair at
    angle ``t`` shares one with chance ``1 - (1 - (1 - t / pi)^rows)^bands``."""
    same = (1 - math.acos(cosine) / math.pi) ** rows
    return max(HYPERPLANE_BANDS, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def hyperplane_topk(df: DataFrame, id_col: str, vec_col: str, k: int, bands: int | None = None,
                    rows: int | None = None, block_rows: int | None = None) -> DataFrame:
    """Best k partners among rows sharing a hyperplane band (exact cosine).

    ``rows`` (bits a band) follows the number of rows, ``bands`` the bits
    (``hyperplane_bands``); more ``bands`` raise the recall of lower cosines."""
    vecs = (df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull()))
    rows = rows or hyperplane_rows(vecs.count())
    bands = bands or hyperplane_bands(rows)
    bits = materialize(vecs.select("id", "vec", hyperplane_bits(F.col("vec"), bands, rows).alias("bits")))
    keyed = bits.select("id", F.explode(F.transform("bits", lambda x, i: F.xxhash64(i, x))).alias("grp"))
    return _bucketed_topk(keyed, bits.select("id", "vec"), "dense_cosine", k, block_rows, bits.count() * bands)
