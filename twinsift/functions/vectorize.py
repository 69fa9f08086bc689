"""Feature builders: sparse binary features, BM25 weights, hashed embeddings."""

from __future__ import annotations

import hashlib
import importlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.functions.text import WORD_PATTERN, with_features, word_tokens
from twinsift.session import bound_batches, ship_package
from twinsift.sources.tables import ensure_parallel, materialize

# Fixed BM25 parameters (Robertson & Zaragoza 2009).
BM25_K1 = 1.2
BM25_B = 0.75
WEIGHT_ROWS = 512
EMBED_DIM = 64
EMBED_GRAM = 3


def binary_features(df: DataFrame, id_col: str, text_col: str, mode: str = "shingles") -> DataFrame:
    """(id, f): distinct hashed features. Rows without a key drop out; rows
    without a feature stay (they overlap with nothing, so the tiles skip them)
    -- a filter on the feature array would be pushed below the projection and
    recompute the tokenising."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).where(F.col("id").isNotNull())
    return with_features(ensure_parallel(rows), "_text", mode, keep=["id"])


def _tf_weights(hashes: pd.Series, k1: float, b: float, avgdl: float) -> pd.DataFrame:
    """Per document: distinct term hashes and tf (k1 + 1) / (tf + k1 (1 - b + b |d| / avgdl)),
    in one flat pass over the batch."""
    lens = np.fromiter((0 if h is None else len(h) for h in hashes), np.int64, len(hashes))
    flat = np.concatenate([np.asarray(h, np.int64) for h in hashes if h is not None and len(h)]) if lens.sum() else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(lens)), lens)
    order = np.lexsort((flat, doc))
    flat, doc = flat[order], doc[order]
    first = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])]) if len(flat) else np.zeros(0, np.int64)
    tf = np.diff(np.r_[first, len(flat)]).astype(np.float64)
    w = tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * lens[doc[first]] / avgdl))
    cuts = np.cumsum(np.bincount(doc[first], minlength=len(lens)))[:-1] if len(lens) else []
    return pd.DataFrame({"f": np.split(flat[first], cuts), "w": np.split(w, cuts)}) if len(lens) else pd.DataFrame({"f": [], "w": []})


def bm25_index(docs: DataFrame, id_col: str, text_col: str, k1: float = BM25_K1, b: float = BM25_B):
    """BM25 split into its two factors (Robertson & Zaragoza 2009):

    score(q, d) = sum over t in q and d of idf(t) * tf (k1 + 1) / (tf + k1 (1 - b + b |d| / avgdl))
    idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5))

    The document factor needs only the document itself (computed per row,
    no shuffle); idf goes to the query side. Returns
    ``(doc_vectors(id, f, w), doc_freq(h, df), N, avgdl)``; document
    frequencies are a partial aggregate, so a stop word costs one row per
    partition before the shuffle.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    rows = ensure_parallel(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
                           .where(F.col("id").isNotNull()))
    toks = rows.select("id", word_tokens(F.col("_text"), WORD_PATTERN).alias("_toks"))
    hashed = materialize(toks.select("id", F.transform("_toks", lambda t: F.xxhash64(t)).alias("h")))
    stats = hashed.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("h")).alias("avgdl")).first()
    n, avgdl = int(stats["n"]), float(stats["avgdl"] or 0.0)
    avg = avgdl if avgdl > 0 else 1.0

    @F.pandas_udf("struct<f: array<bigint>, w: array<double>>")
    def _weights(h: pd.Series) -> pd.DataFrame:
        # Some rows at a time: the sorted copies of a batch's words are what takes memory.
        parts = [_tf_weights(h.iloc[at:at + WEIGHT_ROWS], k1, b, avg) for at in range(0, max(1, len(h)), WEIGHT_ROWS)]
        return pd.concat(parts, ignore_index=True)

    vectors = hashed.select("id", _weights("h").alias("v")).select("id", "v.f", "v.w")
    doc_freq = (hashed.select(F.explode(F.array_distinct("h")).alias("h"))
                .groupBy("h").agg(F.count(F.lit(1)).alias("df")))
    return vectors, doc_freq, n, avgdl


def bm25_query_vectors(queries: DataFrame | None, id_col: str, text_col: str, doc_freq: DataFrame, n: int,
                       n_query_terms: int | None = None, self_search: bool = False,
                       doc_vectors: DataFrame | None = None) -> DataFrame:
    """(id, f, w): distinct query words weighted by their idf in the corpus.

    Words absent from the corpus drop out (no document could match them).
    A stop word present in most queries is a hot key of the term rows: the
    join with the document frequencies is ``skew_join`` (bounded hot list,
    salted), so it never lands in one task. In self-search the queries are
    the documents, so the per-term query counts are the document
    frequencies themselves; otherwise they are a partial aggregate of the
    query terms. ``n_query_terms`` (an estimate is enough: it only sets the
    hot-key threshold) saves a count.
    """
    from twinsift.operators.tiles import skew_join

    if self_search and doc_vectors is not None:
        # the queries are the documents: their distinct terms are already indexed
        terms = doc_vectors.select("id", F.explode("f").alias("h"))
    else:
        rows = queries.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).where(F.col("id").isNotNull())
        q = with_features(ensure_parallel(rows), "_text", "words", keep=["id"])
        terms = q.select("id", F.explode("f").alias("h"))
    counts = doc_freq.select("h", F.col("df").alias("_n")) if self_search else None
    n_terms = n_query_terms if n_query_terms is not None else terms.count()
    idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    if self_search:
        doc_freq = doc_freq.where("df > 1")  # a word of one text finds no other
    weighted = skew_join(terms, doc_freq, "h", n_terms, counts=counts).select("id", "h", idf.alias("idf"))
    return (weighted.groupBy("id").agg(F.collect_list(F.struct("h", "idf")).alias("t"))
            .select("id", F.col("t.h").alias("f"), F.col("t.idf").alias("w")))


class _GramPlaces(dict):
    """gram -> place (sign in the lowest bit) from its MD5, so that any engine
    can make the same vectors; emptied when it is full."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, gram: str) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        h = hashlib.md5(gram.encode("utf-8", "surrogatepass")).hexdigest()
        out = self[gram] = int(h[:8], 16) % self.dim * 2 + int(h[8:10], 16) % 2
        return out


def _hash_embed_batch(texts: pd.Series, dim: int, gram: int) -> pd.Series:
    places, out = _GramPlaces(dim), []
    for t in texts:
        t = (t or "").lower()
        grams = map("".join, zip(*[t[i:] for i in range(gram)], strict=False))
        h = np.fromiter(map(places.__getitem__, grams), np.int64, max(0, len(t) - gram + 1))
        v = np.bincount(h >> 1, weights=1.0 - 2.0 * (h & 1), minlength=dim)
        nrm = math.sqrt(float(v @ v))
        out.append((v / nrm if nrm > 0 else v).astype(np.float32))
    return pd.Series(out)


def hash_embed(text: Column, dim: int = EMBED_DIM, gram: int = EMBED_GRAM) -> Column:
    """Embed a text column: signed feature hashing of the lower-cased text's
    character n-grams (repeats included), L2 normalised, as ``array<float>``
    -- a model-free stand-in for an embedding endpoint."""
    ship_package()

    @F.pandas_udf("array<float>")
    def _embed(s: pd.Series) -> pd.Series:
        return _hash_embed_batch(s, dim, gram)

    return _embed(text)


def model_embedder(load):
    """An embedding function (Column -> Column) of a local model: ``load()``
    gives a function list of texts -> rows of numbers and runs once in each
    task that embeds, not once a batch (iterator pandas UDF)."""
    ship_package()

    @F.pandas_udf("array<float>")
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            rows = np.asarray(model(texts.fillna("").tolist()), np.float32)
            yield pd.Series(list(rows))

    return lambda text: _embed(text)


EMBEDDERS = {"hashed-char-ngrams": hash_embed}


def embedder(name: str):
    """The embedding function (Column -> Column) of a model name: a known one,
    or ``module:function`` for a loader (``model_embedder``) that the Python
    workers can import. A function can also be given to the jobs as it is."""
    if name in EMBEDDERS:
        return EMBEDDERS[name]
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"no embedding model {name!r}; known: {sorted(EMBEDDERS)}, or module:function of a loader")

    def load():
        return getattr(importlib.import_module(module), function)()

    return model_embedder(load)


def embed(df: DataFrame, text_col: str, out_col: str = "embedding", embed_fn=None) -> DataFrame:
    """Add an embedding column; ``embed_fn`` is any Column -> Column (for
    example a ``pandas_udf`` wrapping a local model); default ``hash_embed``."""
    fn = embed_fn or hash_embed
    return df.withColumn(out_col, fn(F.col(text_col)))
