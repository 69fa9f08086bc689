"""Language identification by the nearest of several centroids a language.

Features: character 1- to 3-grams of the lower-cased text, where a run of
characters that are no letters is one boundary; grams are hashed into
``FEATURES`` places, weighted (1 + log tf) * idf and normalised. Document
frequencies count every training document. Centroids: spherical k-means with
``CENTROIDS`` centroids for each language, fitted on about
``SAMPLE_PER_LANGUAGE`` of its training documents (chosen by a hash of id and
text; the only sampled step). A text gets the language of the centroid with
the largest cosine; it is rejected when its distance from that centroid is
beyond ``REJECT_DEVIATIONS`` standard deviations of the members' distances.

The driver holds the document frequencies (``FEATURES`` numbers) and the
centroids (``MAX_LANGUAGES`` * ``CENTROIDS`` vectors at most; training rows of more
languages are an error, none is left out), whatever the
size of the data.

Defined cases: a text that is null or has no letter gets ``und`` with score 0
and is not rejected; rows without a language are not learned from; with no
training row every text gets ``und``; equal cosines go to the smaller
language; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

FEATURES = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 1000
MAX_LANGUAGES = 500
REJECT_DEVIATIONS = 4.0
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter; made once a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def gram_counts(text: str | None, features: int = FEATURES) -> np.ndarray | None:
    """Counts of the hashed grams of a whole text; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, np.uint32(0))
    # One boundary for each run, one at either end (the mark after the last
    # letter, where there is one, is the end's).
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.concatenate([np.zeros(1, np.uint32), points[keep], np.zeros(int(letter[-1]), np.uint32)])
    shift = np.uint32(32 - int(features).bit_length() + 1)
    m = [np.uint32(x) for x in _MULTIPLIERS]
    one = (c + np.uint32(1)) * m[0]
    two = (one[:-1] ^ (one[1:] >> np.uint32(15))) * m[1] + one[1:]
    three = (two[:-1] ^ (two[1:] >> np.uint32(13))) * m[2] + two[1:]
    return sum(np.bincount((x * m[0]) >> shift, minlength=features) for x in (one, two, three))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts -> normalised TF-IDF rows."""
    w = np.zeros(counts.shape, np.float32)
    np.log(counts, out=w, where=counts > 0, casting="unsafe")
    w = (w + (counts > 0)) * idf
    return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids (unit rows) and for each the lowest cosine it accepts; the
    first centres are the mean's nearest row, then the farthest rows."""
    at = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[at[0]]
    while len(at) < min(k, len(x)):
        at.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[at[-1]])
    centres = x[at].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        for j in range(len(centres)):
            if (own == j).any():
                mean = x[own == j].mean(axis=0)
                centres[j] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    cos = x @ centres.T
    own = np.argmax(cos, axis=1)
    best = cos[np.arange(len(x)), own]
    accept = np.empty(len(centres), np.float32)
    for j in range(len(centres)):
        d = 1 - (best[own == j] if (own == j).any() else best)
        accept[j] = 1 - (d.mean() + REJECT_DEVIATIONS * max(float(d.std()), 0.01))
    return centres, accept


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """The model: languages, centroids, accepted cosines, idf."""
    t = training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(id_col, text_col).alias("key"))
    counts = t.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than MAX_LANGUAGES = {MAX_LANGUAGES} values of {lang_col}: raise the bound or leave rows out yourself")
    share = {r["lang"]: per_language / r["count"] for r in counts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "feature", "df", "vector"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            langs, vectors = [], []
            for lang, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = gram_counts(text)
                if c is None or lang not in share:
                    continue
                df += c > 0
                n += 1
                if (key & (2**53 - 1)) / 2**53 < share[lang]:
                    langs.append(lang)
                    vectors.append(c.astype(np.uint32).tobytes())
            if langs:
                none = [None] * len(langs)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((langs, none, none, vectors), kinds, strict=True)], names=names)
        if n:  # feature -1: the number of documents
            none = [None] * (FEATURES + 1)
            yield pa.RecordBatch.from_arrays([pa.array(none, kinds[0]), pa.array(range(-1, FEATURES), kinds[1]),
                                              pa.array([n, *df.tolist()], kinds[2]), pa.array(none, kinds[3])], names=names)

    common.prepare(t.sparkSession)
    seen = common.stored(t.mapInArrow(run, "lang string, feature int, df long, vector binary"), "language-fit")
    df = np.zeros(FEATURES + 1)
    for r in seen.where("feature is not null").groupBy("feature").agg(F.sum("df").alias("df")).collect():
        df[r["feature"] + 1] = r["df"]
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        # About per_language different vectors, by the hash's spread.
        rows = np.stack([np.frombuffer(v, np.uint32) for v in pdf["vector"].sort_values()])
        centres, accept = spherical_kmeans(weighted(rows, idf), CENTROIDS)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "accept": accept.astype(float),
                             "centre": [c.astype(np.float32).tobytes() for c in centres]})

    rows = (seen.where("vector is not null").select("lang", "vector").distinct().groupBy("lang")
            .applyInPandas(cluster, "lang string, accept double, centre binary").orderBy("lang", "centre").collect())
    return {"langs": [r["lang"] for r in rows], "accept": np.array([r["accept"] for r in rows], np.float32),
            "centres": np.stack([np.frombuffer(r["centre"], np.float32) for r in rows]) if rows else np.zeros((0, FEATURES), np.float32),
            "idf": idf}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, nearest, score (cosine), rejected and
    lang (``und`` if rejected). Only the text is looked at; no shuffle."""
    keep = keep or {}
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[c.alias(k) for k, c in keep.items()])
    kinds = {f.name: f.dataType.simpleString() for f in thin.schema}
    kept = list(keep)
    held = thin.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = held.value
        texts, n = batch.column(1), batch.num_rows
        nearest, score, rejected = ["und"] * n, np.zeros(n), np.zeros(n, bool)
        # Few rows at a time: a block of dense rows is FEATURES floats each.
        for at in range(0, n if m["langs"] else 0, 128):
            some = [(at + i, c) for i, t in enumerate(texts.slice(at, 128).to_pylist()) if (c := gram_counts(t)) is not None]
            if not some:
                continue
            cos = weighted(np.stack([c for _, c in some]), m["idf"]) @ m["centres"].T
            best = cos.argmax(axis=1)
            for (i, _), j, row in zip(some, best, cos, strict=True):
                nearest[i], score[i], rejected[i] = m["langs"][j], min(1.0, max(0.0, float(row[j]))), row[j] < m["accept"][j]
        lang = ["und" if r else x for x, r in zip(nearest, rejected, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *batch.columns[2:], pa.array(nearest, pa.string()), pa.array(score), pa.array(rejected), pa.array(lang, pa.string())],
            names=["doc_id", *kept, "nearest", "score", "rejected", "lang"])

    return common.map_batches(thin, run, f"doc_id {kinds['doc_id']}, " + "".join(f"{k} {kinds[k]}, " for k in keep)
                              + "nearest string, score double, rejected boolean, lang string")
