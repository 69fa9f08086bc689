"""Toxicity by the nearest labelled examples.

Terms are lower-cased words and their first ``STEM`` letters. Examples are a
sample of the labelled training rows, at most ``PER_CLASS`` of either label
(by a hash of the id; the only sampled step). Every term of the examples
is in the space; document frequencies in it count all documents. Vectors are
normalised (1 + log tf) * idf * gain; the gain is 1 and up to ``GAIN`` more
for terms that tell the labels apart (chi-square and lift over the examples,
near copies counted once), so no word is left out.

The index is an inverted one over the distinct example vectors. A query of at
most ``FEW`` terms uses blocks of ``BLOCK`` vectors with each term's largest
weight in each: it adds up these for an upper bound of every block's cosines
and visits blocks in that order until the ``NEIGHBOURS``-th best cosine is
above the next bound. Longer queries, whose bounds skip nothing, add up all
cosines (``DENSE`` most frequent terms by a matrix product, the rest by their
postings in rows of ``ROW``) and compute the best again in double precision.
Both are exact.
The neighbours vote with weight 1 / (distance + ``SOFT``), the
rows behind a vector counted each, the classes reweighted to their shares of
all labelled rows. Votes of the examples without themselves give an isotonic
calibration to a probability.

The driver holds what the examples (bounded by ``PER_CLASS``) have: their
vectors, terms and document frequencies, and their index, which is broadcast.

Defined cases: null and empty texts, and texts without a word of any example,
have no neighbours and get the share of label 1 among such examples; without
examples of both labels every score is the share of label 1 (0 if there is no
label); null labels and labels without a text are ignored; repeated label
rows count once (the larger label), repeated documents once as an example; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from twinsift.llm import common

PER_CLASS = 8000
STEM = 5
CHI2 = 45.0
LIFT = 8.0
GAIN = 100.0
BLOCK = 64
FEW = 8
DENSE = 512
ROW = 16
PART = 1 << 20
TEXTS = 256
NEIGHBOURS = 15
SOFT = 0.05
_WORD = re.compile(r"[^\W\d_]+")
# ASCII characters that are in no word, as blanks.
_BLANKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def word_terms(word: str) -> tuple[str, ...]:
    """The terms of a lower-cased word."""
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


def term_counts(texts: list[str | None], space: pa.StringArray) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Places and counts of the terms in the space of every whole text, for
    ``TEXTS`` texts at a time. A word crosses neither white space nor another
    ASCII character that is no letter, so these part the runs; distinct runs
    are looked up, all in one go."""
    blank = [t.lower().encode().translate(_BLANKS) if t else b"" for t in texts]
    runs = pc.ascii_split_whitespace(pa.array(blank, pa.string()))
    del blank
    flat, ends = runs.values.dictionary_encode(), runs.offsets.to_numpy()
    of, run = flat.indices.to_numpy(), flat.dictionary
    del runs, flat
    plain = pc.string_is_ascii(run)  # is one word
    other = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
    found = [(r,) if r.isalpha() else _WORD.findall(r) for r in run.take(pa.array(other)).to_pylist()]
    words = pa.concat_arrays([run.filter(plain), pa.array(chain.from_iterable(found), pa.string())])
    run_of = np.append(np.flatnonzero(plain), np.repeat(other, [len(f) for f in found]))
    long = pc.greater(pc.utf8_length(words), STEM)
    stems = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.filter(long), 0, STEM), "*", "")
    place = pc.index_in(pa.concat_arrays([words, stems]), value_set=space)
    known = np.flatnonzero(place.is_valid())
    run_of = np.append(run_of, run_of[np.flatnonzero(long)])[known]
    place = place.take(pa.array(known)).to_numpy()[np.argsort(run_of, kind="stable")].astype(np.int64)
    last = np.append(0, np.cumsum(np.bincount(run_of, minlength=len(run))))
    del run, plain, other, found, words, run_of, long, stems, known
    for start in range(0, len(texts), TEXTS):
        end = ends[start:start + TEXTS + 1]
        part = of[end[0]:end[-1]]
        a, b = last[part], last[part + 1]
        text = np.repeat(np.arange(len(end) - 1), np.diff(np.append(0, np.cumsum(b - a))[end - end[0]]))
        key = (text << 32) + place[_ranges(a, b)]
        key.sort()
        at = np.flatnonzero(np.diff(key, prepend=-1))
        first = np.searchsorted(key[at], np.arange(len(end)) << 32)
        places, counts = (key[at] & 0xFFFFFFFF).astype(np.int32), np.diff(np.append(at, len(key))).astype(np.int32)
        yield [(places[i:j], counts[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]


def vector(places, counts, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.asarray(places, np.int32)
    w = (1 + np.log(np.asarray(counts, float))) * weight[p]
    return p, w / _norm(w) if len(p) else w


def _norm(w: np.ndarray) -> float:
    return max(float(np.linalg.norm(w)), 1e-300)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers first[0]..last[0]-1, first[1]..last[1]-1, ..."""
    n = last - first
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


class BlockMaxIndex:
    """Exact nearest vectors by cosine from a block-max inverted index, which
    is built where it is first used (pickled are the vectors).

    A weight is ``base`` of its term times ``scale`` of its vector times a
    value. Most values are 1, so that a posting is the vector's place alone;
    ``more`` has the others' value - 1. Postings lie in rows of ``ROW``, the
    last one of a term filled up with place n."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK):
        self._own(np.concatenate([p for p, _ in vectors]).astype(np.int32) if vectors else np.zeros(0, np.int32),
                  np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0),
                  np.append(0, np.cumsum([len(p) for p, _ in vectors], dtype=np.int64)), terms, block)
        self.base, self.scale = np.ones(terms), np.ones(self.n)

    def _own(self, term: np.ndarray, value: np.ndarray, first: np.ndarray, terms: int, block: int) -> None:
        self.n, self.terms, self.block, self.visited = len(first) - 1, terms, block, 0
        self.blocks = max(1, -(-self.n // block))
        self.own_term, self.own_value, self.own_first, self.counts = term, value, first, False

    @classmethod
    def joined(cls, term: np.ndarray, count: np.ndarray, first: np.ndarray, weight: np.ndarray, block: int = BLOCK) -> BlockMaxIndex:
        """Of the ``vector`` of terms and counts that lie one after the other,
        from ``first`` on."""
        out = cls.__new__(cls)
        out._own(term, count, first, len(weight), block)
        out.counts, out.base = True, weight
        out.scale = 1 / np.array([_norm((1 + np.log(count[a:b].astype(float))) * weight[term[a:b]]) for a, b in zip(first[:-1], first[1:], strict=True)])
        return out

    @property
    def own_weight(self) -> np.ndarray:
        if not self.counts:
            return self.own_value
        out = np.empty(len(self.own_term))
        for a, b in zip(self.own_first[:-1], self.own_first[1:], strict=True):
            out[a:b] = vector(self.own_term[a:b], self.own_value[a:b], self.base)[1]
        return out

    def __getstate__(self) -> dict:
        kept = ("n", "terms", "block", "visited", "blocks", "own_term", "own_value", "own_first", "counts", "base", "scale")
        return {k: self.__dict__[k] for k in kept}

    def _build(self) -> None:
        if "postings" in self.__dict__:
            return
        place = np.min_scalar_type(self.n)
        of = np.repeat(np.arange(self.n, dtype=place), np.diff(self.own_first))
        n = np.bincount(self.own_term, minlength=self.terms)
        self.row_first = np.append(0, np.cumsum(-(-n // ROW))).astype(np.int32)
        self.postings = np.full(int(self.row_first[-1]) * ROW, self.n, place)
        more = np.bincount(self.own_term[self.own_value != 1], minlength=self.terms)
        self.more_first = np.append(0, np.cumsum(more)).astype(np.int32)
        self.more_of, self.more = np.empty(int(self.more_first[-1]), place), np.empty(int(self.more_first[-1]))
        # Postings by (term, vector), the terms of about PART at a time.
        last = np.cumsum(n)
        cuts = np.unique(np.append(np.searchsorted(last, np.arange(0, len(self.own_term), PART)), self.terms))
        for t, u in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.flatnonzero((self.own_term >= t) & (self.own_term < u))
            at = at[np.argsort(self.own_term[at], kind="stable")]
            gap = self.row_first[t:u].astype(np.int64) * ROW - (last[t:u] - n[t:u])
            self.postings[np.arange(last[t] - n[t], last[u - 1]) + np.repeat(gap, n[t:u])] = of[at]
            at = at[self.own_value[at] != 1]
            part = slice(self.more_first[t], self.more_first[u])
            self.more_of[part], self.more[part] = of[at], self._values(at) - 1
        self.postings = self.postings.reshape(-1, ROW)
        # For whole scans: rows of the most frequent terms, and their values by vector.
        often = np.sort(np.argsort(-n, kind="stable")[:DENSE])
        self.row = np.full(self.terms, -1, np.int32)
        self.row[often] = np.arange(len(often))
        at = np.flatnonzero(self.row[self.own_term] >= 0)
        self.often_row, self.often_value = self.row[self.own_term[at]].astype(np.int16), self._values(at)
        self.often_first = np.searchsorted(at, self.own_first)
        self.dense = np.zeros((len(often), self.n), np.float32)
        self.dense[self.often_row, of[at]] = self.often_value * self.scale[of[at]]

    def _values(self, at: np.ndarray) -> np.ndarray:
        return 1 + np.log(self.own_value[at].astype(float)) if self.counts else self.own_value[at]

    def _posting(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of a term's vectors."""
        of = self.postings[self.row_first[p]:self.row_first[p + 1]].ravel().astype(np.int64)
        of = of[of < self.n]
        more = slice(self.more_first[p], self.more_first[p + 1])
        weight = np.ones(len(of))
        weight[np.searchsorted(of, self.more_of[more])] += self.more[more]
        return of, weight * self.base[p] * self.scale[of]

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest with a cosine over 0, ties by
        place; ``without`` is left out."""
        self._build()
        lists = [(*self._posting(p), w) for p, w in zip(places, weights, strict=True)]
        bound = np.zeros(self.blocks)
        for of, weight, w in lists:
            first = np.flatnonzero(np.diff(of // self.block, prepend=-1))
            if len(first):
                bound[of[first] // self.block] += np.maximum.reduceat(weight, first) * w
        order = np.argsort(-bound, kind="stable")
        ids, cos, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for b in order:
            if bound[b] <= 0 or len(ids) >= k and bound[b] < least - 1e-12:
                break
            self.visited += 1
            score = np.zeros(self.block)
            for of, weight, w in lists:
                s = slice(*np.searchsorted(of, (b * self.block, (b + 1) * self.block)))
                score[of[s] - b * self.block] += weight[s] * w
            hit = np.flatnonzero(score > 0)
            hit = hit[hit + b * self.block != without]
            ids, cos = np.append(ids, hit + b * self.block), np.append(cos, score[hit])
            best = np.lexsort((ids, -np.round(cos, 12)))[:k]
            ids, cos = ids[best], cos[best]
            least = cos[-1] if len(cos) >= k else 0.0
        return ids, np.minimum(cos, 1.0)

    def nearest_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None,
                     batch: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each query, long ones by whole scans."""
        self._build()
        for start in range(0, len(queries), batch):
            part = queries[start:start + batch]
            q = np.zeros((len(part), len(self.dense)))
            for row, (p, w) in zip(q, part, strict=True):
                if len(p) > FEW:
                    r = self.row[p]
                    often = r >= 0
                    row[r[often]] = w[often] * self.base[p[often]]
            scores = q.astype(np.float32) @ self.dense
            for i, (p, w) in enumerate(part):
                out = without[start + i] if without else -1
                if len(p) <= FEW:
                    yield self.nearest(p, w, k, out)
                    continue
                rare = self.row[p] < 0
                p, w = p[rare], w[rare] * self.base[p[rare]]
                a, b = self.row_first[p], self.row_first[p + 1]
                of = self.postings[_ranges(a, b)]
                sums = np.bincount(of.ravel(), np.repeat(w, (b - a) * ROW), self.n + 1)[:-1]
                a, b = self.more_first[p], self.more_first[p + 1]
                at = _ranges(a, b)
                sums += np.bincount(self.more_of[at], self.more[at] * np.repeat(w, b - a), self.n)
                score = sums * self.scale
                score += scores[i]
                if out >= 0:
                    score[out] = 0
                # Single precision errs by far less than the margin: no term is negative.
                least = np.partition(score, -k)[-k] if k < self.n else 0.0
                ids = np.flatnonzero(score >= max(least * (1 - 1e-4) - 1e-11, 1e-12))
                a, b = self.often_first[ids], self.often_first[ids + 1]
                at = _ranges(a, b)
                often = np.bincount(np.repeat(np.arange(len(ids)), b - a), self.often_value[at] * q[i][self.often_row[at]], len(ids))
                cos = (sums[ids] + often) * self.scale[ids]
                best = np.lexsort((ids, -np.round(cos, 12)))[:k]
                yield ids[best], np.minimum(cos[best], 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: the steps' middle x and their mean y."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


class Model:
    """Index, labels of the distinct example vectors and calibration."""

    def __init__(self, examples: list[tuple], space: dict[str, int], weight: np.ndarray, class_weight: tuple[float, float]):
        """examples: (doc_id, label, places, counts)."""
        self.space, self.weight, self.class_weight = space, weight, class_weight
        groups: dict[bytes, list] = {}
        for doc_id, label, places, counts in sorted(examples, key=lambda e: (e[0] is not None, e[0])):
            places, counts = np.asarray(places, np.int32), np.asarray(counts, np.int32)
            key = hashlib.blake2b(places.tobytes() + counts.tobytes()).digest() if len(places) else b""
            g = groups.setdefault(key, [0, 0, [], places, _small(counts)])
            g[label] += 1
            if len(g[2]) < 3:
                g[2].append(doc_id)
        empty = groups.pop(b"", [0, 0])
        self.none = self._share(*empty[:2]) if sum(empty[:2]) else self._share(
            sum(e[1] == 0 for e in examples), sum(e[1] == 1 for e in examples))
        self.rows = np.array([g[:2] for g in groups.values()], float).reshape(-1, 2)
        self.ids = [g[2] for g in groups.values()]
        self.places = np.concatenate([np.zeros(0, np.int32), *(g[3] for g in groups.values())])
        self.counts = np.concatenate([np.zeros(0, np.uint8), *(g[4] for g in groups.values())])
        self.first = np.append(0, np.cumsum([len(g[3]) for g in groups.values()], dtype=np.int64))
        self.steps = (np.zeros(0), np.zeros(0))
        self.vectors = len(groups)
        self.held: tuple[str, Broadcast] | None = None

    def __getstate__(self) -> dict:
        """Without the index; with the space as one Arrow array."""
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "space", "held")} | {"terms": self.terms}

    def shipped(self, spark: SparkSession) -> Broadcast:
        """The model's only broadcast, whatever uses it: a worker builds and
        holds one index. ``steps`` may change after it and are passed along."""
        sc = spark.sparkContext
        if self.held is None or self.held[0] != sc.applicationId:
            self.held = sc.applicationId, sc.broadcast(self)
        return self.held[1]

    @functools.cached_property
    def terms(self) -> pa.StringArray:
        return pa.array(sorted(self.space, key=self.space.__getitem__), pa.string())

    @functools.cached_property
    def index(self) -> BlockMaxIndex:
        """Built where it is first used; pickled are the counts, which take
        less than half of what the weights do."""
        return BlockMaxIndex.joined(self.places, self.counts, self.first, self.weight)

    def own_votes(self, some: range | list[int]) -> list[tuple[float, int, float]]:
        """Vote, label and weight of the example vectors ``some``; an example
        does not vote for itself."""
        own = [(i, label) for i in some for label in (0, 1) if self.rows[i][label]]
        vectors = [vector(self.places[a:b], self.counts[a:b], self.weight) for i, _ in own for a, b in [self.first[i:i + 2]]]
        return [(vote, label, float(self.rows[i][label] * self.class_weight[label]))
                for (i, label), (vote, _, _) in zip(own, self._votes(vectors, own), strict=True) if vote is not None]

    def calibrate(self, votes: list[tuple[float, int, float]]) -> None:
        if len({y for _, y, _ in votes}) == 2:
            x, y, w = np.array(sorted(votes)).T
            self.steps = isotonic(x, y, w)

    def _share(self, n0: float, n1: float) -> float:
        a, b = n0 * self.class_weight[0], n1 * self.class_weight[1]
        return float(b / (a + b)) if a + b else 0.0

    def _votes(self, vectors: list[tuple], minus: list[tuple[int, int]] | None = None) -> Iterator[tuple]:
        """Vote, neighbours and cosines of each vector; ``minus`` has the
        (example, label) that does not vote."""
        alone = [i if self.rows[i].sum() <= 1 else -1 for i, _ in minus] if minus else None
        for n, (ids, cos) in enumerate(self.index.nearest_many(vectors, NEIGHBOURS, alone)):
            if not len(ids):
                yield None, [], []
                continue
            rows = self.rows[ids].copy()
            if minus is not None and alone[n] < 0:
                rows[ids == minus[n][0], minus[n][1]] -= 1
            w = (rows * np.array(self.class_weight)) / (1 - cos + SOFT)[:, None]
            total = w.sum()
            yield (float(w[:, 1].sum() / total) if total > 0 else None), ids, cos

    def scores(self, counted: list[tuple], steps: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, list, list[float]]]:
        """Probability calibrated by ``steps``, nearest example ids, their
        cosines of the (places, counts) of each text."""
        for vote, ids, cos in self._votes([vector(p, c, self.weight) for p, c in counted]):
            if vote is None:
                yield self.none, [], []
                continue
            if len(steps[0]):
                vote = float(np.interp(vote, *steps))
            yield min(1.0, max(0.0, vote)), [self.ids[i][0] for i in ids[:3]], [round(float(c), 6) for c in cos[:3]]


def sketch(text: str) -> int:
    """The least hash of the 5-word shingles: nearly all near copies share it."""
    w = _WORD.findall(text.lower())
    return min(zlib.crc32(" ".join(w[i:i + 5]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(w) - 4)))


def _examples(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[dict, tuple[float, float]]:
    """id -> label of the sampled examples, and the classes' weights."""
    counts = {r["y"]: r["count"] for r in labels.groupBy("y").count().collect()}
    rate = {y: min(1.0, per_class / n) for y, n in counts.items()}
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labels.where(u < F.when(F.col("y") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0)))
    # The hash sample is about per_class a label; twice it at most.
    rows = chosen.orderBy(F.xxhash64("doc_id")).limit(4 * per_class).collect()
    out = {r["doc_id"]: int(r["y"]) for r in rows}
    n = {y: max(1, sum(v == y for v in out.values())) for y in (0, 1)}
    total = max(1, sum(counts.values()))
    return out, (counts.get(0, 0) / total / n[0], counts.get(1, 0) / total / n[1])


def gains(a: np.ndarray, b: np.ndarray, n0: float, n1: float) -> np.ndarray:
    """1 for a term that tells nothing of the label, up to 1 + GAIN; ``a`` and
    ``b`` are its examples of label 0 and 1."""
    n = n0 + n1
    chi2 = n * (b * (n0 - a) - a * (n1 - b)) ** 2 / (n0 * n1 * np.maximum(a + b, 1.0) * np.maximum(n - a - b, 1.0))
    lift = ((b + 0.5) / (n1 + 1)) / ((a + 0.5) / (n0 + 1))
    power = (chi2 / CHI2) ** 4
    return 1 + GAIN * power / (1 + power) * np.minimum(1.0, np.maximum(lift, 1 / lift) / LIFT) ** 4


def _space(example_docs: DataFrame, of: dict) -> tuple[dict[str, int], np.ndarray]:
    """All terms of the examples and their gains (near copies, which share a
    sketch, count once)."""
    held = example_docs.sparkSession.sparkContext.broadcast(of)

    def terms(once: bool):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n: dict[str, list[int]] = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                y = held.value[doc_id]
                for t in {t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)}:
                    n.setdefault(t, [0, 0])[y] += once
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([x[0] for x in n.values()], pa.int64()),
                                               pa.array([x[1] for x in n.values()], pa.int64())], names=["term", "n0", "n1"])
        return run

    kinds = "term string, n0 long, n1 long"
    t = common.map_batches(example_docs, terms(False), kinds).unionByName(
        common.map_batches(example_docs.dropDuplicates(["sketch"]), terms(True), kinds))
    t = t.groupBy("term").agg(F.sum("n0").cast("double").alias("a"), F.sum("n1").cast("double").alias("b"))
    t = t.toArrow().sort_by("term")
    held.destroy()
    n0, n1 = (float(max(1, sum(v == y for v in of.values()))) for y in (0, 1))
    return ({term: i for i, term in enumerate(t.column("term").to_pylist())},
            gains(t.column("a").to_numpy(), t.column("b").to_numpy(), n0, n1))


def _fetched(sample: DataFrame, of: dict) -> Iterator[tuple]:
    """(doc_id, label, places, counts) of the examples' vectors, as bytes and a
    partition at a time: the driver's JVM never holds them all."""
    id_type = sample.schema["doc_id"].dataType.simpleString()

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [pa.array([x.values.to_numpy().tobytes() for x in batch.column(c)], pa.binary()) for c in (1, 2)]
        return pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "places", "counts"])

    for r in common.map_batches(sample, packed, f"doc_id {id_type}, places binary, counts binary").toLocalIterator():
        yield r["doc_id"], of[r["doc_id"]], np.frombuffer(r["places"], np.int32), _small(np.frombuffer(r["counts"], np.int32))


def _small(counts: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        label_id: str = "doc_id", training: Column | None = None, per_class: int = PER_CLASS) -> Model:
    """The model, from the label rows where ``training`` holds. The texts are
    read twice (the examples' terms; document frequencies of all documents
    and the examples' vectors) and never shuffled but for the examples'."""
    spark = docs.sparkSession
    common.prepare(spark)
    y = labels.where(training) if training is not None else labels
    y = y.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    y = common.stored(y.groupBy("doc_id").agg(F.max("y").alias("y")), "toxicity-labels")
    of, class_weight = _examples(docs, y, per_class)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = thin.schema["doc_id"].dataType.simpleString()
    known = spark.sparkContext.broadcast(of)

    # Copies and near copies count once: else a long copied text makes terms.
    def sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(pa.array([i in known.value for i in batch.column(0).to_pylist()], pa.bool_()))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([sketch(t) for t in batch.column(1).to_pylist()], pa.int64())],
                                          names=["doc_id", "text", "sketch"])

    examples = common.stored(
        common.map_batches(thin.where("text is not null"), sketched, f"doc_id {id_type}, text string, sketch long"), "toxicity-examples")
    space, gain = _space(examples, of)
    words = spark.sparkContext.broadcast(pa.array(list(space), pa.string()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "df", "doc_id", "places", "counts"]
        kinds = [pa.int32(), pa.int64(), None, pa.list_(pa.int32()), pa.list_(pa.int32())]
        df, n = np.zeros(len(words.value), np.int64), 0
        for batch in batches:
            kinds[2] = batch.column(0).type
            rows = []
            n += batch.num_rows
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, counted in zip(range(0, len(ids), TEXTS), term_counts(texts, words.value)):
                df += np.bincount(np.concatenate([p for p, _ in counted]), minlength=len(df))
                rows += [(None, None, ids[i], *v) for i, v in enumerate(counted, start) if ids[i] in known.value and texts[i] is not None]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        if n:  # place -1: the documents
            at = np.flatnonzero(df)
            cols = [np.append(-1, at).astype(np.int32), np.append(n, df[at])]
            none = [pa.nulls(len(at) + 1, k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=False)), *none], names=names)

    seen = common.stored(thin.mapInArrow(count, f"place int, df long, doc_id {id_type}, places array<int>, counts array<int>"), "toxicity-fit")
    df = np.zeros(len(space) + 1)  # last: the documents
    rows = seen.where("place is not null").groupBy("place").agg(F.sum("df").alias("df")).toArrow()
    df[rows.column("place").to_numpy()] = rows.column("df").to_numpy()
    weight = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * gain
    words.destroy()
    known.destroy()
    sample = seen.where("place is null").groupBy("doc_id").agg(F.min(F.struct("places", "counts")).alias("v"))
    model = Model(list(_fetched(sample.select("doc_id", "v.places", "v.counts"), of)), space, weight, class_weight)
    common.release_memory()
    common.release_shuffles(spark)  # and the driver's copies of what it has fetched
    held = model.shipped(spark)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = held.value.own_votes(batch.column(0).to_pylist())
                kinds = (pa.float64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([v[k] for v in found], t) for k, t in enumerate(kinds)],
                                                 names=["vote", "label", "weight"])

    parts = max(1, min(spark.sparkContext.defaultParallelism, model.vectors // 256))
    rows = spark.range(0, model.vectors, 1, parts).mapInArrow(votes, "vote double, label int, weight double").collect()
    model.calibrate([tuple(r) for r in rows])
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the columns ``name`` (the probability), ``name_example_ids``
    and ``name_example_cosines`` (the evidence). No shuffle. ``name`` is to be
    one that ``docs`` does not use."""
    names = [name, f"{name}_example_ids", f"{name}_example_cosines"]
    if taken := sorted(set(names) & set(docs.columns)):
        raise ValueError(f"the table has columns {taken}: give another name")
    spark = docs.sparkSession
    common.prepare(spark)
    held, steps = model.shipped(spark), model.steps
    at = docs.columns.index(text_col)
    text_ids = bool(model.ids) and isinstance(model.ids[0][0], str)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            out = []
            for counted in term_counts(batch.column(at).to_pylist(), m.terms):
                out += m.scores(counted, steps)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([o[0] for o in out], pa.float64()),
                 pa.array([o[1] for o in out], pa.list_(pa.string() if text_ids else pa.int64())),
                 pa.array([o[2] for o in out], pa.list_(pa.float64()))],
                names=[*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields, StructField(names[0], DoubleType()),
                         StructField(names[1], ArrayType(StringType() if text_ids else LongType())),
                         StructField(names[2], ArrayType(DoubleType()))])
    return docs.mapInArrow(run, schema)
