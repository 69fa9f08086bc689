"""Ranked lexical search through hashed max-sketches.

Terms are the maximal runs of ASCII letters and digits and of all other
characters beyond ASCII, with A-Z lower-cased. A document's score for an item
is the sum over the item's different terms of weight * impact, in integers (see
``weights`` and ``impacts``).

1. One pass over all documents counts N, L and the document frequencies of the
   items' terms.
2. A second pass writes the index, a row a document: its length, its text and
   its sketch. The impacts of the document's terms are folded by a hash of the
   term into a power of two of places, ``PLACES_PER_TERM`` or more a term, each
   of which holds the greatest impact that falls there, rounded up to one of
   255 levels. A look-up at a term's place is never below its impact.
3. Items come in batches. For each document the look-ups of all items' terms
   give an upper bound of its score with each item. The ``k`` documents of the
   greatest bounds are scored exactly; the k-th best score starts the item's
   threshold.
4. Each task takes its documents in the order of falling bounds, scores those
   exactly whose bound reaches the threshold of some item, raises the
   thresholds by what it finds, and stops where no bound reaches one. The best
   ``k`` of all tasks are merged.

No text is shuffled. The driver and the tasks hold one batch of items (about
``BATCH_ITEMS`` rows and ``BATCH_BYTES`` bytes of text, one item at least) and
``k`` row numbers and one threshold an item.

Defined cases: a null text and a text without a term have no term and count
neither in N nor in L; such items have no results. Each row of the documents is
a document, repeated ids and texts included. Of items that repeat an id, the
one with the smallest text counts; an item or document with a null id is one
like any other (a null id ranks last among equal scores). Empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common

K = 50
PLACES_PER_TERM = 8
BATCH_ITEMS = 1000
BATCH_BYTES = 8 << 20
DOCS_AT_ONCE = 64
# Greatest impact of each code; code 0 is an empty place.
LEVELS = np.r_[0, np.unique(np.ceil(np.exp(np.linspace(0, math.log(10**6), 255))).astype(np.int64))]
# Bytes of terms as they are, A-Z in lower case, others a blank.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 50 + 50 * n * n_docs // n_terms


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return 10**9 * tf // (1000 * tf + 20 * m)


def sketch(counts: dict[bytes, int], m: int) -> bytes:
    """Codes of the places' greatest impacts."""
    width = 1 << max(3, (PLACES_PER_TERM * len(counts) - 1).bit_length())
    impact = impacts(np.fromiter(counts.values(), np.int64, len(counts)), m)
    at = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts)) & np.uint64(width - 1)
    out, order = np.zeros(width, np.uint8), np.argsort(impact, kind="stable")
    out[at[order]] = np.searchsorted(LEVELS, impact[order])  # of equal places the greatest is written last
    return out.tobytes()


class Batch:
    """The items of a batch: their terms, and for each slot (an item's term) the
    term's number."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        of_item = [sorted(set(terms(t))) for _, t in items]
        self.vocabulary = sorted(set().union(*of_item)) if of_item else []
        number = {t: i for i, t in enumerate(self.vocabulary)}
        self.one_based = {t: i + 1 for t, i in number.items()}
        self.used = np.array([i for i, x in enumerate(of_item) if x], np.int64)  # items with a term
        self.slots = np.array([number[t] for x in of_item for t in x], np.int64)
        self.starts = np.cumsum([0] + [len(x) for x in of_item if x])[:-1].astype(np.int64)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary), np.uint64, len(self.vocabulary))
        self.weight = np.zeros(len(self.vocabulary), np.int64)

    def sums(self, impact: np.ndarray) -> np.ndarray:
        """Scores, documents x used items, from impacts, documents x terms."""
        return np.add.reduceat((impact * self.weight)[:, self.slots], self.starts, axis=1)

    def bounds(self, sketches: pa.Array) -> np.ndarray:
        """Upper bounds, documents x used items; 0 without a sketch."""
        flat, out = np.frombuffer(sketches.buffers()[2] or b"", np.uint8), np.zeros((len(sketches), len(self.used)), np.int64)
        offset = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset:sketches.offset + len(sketches) + 1].astype(np.int64)
        width = np.diff(offset)
        for w in np.unique(width[width > 0]):
            at = (self.hashes & np.uint64(w - 1)).astype(np.int64)
            rows = np.flatnonzero(width == w)
            for some in np.array_split(rows, -(-len(rows) // DOCS_AT_ONCE)):
                out[some] = self.sums(LEVELS[flat[offset[some][:, None] + at]])
        return out

    def scores(self, texts: list[str], ms: list[int]) -> np.ndarray:
        """Exact scores, documents x used items."""
        impact = np.zeros((len(texts), len(self.vocabulary)), np.int64)
        for i, (text, m) in enumerate(zip(texts, ms, strict=True)):
            found = Counter(filter(None, map(self.one_based.get, terms(text))))
            if found:
                impact[i, np.fromiter(found, np.int64, len(found)) - 1] = impacts(np.fromiter(found.values(), np.int64, len(found)), m)
        return self.sums(impact)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = K, batch_items: int = BATCH_ITEMS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item
    with a score above 0, ties by id."""
    spark = docs.sparkSession
    corpus = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    # One row an id: the smallest text.
    asked = items.groupBy(F.col(item_id).alias("item_id")).agg(F.min(F.col(item_text).cast("string")).alias("text"))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    batches = max(1, -(-size["n"] // batch_items), -(-(size["b"] or 0) // batch_bytes))
    if batches > 1:
        asked = common.stored(asked, "items")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches))
    kind = {f.name: f.dataType.simpleString() for f in corpus.schema} | {"item_id": asked.schema["item_id"].dataType.simpleString()}
    index, out = None, None
    for i in range(batches):
        batch = Batch([(r["item_id"], r["text"]) for r in asked.where(part == i).orderBy("item_id").collect()])
        n_docs, n_terms, df = counted(corpus, batch)
        if not len(batch.used) or not n_docs:
            continue
        batch.weight = weights(n_docs, df)
        if index is None:
            index = written_index(corpus, n_docs, n_terms)
        found = _searched(index, batch, k, kind)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind['item_id']}, rank int, doc_id {kind['doc_id']}, score long")
    return out


def counted(corpus: DataFrame, batch: Batch) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms, document frequencies of the batch's
    terms) over the whole corpus; each task returns its sums."""
    held = corpus.sparkSession.sparkContext.broadcast(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        n_docs, n_terms, df = 0, 0, np.zeros(len(b.vocabulary), np.int64)
        for rows in batches:
            for text in rows.column(0).to_pylist():
                own = terms(text)
                if own:
                    n_docs += 1
                    n_terms += len(own)
                    df[[x - 1 for x in set(map(b.one_based.get, own)) if x]] += 1
        if n_docs:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, at].astype(np.int32)), pa.array(np.r_[n_docs, n_terms, df[at]].astype(np.int64))], names=["term", "n"])

    common.prepare(corpus.sparkSession)
    sums = corpus.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    held.destroy()
    total = dict(zip(sums.column("term").to_pylist(), sums.column("n").to_pylist(), strict=True))
    df = np.zeros(len(batch.vocabulary), np.int64)
    for t, n in total.items():
        if t >= 0:
            df[t] = n
    return total.get(-2, 0), total.get(-1, 0), df


def written_index(corpus: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(row, doc_id, m, sketch, text) of all documents with a term, stored."""
    kind = corpus.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, ms, sketches = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            own = terms(text)
            if own:
                m = length_factor(len(own), n_docs, n_terms)
                keep.append(i)
                ms.append(m)
                sketches.append(sketch(Counter(own), m))
        some = batch.take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays([some.column(0), pa.array(ms, pa.int64()), pa.array(sketches, pa.binary()), some.column(1)],
                                          names=["doc_id", "m", "sketch", "text"])

    rows = common.map_batches(corpus, run, f"doc_id {kind}, m long, sketch binary, text string")
    return common.stored(rows.withColumn("row", F.monotonically_increasing_id()), "max-sketches")


def _kept(best: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The best of either, items x k."""
    both = np.concatenate([best, new], axis=1)
    return np.partition(both, both.shape[1] - best.shape[1], axis=1)[:, -best.shape[1]:]


def _searched(index: DataFrame, batch: Batch, k: int, kind: dict[str, str]) -> DataFrame:
    sc = index.sparkSession.sparkContext
    held = sc.broadcast(batch)

    # The documents of the greatest bounds.
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        top_b, top_r = np.zeros((len(b.used), 0), np.int64), np.zeros((len(b.used), 0), np.int64)
        for rows in batches:
            bound = np.concatenate([top_b, b.bounds(rows.column(1)).T], axis=1)
            place = np.concatenate([top_r, np.broadcast_to(rows.column(0).to_numpy(), (len(b.used), rows.num_rows))], axis=1)
            at = np.argpartition(-bound, min(k, bound.shape[1]) - 1, axis=1)[:, :k]
            top_b, top_r = np.take_along_axis(bound, at, axis=1), np.take_along_axis(place, at, axis=1)
        i = np.repeat(np.arange(len(b.used)), top_b.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(top_r.ravel()), pa.array(top_b.ravel())], names=["item", "row", "bound"])

    common.prepare(index.sparkSession)
    w = Window.partitionBy("item").orderBy(F.desc("bound"), "row")
    top = index.select("row", "sketch").mapInArrow(heads, "item long, row long, bound long")
    top = top.withColumn("_r", F.row_number().over(w)).where((F.col("_r") <= k) & (F.col("bound") > 0)).select("row").distinct()
    chosen = sc.broadcast(np.sort(top.toArrow().column("row").to_numpy()))  # k an item at most

    # Their exact scores start the thresholds.
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        best = np.zeros((len(b.used), k), np.int64)
        for rows in batches:
            rows = rows.filter(pa.array(np.isin(rows.column(0).to_numpy(), chosen.value, kind="sort")))
            for at in range(0, rows.num_rows, DOCS_AT_ONCE):
                some = rows.slice(at, DOCS_AT_ONCE)
                best = _kept(best, b.scores(some.column(2).to_pylist(), some.column(1).to_pylist()).T)
        i, j = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int64)), pa.array(best[i, j])], names=["item", "s"])

    scored = index.select("row", "m", "text").mapInArrow(exact, "item long, s long")
    w = Window.partitionBy("item").orderBy(F.desc("s"))
    kth = scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == k).select("item", "s").collect()  # a number an item
    start = np.ones(len(batch.used), np.int64)  # scores above 0 only
    for r in kth:
        start[r["item"]] = r["s"]
    started = sc.broadcast(start)

    # All documents, by falling bounds, until the thresholds.
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        best = np.zeros((len(b.used), k), np.int64)
        bar = started.value.copy()
        for rows in batches:
            bound = b.bounds(rows.column(2))
            order = np.argsort(-(bound - bar).max(axis=1, initial=-1), kind="stable")
            found = []
            while len(order):
                order = order[(bound[order] >= bar).any(axis=1)]  # the rest cannot be among the best
                now, order = order[:DOCS_AT_ONCE], order[DOCS_AT_ONCE:]
                if not len(now):
                    break
                some = rows.take(pa.array(now))
                s = b.scores(some.column(3).to_pylist(), some.column(1).to_pylist())
                best = _kept(best, s.T)
                d, i = np.nonzero(s >= bar)
                found.append((now[d], i, s[d, i]))
                bar = np.maximum(bar, best.min(axis=1))
            if found:
                d, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
                keep = s >= bar[i]
                yield pa.RecordBatch.from_arrays([pa.array(i[keep].astype(np.int64)), rows.column(0).take(pa.array(d[keep])), pa.array(s[keep])],
                                                 names=["item", "doc_id", "score"])

    found = index.select("doc_id", "m", "sketch", "text").mapInArrow(descend, f"item long, doc_id {kind['doc_id']}, score long")
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    names = index.sparkSession.createDataFrame([(i, batch.ids[x]) for i, x in enumerate(batch.used.tolist())], f"item long, item_id {kind['item_id']}")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
