"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words (``BUCKETS`` places) over all texts;
   the places of all their words are stored in the same pass.
2. Randomised SVD of the TF-IDF passages: of all texts, cut into passages of
   ``PASSAGE`` words that share their text's weight (all texts together weigh
   as much as ``TEXTS_WEIGHT`` passages, or a passage each if they are fewer),
   and of all benchmark passages with weight ``ITEM_WEIGHT``. The columns that
   it starts from come from steps over the benchmark passages and one passage
   of each of ``SAMPLE`` documents; the vectors and values come from a product
   ``A^T (A Q)`` over all rows, summed over the partitions of the passage
   table, only ``BUCKETS x rank`` matrices on the driver. The rank follows the
   number of benchmark passages from ``RANK`` to ``MAX_RANK``; beyond that a
   space of ``MAX_RANK`` holds them all.
3. Every text is cut into blocks of ``STEP`` words; sums of ``WINDOWS`` blocks
   are its passages. A passage whose surroundings hold fewer answer words (of
   all benchmark passages together) than the check of step 4 asks of any of
   them cannot pass it and is left out. The latent vectors of the others
   (folded in with the inverse singular values) are compared with all benchmark
   passages (a stated query set, in blocks); a cosine of ``MIN_COSINE`` makes
   a candidate.
4. A candidate counts if the longest common subsequence of words with the
   surrounding region covers ``MIN_LCS`` of the benchmark passage and
   ``MIN_ANSWER`` of its answer words are there: the words of its answer if
   the benchmark has one, else its ``ANSWER_WORDS`` rarest words.

Texts are never shuffled and no text is cut short: blocks cover all words.
Benchmark items come to the driver in slices of ``SLICE`` at most.

Defined cases: null and empty texts contain nothing; null or empty items are
contained in nothing; repeated documents are reported each time, repeated
items (same id) by one row a document; items under ``SHORT`` words must be
there whole; equal hits: the first place; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

BUCKETS = 1 << 15
RANK = 96
MAX_RANK = 256
EXTRA = 8
ITEM_WEIGHT = 3.0
POWER = 2
SAMPLE = 4096
TEXTS_WEIGHT = 4096
STEP = 16
PASSAGE = 4 * STEP
CHUNK = 512  # passages multiplied at once, their entries in groups
GROUP = 16  # that meet the few rows of the basis they need
WINDOWS = (2, 3, 4)
MIN_COSINE = 0.45
MIN_LCS = 0.6
MIN_ANSWER = 0.6
ANSWER_WORDS = 5
SHORT = 8
SLICE = 20_000
_WORD = re.compile(r"[^\W_]+")
_ASCII_MARKS = {i: None for i in range(128) if not (chr(i).isalnum() or chr(i).isspace())}
_CACHED = 1_200_000


class _Hashed(dict):
    """Word -> bucket; emptied when it is full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED:
            self.clear()
        out = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return out


_PLACES = _Hashed()


def words_of(text: str | None) -> list[str]:
    """Lower-cased words: letters and digits of each run of non-blanks."""
    text = (text or "").lower()
    if text.isascii():
        return text.translate(_ASCII_MARKS).split()
    return [c for w in text.split() if (c := w if w.isalnum() else "".join(_WORD.findall(w)))]


def buckets_of(text: str | list[str] | set[str] | np.ndarray | None) -> np.ndarray:
    """The buckets of words, or of a text's words (in the order of ``words_of``)."""
    if isinstance(text, np.ndarray):
        return text
    words = words_of(text) if text is None or isinstance(text, str) else text
    return np.fromiter(map(_PLACES.__getitem__, words), np.int32, len(words))


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


# --------------------------------------------------------------- statistics
def _statistics(thin: DataFrame, n_docs: int) -> tuple[np.ndarray, DataFrame]:
    """Document frequencies of the buckets (last: the documents) and the
    table of the texts that have words (``places``: buckets of all its words,
    two bytes each; ``weight``; ``key``, if the texts have one)."""
    keyed = "key" in thin.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS + 1, np.int64), 0
        names = ["bucket", "df", "places", "key"]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        for batch in batches:
            places, keys = [], []
            for text, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist() if keyed else repeat(None), strict=keyed):
                buckets = buckets_of(words_of(text))
                df[buckets] += 1  # once, however often a place is named
                n += 1
                if len(buckets):
                    places.append(_packed(buckets))
                    keys.append(key)
            if places:
                none = [None] * len(places)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((none, none, places, keys), kinds, strict=True)], names=names)
        if n:
            df[BUCKETS] = n
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(at, kinds[0]), pa.array(df[at]), pa.array([None] * len(at), kinds[2]), pa.array([None] * len(at), kinds[3])], names=names)

    seen = common.stored(thin.mapInArrow(run, "bucket int, df long, places binary, key long"), "decontam-fit")
    df = np.zeros(BUCKETS + 1)
    sums = seen.where("bucket is not null").groupBy("bucket").agg(F.sum("df").alias("df")).toArrow()
    df[sums.column("bucket").to_numpy()] = sums.column("df").to_numpy()
    weight = math.sqrt(min(1.0, TEXTS_WEIGHT / max(1, n_docs)))
    return df, seen.where("places is not null").select("places", F.lit(weight).alias("weight"), "key")


def _packed(buckets: np.ndarray) -> bytes:
    return buckets.astype("<u2").tobytes()


def _passages(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, place) of each word of the rows (places, weight) and the
    weight of each passage: a row is cut after every ``PASSAGE`` words, and
    its passages share its weight."""
    held = batch.column(0)
    if pa.types.is_binary(held.type):
        held = [np.frombuffer(p, "<u2") for p in held.to_pylist()]
        lens = np.fromiter(map(len, held), np.int64, len(held))
        places = np.concatenate(held) if held else np.zeros(0, np.int64)
    else:
        lens, places = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), held.flatten().to_numpy()
    many = -(-lens // PASSAGE)
    of = np.repeat(np.arange(len(lens)), lens)
    word = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    weight = batch.column(1).to_numpy(zero_copy_only=False) / np.sqrt(np.maximum(many, 1))
    return (np.cumsum(many) - many)[of] + word // PASSAGE, places, np.repeat(weight, many)


def _add_products(out: np.ndarray, basis: np.ndarray, idf: np.ndarray, row: np.ndarray, place: np.ndarray, weight: np.ndarray, room: np.ndarray) -> None:
    """Adds ``A^T (A basis)`` to ``out``, A the normalised TF-IDF rows (times
    their ``weight``) of some passages, given by (row, place) of each word. A
    group of passages is a small dense matrix over the places it names; the
    rows of the basis and of ``out`` that it needs are held in ``room``."""
    key, times = np.unique(row * BUCKETS + place, return_counts=True)
    row, at = np.divmod(key, BUCKETS)
    w = (times * idf[at]).astype(np.float32)
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(weight)))
    w *= (weight / np.where(norm > 0, norm, 1)).astype(np.float32)[row]
    named, column = np.unique(row // GROUP * BUCKETS + at, return_inverse=True)
    group, named = np.divmod(named, BUCKETS)
    groups = np.arange(-(-len(weight) // GROUP) + 1)
    ends, cuts = np.searchsorted(group, groups), np.searchsorted(row, groups * GROUP)
    rows, cells, (some, more) = row % GROUP, column - ends[row // GROUP], room
    for first, last, a, b in zip(ends[:-1], ends[1:], cuts[:-1], cuts[1:], strict=True):
        need, held, part = named[first:last], some[:last - first], np.zeros((GROUP, last - first), np.float32)
        part[rows[a:b], cells[a:b]] = w[a:b]
        np.take(basis, need, axis=0, out=held, mode="clip")
        sums = np.matmul(part.T, part @ held, out=more[:last - first])
        np.take(out, need, axis=0, out=held, mode="clip")
        held += sums
        out[need] = held


def _times(passages: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``A^T (A q)`` for the passages of the rows (places, weight): partial
    sums in the partitions, at most one a core, since each is a whole matrix,
    then a sum for each slice of the buckets."""
    spark = passages.sparkSession
    held = spark.sparkContext.broadcast((idf, q))
    width, step = q.shape[1], 2048

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, basis = held.value
        out = None
        for batch in batches:
            if out is None:
                out, room = np.zeros((BUCKETS, width), np.float32), np.empty((2, GROUP * PASSAGE, width), np.float32)
            row, place, weight = _passages(batch)
            for at in range(0, len(weight), CHUNK):
                a, b = np.searchsorted(row, (at, at + CHUNK))
                _add_products(out, basis, weights, row[a:b] - at, place[a:b], weight[at:at + CHUNK], room)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(0, BUCKETS, step), pa.int32()),
                                              pa.array([out[i:i + step].tobytes() for i in range(0, BUCKETS, step)])], names=["at", "part"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float32) for p in pdf["part"])
        return pd.DataFrame({"at": [int(pdf["at"].iloc[0])], "part": [total.astype(np.float32).tobytes()]})

    some = passages.coalesce(max(1, spark.sparkContext.defaultParallelism))
    sums = some.mapInArrow(partial, "at int, part binary").groupBy("at").applyInPandas(add, "at int, part binary")
    out = np.zeros((BUCKETS, width), np.float32)
    for r in sums.toLocalIterator():  # a partition at a time
        out[r["at"]:r["at"] + step] = np.frombuffer(r["part"], np.float32).reshape(-1, width)
    held.destroy()
    return out


def rank_of(passages: int) -> int:
    """The rank for so many benchmark passages."""
    return min(MAX_RANK, max(RANK, passages))


def orthonormal(a: np.ndarray, step: int = 4096) -> np.ndarray:
    """An orthonormal basis of the columns of ``a`` (overwritten) by Cholesky QR
    done twice, some rows at a time: LAPACK's QR holds several copies in double
    precision, which is what the driver's memory went on."""
    for _ in range(2):
        gram = np.zeros((a.shape[1], a.shape[1]))
        for at in range(0, len(a), step):
            part = a[at:at + step].astype(np.float64)
            gram += part.T @ part
        try:
            back = np.linalg.inv(np.linalg.cholesky(gram)).T
        except np.linalg.LinAlgError:  # columns that depend on each other
            return np.linalg.qr(a)[0]
        for at in range(0, len(a), step):
            a[at:at + step] = a[at:at + step].astype(np.float64) @ back
    return a


def _random_start(width: int, step: int = 2048) -> np.ndarray:
    rng = np.random.default_rng(7)
    out = np.empty((BUCKETS, width), np.float32)
    for at in range(0, BUCKETS, step):
        out[at:at + step] = rng.standard_normal((min(step, BUCKETS - at), width))
    return out


def sampled(texts: DataFrame, n_docs: int) -> DataFrame:
    """(places, weight): a passage of each of about ``SAMPLE`` texts, by key."""
    some = texts.where(F.pmod("key", F.lit(2 ** 32)) < F.lit(SAMPLE / max(1, n_docs) * 2 ** 32))
    at = F.pmod(F.shiftright("key", 33), F.greatest(F.lit(1), F.octet_length("places") / 2 - PASSAGE + 1).cast("long")).cast("int")
    return some.select(F.substring("places", at * 2 + 1, F.lit(2 * PASSAGE)).alias("places"), F.lit(1.0).alias("weight"))


def start_of(passages: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Columns to start from, by subspace iteration over some passages."""
    q = orthonormal(_random_start(rank + EXTRA))
    for _ in range(POWER + 1):
        q = orthonormal(_times(passages, idf, q))
    return q


def latent_basis(passages: DataFrame, idf: np.ndarray, rank: int = RANK, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (BUCKETS x rank) and singular values of all
    passages of the table (places, weight) by randomised subspace iteration:
    ``POWER`` steps from random columns, none from a ``start`` (overwritten).
    From the last product Z = A^T A Q they are those of Z (Q^T Z)^-1 Z^T
    (Nystroem), which is a step closer than a Rayleigh-Ritz step in Q."""
    q = orthonormal(_random_start(rank + EXTRA) if start is None else start)
    for _ in range(POWER if start is None else 0):
        q = orthonormal(_times(passages, idf, q))
    z = _times(passages, idf, q)
    values, vectors = np.linalg.eigh(_inner(q, z))
    del q
    # Directions without a part in any passage are left out of the inverse root.
    back = vectors * np.where(values > 1e-6 * values.max(initial=0), 1 / np.sqrt(np.maximum(values, 1e-30)), 0)
    z = _by_rows(z, back)
    values, vectors = np.linalg.eigh(_inner(z, z))
    best = np.argsort(-values)[:rank]
    values = np.sqrt(np.maximum(values[best], 0))
    back = vectors[:, best] * np.where(values > 1e-6 * values.max(initial=0), 1 / np.maximum(values, 1e-30), 0)
    return _by_rows(z, back), values.astype(np.float32)


def _inner(a: np.ndarray, b: np.ndarray, step: int = 4096) -> np.ndarray:
    """``a^T b``, symmetric, in double precision, some rows at a time."""
    out = sum(a[at:at + step].astype(np.float64).T @ b[at:at + step].astype(np.float64) for at in range(0, len(a), step))
    return (out + out.T) / 2


def _by_rows(a: np.ndarray, b: np.ndarray, step: int = 4096) -> np.ndarray:
    """``a @ b`` in single precision, some rows at a time in double."""
    out = np.empty((len(a), b.shape[1]), np.float32)
    for at in range(0, len(a), step):
        out[at:at + step] = a[at:at + step].astype(np.float64) @ b
    return out


# ------------------------------------------------------------------- search
def item_passages(items: list[tuple], idf: np.ndarray, answers: dict | None = None) -> list[tuple]:
    """(item_id, words, answer words) of each benchmark passage."""
    out = []
    for item_id, text in items:
        tokens = words_of(text)
        for at in range(0, len(tokens), PASSAGE):
            part = tokens[at:at + PASSAGE]
            if at and len(part) < SHORT:
                continue
            answer = words_of((answers or {}).get(item_id))
            if not answer:
                weight = {w: idf[_PLACES[w]] for w in part}
                answer = sorted(weight, key=lambda w: (-weight[w], w))[:ANSWER_WORDS]
            out.append((item_id, part, frozenset(answer)))
    return out


def _needed(part: list[str]) -> float:
    """Words of a passage that must be there in order."""
    return len(part) if len(part) < SHORT else MIN_LCS * len(part)


def verify(part: list[str], answer: frozenset, region: list[str]) -> float:
    """The covered share of the passage, 0 if a check fails."""
    if len(answer.intersection(region)) < MIN_ANSWER * len(answer):
        return 0.0
    found = lcs_length(part, region)
    return found / len(part) if found >= _needed(part) else 0.0


class Searcher:
    def __init__(self, parts: list[tuple], idf: np.ndarray, basis: np.ndarray, values: np.ndarray):
        """Folding in: a passage's latent vector is its TF-IDF vector times
        the singular vectors over the singular values, which keeps what all
        texts of a language share from outweighing the rest."""
        self.parts = parts
        self.answers = frozenset().union(*(p[2] for p in parts))
        self.least = min((math.ceil(MIN_ANSWER * len(p[2])) for p in parts), default=1)
        self.reach = max((len(p[1]) for p in parts), default=0) // 2
        self.projection = (basis / np.maximum(values, 1e-3 * values.max(initial=1e-9))) * idf[:, None].astype(np.float32)
        q = np.stack([self.projection[buckets_of(p[1])].sum(axis=0) for p in parts]) if parts else np.zeros((0, basis.shape[1]), np.float32)
        self.items = (q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)).T.astype(np.float32)

    def windows(self, words: list[str]) -> list[tuple[int, np.ndarray]]:
        """(blocks, first blocks) of a text's passages whose surroundings hold
        the fewest answer words that any benchmark passage asks for."""
        at = np.flatnonzero(np.fromiter(map(self.answers.__contains__, words), bool, len(words)))
        if len(at) < self.least:
            return []
        starts = np.arange(0, len(words), STEP)
        before = np.searchsorted(at, starts - self.reach)
        out = []
        for blocks in WINDOWS:
            many = np.searchsorted(at, starts + (blocks * STEP + self.reach)) - before >= self.least
            # Passages that only repeat the end of a longer one are left out.
            many[max(1, len(starts) - blocks + 1):] = False
            if many.any():
                out.append((blocks, np.flatnonzero(many)))
        return out

    def candidates(self, docs: list, windows: list | None = None) -> Iterator[tuple[int, int, int, int, float]]:
        """(document, part, first word, words, cosine) of passages near a
        benchmark passage; of all passages (of words or buckets) if no
        ``windows`` of the documents are given."""
        for d, words in enumerate(docs):
            blocks_of = -(-len(words) // STEP)
            every = [(n, np.arange(max(1, blocks_of - n + 1))) for n in WINDOWS if blocks_of]
            for blocks, first in every if windows is None else windows[d]:
                for at in range(0, len(first), 1024):  # long texts: some passages at a time
                    some = first[at:at + 1024]
                    near = self._cosines(words, some, blocks)
                    for i, j in zip(*np.nonzero(near >= MIN_COSINE), strict=True):
                        yield d, int(j), int(some[i]) * STEP, blocks * STEP, float(near[i, j])

    def _cosines(self, words: list[str], first: np.ndarray, blocks: int) -> np.ndarray:
        """Passages (by first block) x benchmark passages. A block is folded in
        once; a passage ends with its document, so it may be shorter."""
        last = (len(words) - 1) // STEP
        need, place = np.unique(np.minimum(first[:, None] + np.arange(blocks), last), return_inverse=True)
        held = [buckets_of(words[b * STEP:(b + 1) * STEP]) for b in need]
        sums = np.add.reduceat(self.projection[np.concatenate(held)], np.cumsum([0] + [len(part) for part in held[:-1]]), axis=0)
        place = place.reshape(len(first), blocks)
        there = (first[:, None] + np.arange(blocks) <= last)[:, :, None]
        passages = (sums[place] * there).sum(axis=1)
        return (passages / np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-9)) @ self.items

    def hits(self, texts: list[str | None]) -> list[tuple[int, int, float, float, int]]:
        """(document, part, cosine, covered share, first word), the best of
        each (document, part)."""
        docs = [words_of(t) for t in texts]
        found: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
        for d, j, at, n, cos in self.candidates(docs, [self.windows(words) for words in docs]):
            found.setdefault((d, j), []).append((-cos, at, n))
        out = []
        for (d, j), places in found.items():
            _, part, answer = self.parts[j]
            best = (0.0, 0.0, 0)
            for cos, at, n in sorted(places):
                a, e = max(0, at - len(part) // 2), at + n + len(part) // 2
                # Words in common bound the subsequence from above.
                there = set(docs[d][a:e])
                if sum(w in there for w in part) < _needed(part):
                    continue
                share = verify(part, answer, docs[d][a:e])
                if share > best[0]:
                    best = (share, -cos, a)
                if share >= 0.999:
                    break
            if best[0]:
                out.append((d, j, best[1], best[0], best[2]))
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """(doc_id, item_id, cosine, covered, first_word): the benchmark items
    found in each document."""
    spark = docs.sparkSession
    common.prepare(spark)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(id_col, F.lit(3)).alias("key"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"),
                             (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer"))
    id_type, item_type = (f.dataType.simpleString() for f in (thin.schema["doc_id"], items.schema["item_id"]))
    common.release_memory()  # what earlier steps of the same driver left
    n_docs = thin.select("doc_id").count()
    df, texts = _statistics(thin, n_docs)
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])).clip(0)

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [_packed(b[at:at + PASSAGE]) for x in batch.column(1).to_pylist() for b in [buckets_of(x)] for at in range(0, len(b), PASSAGE)]
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["places"])

    # Benchmark passages weigh more than the texts: the space is for them.
    asked = common.map_batches(items.select("item_id", "text"), places, "places binary").withColumn("weight", F.lit(ITEM_WEIGHT))
    asked = common.stored(asked, "decontam-passages")
    rank = rank_of(asked.count())
    some = asked.unionByName(sampled(texts, n_docs)).repartition(max(1, spark.sparkContext.defaultParallelism // 2))
    start = start_of(common.stored(some, "decontam-start"), idf, rank)
    basis, values = latent_basis(texts.drop("key").unionByName(asked), idf, rank, start)
    common.release_shuffles(spark)  # and the driver's copies of the products
    slices = max(1, -(-items.count() // SLICE))
    out = None
    for s in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == s).collect()
        parts = item_passages([(r["item_id"], r["text"]) for r in rows], idf, {r["item_id"]: r["answer"] for r in rows})
        held = spark.sparkContext.broadcast((parts, idf, basis, values))
        hits = thin.select("doc_id", "text").mapInArrow(
            _search(held), f"doc_id {id_type}, item_id {item_type}, cosine double, covered double, first_word long")
        out = hits if out is None else out.unionByName(hits)
    return out


def _search(held):
    """The search of a partition's texts with a broadcast slice of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*held.value)
        parts = searcher.parts
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                found = searcher.hits(part.column(1).to_pylist())
                best: dict[tuple, tuple] = {}
                for d, j, cos, share, first in found:
                    best[d, parts[j][0]] = max(best.get((d, parts[j][0]), (0.0, 0.0, 0)), (share, cos, -first))
                if best:
                    ids = part.column(0).take(pa.array([d for d, _ in best]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([i for _, i in best]), pa.array([b[1] for b in best.values()]),
                         pa.array([b[0] for b in best.values()]), pa.array([-b[2] for b in best.values()], pa.int64())],
                        names=["doc_id", "item_id", "cosine", "covered", "first_word"])

    return run
