"""Katz backoff language model: training and scoring on Spark.

Model of order ``n`` over words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and
one end token a text; a text starts with a start symbol as history.

* ``P(w|h) = d(c) c(hw) / c(h)`` for seen n-grams, else ``alpha(h) P(w|h')``
  with the shorter history ``h'``, down to single words; all unknown words
  together are one event.
* ``d`` is the Good-Turing discount of counts up to ``CUTOFF`` (Katz's form),
  1 above; where counts of counts give none in (0, 1) it is ``(c - 1/2) / c``.
* ``alpha(h) = (1 - sum of P(w|h) seen) / (1 - sum of P(w|h') of the same w)``
  exactly. A history whose counts are all above the cutoff has no mass left;
  its denominator is then ``c(h) + 1``.

How it scales: texts become blocks of about ``BLOCK_TOKENS`` tokens (numbers
into the block's own sorted list of 64-bit word hashes), written once to the
shared folder. Everything else is an exchange keyed by the top bits of an
n-gram's hash: each block sends its distinct keys and training counts, a task
for each key range adds them up (that range of the count table of that order)
and sends every block the totals of its keys in their order, with a mark for
the one block that owns a seen n-gram. Owners then send the sums behind
``c(h)`` and ``alpha(h)`` to the ranges of the histories in the same way.
Blocks never hold more than their own keys, key ranges are uniform hashes of
pre-aggregated keys (a word pair in every text is one entry a block), their
number follows the number of blocks, and the driver sees only counts of
counts. N-grams are told apart by 64-bit hashes.

Defined cases: a null text is empty (one end token, the history is the
start); null or repeated ids are rows of their own; without training texts
every word is unknown (N = 0, every event has the base probability 1 of the
single unknown event); an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

BLOCK_TOKENS = 2_000_000
CUTOFF = 5
# White space cannot be in a word, so these are no words.
END, START = b"\n", b"\n\n"
_U = np.uint64


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def _combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return common.splitmix(a * _U(0x9E3779B97F4A7C15) + b)


# ------------------------------------------------------------------ blocks
class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


def _blocks(thin: DataFrame, id_type: str, block_tokens: int) -> DataFrame:
    """(doc_id, text, held_out) -> one row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        words, ids, held, tokens, size = _Numbers(), [], [], [], 0
        words[END]

        def block() -> pa.RecordBatch:
            hashes = np.fromiter(map(_hash, words), np.uint64, len(words))
            order = np.argsort(hashes)
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            flat = place[np.concatenate(tokens)]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_arrow)), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([np.array([len(t) for t in tokens], np.uint32).tobytes()]), pa.array([zlib.compress(flat.tobytes(), 1)]),
                 pa.array([hashes[order].tobytes()])], names=["block", "ids", "held", "lengths", "tokens", "words"])

        for batch in batches:
            id_arrow = batch.column(0).type
            for doc_id, text, out in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = text.encode("utf-8", "surrogatepass").lower().split()
                found.append(END)
                ids.append(doc_id)
                held.append(bool(out))
                tokens.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                size += len(found)
                if size >= block_tokens:
                    yield block()
                    number, words, ids, held, tokens, size = number + 1, _Numbers(), [], [], [], 0
                    words[END]
        if ids:
            yield block()

    return thin.mapInArrow(run, f"block long, ids array<{id_type}>, held array<boolean>, lengths binary, tokens binary, words binary")


class Block:
    """A block's events (token positions) and their n-gram keys."""

    def __init__(self, row):
        self.ids, self.held = list(row["ids"]), np.asarray(list(row["held"]), bool)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.tokens = np.frombuffer(zlib.decompress(row["tokens"]), np.uint32)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.train = np.repeat(~self.held, self.lengths)
        first = np.zeros(len(self.tokens), bool)
        first[np.cumsum(self.lengths) - self.lengths] = True
        self.first = first

    def histories(self, m: int) -> np.ndarray:
        """Key of the m - 1 words before each event."""
        word = self.words[self.tokens]
        key, start = None, _U(_hash(START))
        for _ in range(m - 1):
            before = np.empty_like(word)
            before[0] = start
            before[1:] = word[:-1]
            before[self.first] = start
            key = before if key is None else _combine(before, key)
            word = before
        return key

    def grams(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys, each event's place in them, an event of each."""
        if m == 1:
            return self.words, self.tokens, np.zeros(0, np.int64)
        keys, first, place = np.unique(_combine(self.histories(m), self.words[self.tokens]), return_index=True, return_inverse=True)
        return keys, place, first


def _slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Key ranges by the top bits that hold any of the sorted keys."""
    edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits))
    ends = np.append(edges[1:], len(keys))
    for b in np.flatnonzero(ends > edges):
        yield int(b), slice(int(edges[b]), int(ends[b]))


def _small(x: np.ndarray) -> bytes:
    """Non-negative whole numbers in the fewest bytes that hold the largest."""
    top = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top < 1 << 8 * int(t[2]))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: a byte with the width of what follows, then either all
    keys, or the first one and gaps of 6 bytes where these fit (nearly always:
    the keys of a range are uniform and many)."""
    gaps = np.diff(keys)
    if len(gaps) and int(gaps.max()) < 1 << 48:
        return b"\6" + keys[:1].tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return b"\x08" + keys.tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    if data[0] == 8:
        return np.frombuffer(data, np.uint64, offset=1)
    gaps = np.zeros(((len(data) - 9) // 6, 8), np.uint8)
    gaps[:, :6] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    return np.cumsum(np.append(np.frombuffer(data, np.uint64, 1, 1), gaps.view(np.uint64).reshape(-1)), dtype=np.uint64)


_REQUEST = "kind string, bucket int, block long, keys binary, nums binary"
_ANSWER = "kind string, bucket int, block long, nums binary, own binary, stats array<long>"


def _exchange_counts(requests: DataFrame) -> DataFrame:
    """Totals of the keys of each range, sent back in each block's order."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        keys = [_unpack_keys(k) for k in pdf["keys"]]
        nums = [_wide(n, len(k)) for n, k in zip(pdf["nums"], keys, strict=True)]
        _, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(place, np.concatenate(nums)).astype(np.int64)
        own = np.zeros(len(place), bool)
        own[first[total > 0]] = True
        ends = np.cumsum([len(k) for k in keys])
        cut = [slice(e - len(k), e) for e, k in zip(ends, keys, strict=True)]
        kind, bucket = pdf["kind"].iloc[0], int(pdf["bucket"].iloc[0])
        # N, V and the counts of counts of this range.
        stats = [int(total.sum()), int((total > 0).sum()), *(int((total == r).sum()) for r in range(1, CUTOFF + 2))]
        out = [(kind, bucket, int(b), _small(total[place[s]]), np.packbits(own[s]).tobytes(), None) for b, s in zip(pdf["block"], cut, strict=True)]
        return pd.DataFrame([*out, (kind, bucket, -1, None, None, stats)], columns=["kind", "bucket", "block", "nums", "own", "stats"])

    return requests.groupBy("kind", "bucket").applyInPandas(add, _ANSWER)


def _exchange_histories(requests: DataFrame) -> DataFrame:
    """c(h) (as the denominator in use) and alpha(h) from the owners' sums."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        keys = [_unpack_keys(k) for k in pdf["keys"]]
        sums = np.concatenate([np.frombuffer(n, np.float64).reshape(3, -1) for n in pdf["nums"]], axis=1)
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        count, seen, lower = (np.bincount(place, s) for s in sums)
        # No mass left (nothing discounted): one more in the denominator.
        bottom = count + ((count > 0) & (count - seen < 1e-9 * np.maximum(count, 1)))
        alpha = np.where(count > 0, (1 - seen / np.maximum(bottom, 1)) / np.maximum(1 - lower, 1e-15), 1.0)
        ends = np.cumsum([len(k) for k in keys])
        out = [(pdf["kind"].iloc[0], int(pdf["bucket"].iloc[0]), int(b), _small(bottom[place[e - len(k):e]].astype(np.int64)),
                alpha[place[e - len(k):e]].tobytes(), None) for b, e, k in zip(pdf["block"], ends, keys, strict=True)]
        return pd.DataFrame(out, columns=["kind", "bucket", "block", "nums", "own", "stats"])

    return requests.groupBy("kind", "bucket").applyInPandas(add, _ANSWER)


# ------------------------------------------------------------------- model
def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d(0..CUTOFF + 1), d(0) = 0 and the last 1, from n(1)..n(CUTOFF + 1)."""
    n, k = [0, *counts_of_counts], CUTOFF
    out = np.ones(k + 2)
    out[0] = 0.0
    for r in range(1, k + 1):
        d = 0.0
        if n[1] and n[r]:
            tail = (k + 1) * n[k + 1] / n[1]
            if tail < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    """Sizes and discounts of each order: what the driver knows."""

    def __init__(self, stats: dict[str, list[int]]):
        none = [0] * (CUTOFF + 3)
        self.total, self.types = stats.get("c1", none)[:2]
        self.discount = {int(k[1:]): discounts(v[2:]) for k, v in stats.items()}
        # What seen words leave to the unknown event, exactly.
        n, d = stats.get("c1", none), self.discount.get(1, discounts([0] * (CUTOFF + 1)))
        lost = sum((1 - d[r]) * r * n[1 + r] for r in range(1, CUTOFF + 1))
        self.bottom = float(self.total) + (1.0 if self.total and lost < 1e-9 else 0.0)
        self.unknown = (lost if lost >= 1e-9 else 1.0) / self.bottom if self.total else 1.0

    def seen(self, m: int, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return self.discount[m][np.minimum(c, CUTOFF + 1)] * c

    def words(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.seen(1, c) / max(self.bottom, 1.0), self.unknown) if self.total else np.ones(len(c))


def _answers(pdf: pd.DataFrame, kind: str, sizes: dict[int, int], own: str) -> tuple[np.ndarray, np.ndarray]:
    rows = pdf[pdf["kind"] == kind].sort_values("bucket")
    nums = np.concatenate([_wide(n, sizes[b]) for n, b in zip(rows["nums"], rows["bucket"], strict=True)])
    if own == "bits":
        return nums, np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=sizes[b]).astype(bool)
                                     for o, b in zip(rows["own"], rows["bucket"], strict=True)])
    return nums, np.concatenate([np.frombuffer(o, np.float64) for o in rows["own"]])


def _replay(block: Block, pdf: pd.DataFrame, model: Model, upto: int, bits: int):
    """Counts of the block's words and the events' probabilities by the
    orders up to ``upto``."""
    sizes = lambda keys: {b: s.stop - s.start for b, s in _slices(keys, bits)}
    counts, _ = _answers(pdf, "c1", sizes(block.words), "bits")
    p = model.words(counts)[block.tokens]
    for m in range(2, upto + 1):
        keys, place, _ = block.grams(m)
        c = _answers(pdf, f"c{m}", sizes(keys), "bits")[0][place]
        histories, at = np.unique(block.histories(m), return_inverse=True)
        bottom, alpha = _answers(pdf, f"h{m}", sizes(histories), "floats")
        p = np.where(c > 0, model.seen(m, c) / np.maximum(bottom[at], 1), alpha[at] * p)
    return counts, p


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
          block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    for every document; learned from those that are not held out."""
    spark = docs.sparkSession
    common.prepare(spark)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    id_type = thin.schema["doc_id"].dataType.simpleString()
    blocks = common.stored(_blocks(thin, id_type, block_tokens), "lm-blocks")
    n_blocks = blocks.select("block").count()
    bits = max(3, math.ceil(math.log2(max(1, n_blocks))) + 1)
    orders = range(1, order + 1)

    def ask_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            b = Block(row)
            for m in orders:
                keys, place, _ = b.grams(m)
                n = np.bincount(place[b.train], minlength=len(keys))
                rows = [(f"c{m}", k, row["block"], _pack_keys(keys[s]), _small(n[s])) for k, s in _slices(keys, bits)]
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=[x.split()[0] for x in _REQUEST.split(", ")])

    answers = common.stored(_exchange_counts(common.map_batches(blocks, ask_counts, _REQUEST)), "lm-counts")
    common.release_shuffles(spark)
    stats: dict[str, list[int]] = {}
    parts = answers.where("block = -1").select("kind", F.posexplode("stats").alias("i", "n"))
    for r in parts.groupBy("kind", "i").agg(F.sum("n").alias("n")).collect():
        stats.setdefault(r["kind"], [0] * (CUTOFF + 3))[r["i"]] = r["n"]
    model = Model(stats)
    answers = answers.where("block >= 0").drop("stats")

    def with_blocks(tables: DataFrame) -> DataFrame:
        """Each block and the answers to it, to be grouped by block."""
        return blocks.withColumn("kind", F.lit("block")).unionByName(tables, allowMissingColumns=True).groupBy("block")

    def ask_histories(m: int):
        def ask(pdf: pd.DataFrame) -> pd.DataFrame:
            b = Block(pdf[pdf["kind"] == "block"].iloc[0])
            _, p = _replay(b, pdf, model, m - 1, bits)
            keys, _, first = b.grams(m)
            c, own = _answers(pdf, f"c{m}", {k: s.stop - s.start for k, s in _slices(keys, bits)}, "bits")
            histories, at = np.unique(b.histories(m), return_inverse=True)
            mine = np.flatnonzero(own)
            h, c = at[first[mine]], c[mine]
            sums = np.stack([np.bincount(h, w, minlength=len(histories)) for w in (c, model.seen(m, c), p[first[mine]])])
            number = int(pdf["block"].iloc[0])
            return pd.DataFrame([(f"h{m}", k, number, _pack_keys(histories[s]), np.ascontiguousarray(sums[:, s]).tobytes())
                                 for k, s in _slices(histories, bits)], columns=[x.split()[0] for x in _REQUEST.split(", ")])

        return ask

    for m in range(2, order + 1):
        asked = with_blocks(answers).applyInPandas(ask_histories(m), _REQUEST)
        known = common.stored(_exchange_histories(asked).drop("stats"), "lm-histories")
        common.release_shuffles(spark)
        answers = answers.unionByName(known)

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Block(pdf[pdf["kind"] == "block"].iloc[0])
        counts, p = _replay(b, pdf, model, order, bits)
        c = counts[b.tokens]
        base = np.log10((c + 0.1) / (model.total + 0.1 * (model.types + 1)))
        starts = np.cumsum(b.lengths) - b.lengths
        return pd.DataFrame({"doc_id": b.ids, "held_out": b.held, "n_tokens": b.lengths,
                             "n_known": np.add.reduceat((c > 0).astype(np.int64), starts), "train_tokens": model.total,
                             "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts)})

    return with_blocks(answers).applyInPandas(
        finish, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
