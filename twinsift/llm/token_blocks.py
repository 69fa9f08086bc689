"""Token ids in patched frame-of-reference blocks.

File format of a segment (one binary value; little-endian):

* header: magic ``PFB1``, u32 blocks, u32 documents, u64 ids;
* documents: u32 ids of each document in order (their end id included);
* block index: u32 byte offset of every block from the first block;
* blocks of ``BLOCK`` ids: u32 minimum, u8 width, u8 exceptions, then the
  ids minus the minimum packed at ``width`` bits (low bits of exceptions
  included), then the exceptions: u8 position each, u32 high bits each.

The width of a block is that of the value at ``PERCENTILE`` of the block;
larger values keep their low bits in place and their high bits in the list.

Documents are range-partitioned and sorted by id; every partition is a shard
whose rows are segments of whole documents with at least ``SEGMENT`` ids. The
segments are written through Spark's committed Parquet writer (any store, a
lost task writes again) with the ids of their documents and their place in
the shard. A document's global start is its shard's offset (a running sum of
one total a shard) plus its place in the shard.

Defined cases: a null text is empty (only the end id); repeated ids are
ordered by their texts' hash; a null id sorts first; an empty table gives no
segments; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common

BLOCK = 128
PERCENTILE = 0.9
SEGMENT = 1 << 18
MAGIC = b"PFB1"
CACHED = 500_000


# ------------------------------------------------------------ file format
def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) uint32 -> (n, width * BLOCK / 8) bytes, low bit first. One
    step a column, over all blocks of the width at once."""
    cols = np.ascontiguousarray(values.T).astype(np.uint64) & np.uint64((1 << width) - 1)
    out = np.zeros((BLOCK * width // 64, len(values)), np.uint64)
    for k in range(BLOCK if width else 0):
        at, shift = divmod(k * width, 64)
        out[at] |= cols[k] << np.uint64(shift)
        if shift + width > 64:
            out[at + 1] |= cols[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(len(values), BLOCK * width // 8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((BLOCK, len(packed)), np.uint32)
    if width:
        full = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").astype(np.uint64).T)
        mask = np.uint64((1 << width) - 1)
        for k in range(BLOCK):
            at, shift = divmod(k * width, 64)
            v = full[at] >> np.uint64(shift)
            if shift + width > 64:
                v |= full[at + 1] << np.uint64(64 - shift)
            out[k] = v & mask
    return np.ascontiguousarray(out.T)


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def encode_segment(ids: np.ndarray, doc_lengths: list[int]) -> bytes:
    """The binary image of a segment."""
    n_blocks = -(-len(ids) // BLOCK)
    head = struct.pack("<4sIIQ", MAGIC, n_blocks, len(doc_lengths), len(ids))
    docs = np.asarray(doc_lengths, "<u4").tobytes()
    if not n_blocks:
        return head + docs
    full = np.full(n_blocks * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(n_blocks, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    lengths = _bit_length(rest)
    at = min(BLOCK - 1, int(BLOCK * PERCENTILE))
    width = np.partition(lengths, at, axis=1)[:, at]
    over = lengths > width[:, None]
    n_over = over.sum(axis=1)
    size = BLOCK * width.astype(np.int64) // 8
    ends = np.cumsum(6 + size + 5 * n_over)
    starts = ends - (6 + size + 5 * n_over)
    out = np.zeros(int(ends[-1]), np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4], out[starts + 5] = width, n_over
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        out[(starts[rows] + 6)[:, None] + np.arange(BLOCK * int(w) // 8)] = _pack(rest[rows], int(w))
    r, pos = np.nonzero(over)
    at_pos, at_high = _exceptions(starts + 6 + size, n_over, r)
    out[at_pos] = pos
    out[at_high[:, None] + np.arange(4)] = (rest[r, pos] >> width[r].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    return b"".join([head, docs, starts.astype("<u4").tobytes(), out.tobytes()])


def _exceptions(tail: np.ndarray, n_over: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places of the position and of the high bits of every exception,
    ``r`` being its block."""
    first = np.cumsum(n_over) - n_over
    rank = np.arange(len(r)) - first[r]
    return tail[r] + rank, tail[r] + n_over[r] + 4 * rank


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the document lengths of a segment."""
    magic, n_blocks, n_docs, n_ids = struct.unpack_from("<4sIIQ", data)
    if magic != MAGIC:
        raise ValueError("not a segment of token blocks")
    at = struct.calcsize("<4sIIQ")
    docs = np.frombuffer(data, "<u4", n_docs, at)
    at += 4 * n_docs
    if not n_blocks:
        return np.zeros(0, np.uint32), docs
    starts = np.frombuffer(data, "<u4", n_blocks, at).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, offset=at + 4 * n_blocks)
    low = raw[starts[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    width, n_over = raw[starts + 4], raw[starts + 5].astype(np.int64)
    out = np.zeros((n_blocks, BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = BLOCK * int(w) // 8
        out[rows] = _unpack(raw[(starts[rows] + 6)[:, None] + np.arange(size)], int(w))
    r = np.repeat(np.arange(n_blocks), n_over)
    at_pos, at_high = _exceptions(starts + 6 + BLOCK * width.astype(np.int64) // 8, n_over, r)
    high = raw[at_high[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    out[r, raw[at_pos]] |= high << width[r].astype(np.uint32)
    out += low[:, None]
    return out.reshape(-1)[:n_ids], docs


def read_block(data: bytes, block: int) -> np.ndarray:
    """One block by the index, without decoding the others."""
    _, n_blocks, n_docs, n_ids = struct.unpack_from("<4sIIQ", data)
    index = struct.calcsize("<4sIIQ") + 4 * n_docs
    p = index + 4 * n_blocks + struct.unpack_from("<I", data, index + 4 * block)[0]
    low, width, k = struct.unpack_from("<IBB", data, p)
    size = BLOCK * width // 8
    out = _unpack(np.frombuffer(data, np.uint8, size, p + 6)[None, :], width)[0]
    pos = np.frombuffer(data, np.uint8, k, p + 6 + size)
    out[pos] |= np.frombuffer(data, "<u4", k, p + 6 + size + k) << np.uint32(width)
    return (out + np.uint32(low))[: n_ids - block * BLOCK]


# ---------------------------------------------------------------- encoding
class Recent(dict):
    """A cache of two generations: when it holds ``CACHED`` entries they become
    the old generation, from which an entry comes back when it is asked for.
    Texts have many words that are seen once; what is seen again stays."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def made(self, key: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, key: str) -> bytes:
        out = self.old.pop(key, None) or self.made(key)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out


class Pieces(Recent):
    """piece -> its ids as little-endian bytes, by the tokenizer's model."""

    def __init__(self, tokenizer, width: str):
        super().__init__()
        self.tokenize, self.letters = tokenizer.model.tokenize, dict(enumerate(_byte_letters()))
        self.pack = [struct.Struct(f"<{n}{width}").pack for n in range(64)]
        self.width = width

    def made(self, piece: str) -> bytes:
        # Letters and digits of ASCII stand for themselves.
        plain = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(plain)]
        return self.pack[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}{self.width}", *ids)


class WordEncoder(Recent):
    """word -> its ids as little-endian bytes, made by the tokenizers library.

    The tokenizer cuts a lower-cased text at white space, then into pieces by
    a pattern, and runs its model on each piece alone. For a plain text
    (ASCII, Latin letters that have one code point in either case) that is
    done here with a look-up for words seen before; the pieces of a new word
    are cut by the tokenizer's own pattern. Any other text, and any tokenizer
    of another shape, goes through ``encode`` whole.
    """

    plain = re.compile(r"[\n -~À-ÖØ-öø-įĲ-ňŊ-ž]*")

    def __init__(self, path: str, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.dtype, self.split = Tokenizer.from_file(path), dtype, None
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        if (norm == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
                and steps[0].get("invert") and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")):
            self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
            self.pieces = Pieces(self.tokenizer, {"<u2": "H", "<u4": "I"}[dtype])

    def made(self, word: str) -> bytes:
        # A word of letters is one piece, kept here only.
        return self.pieces.made(word) if word.isalpha() else b"".join(map(self.pieces.__getitem__, self.split(word)))

    def is_plain(self, text: str) -> bool:
        return bool(self.split and self.plain.fullmatch(text)) and not any(s in text for s in self.special)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. The words of all plain texts are numbered
        together; each different one is looked up once, and the ids are gathered
        by number."""
        plain = [self.is_plain(t) for t in texts]
        cut = pc.split_pattern(pa.array([t.lower().replace("\n", " ") for t, p in zip(texts, plain, strict=True) if p], pa.string()), " ")
        coded = cut.flatten().dictionary_encode()
        found = [self[w] for w in coded.dictionary.to_pylist()]
        size = np.dtype(self.dtype).itemsize
        n = np.fromiter(map(len, found), np.int64, len(found)) // size
        flat, first, at = np.frombuffer(b"".join(found), self.dtype), np.cumsum(n) - n, coded.indices.to_numpy(zero_copy_only=False)
        times = n[at]
        ids = flat[np.arange(times.sum()) + np.repeat(first[at] - (np.cumsum(times) - times), times)]
        ends = np.r_[0, np.cumsum(times)][np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))].tolist()
        spans = iter(zip([0, *ends], ends, strict=False))
        return [ids[slice(*next(spans))] if p else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.dtype)
                for t, p in zip(texts, plain, strict=True)]

    def ids(self, text: str) -> bytes:
        return self.many([text])[0].tobytes()


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(256 + n)
        n += b not in shown
    return out


_ENCODERS: dict[tuple[str, str], WordEncoder] = {}


def encoder(path: str, dtype: str) -> WordEncoder:
    """One encoder a worker process."""
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = WordEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", segment_ids: int = SEGMENT) -> None:
    """Encode every whole text, append ``end_id`` and write the segments in
    ascending id order to ``path``. One shuffle (by id range)."""
    spark = docs.sparkSession
    common.prepare(spark)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = thin.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id())
    id_type = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, "<u4")
        end = np.array([end_id], "<u4")
        shard, place, size = 0, 0, 0
        parts: list[np.ndarray] = []
        names: list = []

        def segment() -> pa.RecordBatch:
            image = encode_segment(np.concatenate([x for p in parts for x in (p, end)]), [len(p) + 1 for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([place], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([names], pa.list_(id_arrow)), pa.array([image], pa.binary())],
                names=["shard", "place", "n_ids", "doc_ids", "image"])

        for batch in batches:
            id_arrow = batch.column(0).type
            if batch.num_rows:
                shard = batch.column(2)[0].as_py()
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.many(batch.column(1).to_pylist()), strict=True):
                parts.append(ids)
                names.append(doc_id)
                size += len(ids) + 1
                if size >= segment_ids:
                    yield segment()
                    place, size, parts, names = place + size, 0, [], []
        if parts:
            yield segment()

    ordered.mapInArrow(run, f"shard int, place long, n_ids long, doc_ids array<{id_type}>, image binary").write.parquet(path)


def read_blocks(spark, path: str, checksum: bool = True) -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens and the
    ids (or, with ``checksum``, only their CRC-32)."""
    common.prepare(spark)
    files = spark.read.parquet(path)
    # One row a shard (a write task): its offset in the whole sequence.
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    offsets = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("offset"))
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()
    last = "ids_crc32 long" if checksum else "ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, places, names, images = (batch.column(i) for i in range(4))
            for r in range(batch.num_rows):
                ids, lengths = decode_segment(images[r].as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                cut = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                values = pa.array([zlib.crc32(c) for c in cut], pa.int64()) if checksum else pa.array([bytes(c) for c in cut], pa.binary())
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shards[r].as_py()] * n, pa.int32()), names[r].values,
                     pa.array(ends - lengths + places[r].as_py(), pa.int64()), pa.array(lengths, pa.int64()), values],
                    names=["shard", "doc_id", "start", "n_tokens", "value"])

    docs = (files.select("shard", "place", "doc_ids", "image")
            .mapInArrow(run, f"shard int, doc_id {id_type}, start long, n_tokens long, value {last.split()[1]}"))
    return docs.join(offsets, "shard").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens",
                                              F.col("value").alias(last.split()[0]))
