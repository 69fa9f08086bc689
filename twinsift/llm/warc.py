"""WARC archives: writing with segmentation, reading with reassembly.

Writing: one record a page. A payload of at least ``MIN_REVISIT`` bytes that
equals that of a larger id is a ``revisit`` of it (WARC-Refers-To, the HTTP
head of the full response, no body); every other page is a ``response`` whose
HTTP body has chunked transfer coding. A block over ``SEGMENT`` bytes is cut:
the first record has WARC-Segment-Number 1, ``continuation`` records carry
WARC-Segment-Origin-ID and the next numbers, and the last one
WARC-Segment-Total-Length. Chunks and segments end between code points, so
archives are UTF-8 and go through Spark's committed text writer whose line
separator is the end of a record (CR LF CR LF); any store works and a lost
task writes again. Files hold at most ``FILE_RECORDS`` records, so their size
has a bound.

Reading: files are read whole and parsed by Content-Length; continuation
records (only they and their first records) are grouped by origin id, ordered
by segment number, checked against the total length and for gaps; then the
HTTP head is cut off, the chunk framing decoded, and the payload checked
against WARC-Payload-Digest. A broken record raises.

Defined cases: a null payload is empty; a null id is smaller than any id and
written as an empty ``WARC-X-Id``; repeated rows of the response's id are
responses as well; an empty table gives no archive records; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.llm import common

MIN_REVISIT = 1000
CHUNK = 8 << 10
SEGMENT = 32 << 10
COPIES = 256
FILE_RECORDS = 1500
END = "\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"


# ------------------------------------------------------------------ framing
def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most ``size`` (over 3) bytes that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + n])
        if len(out[-1]) != n or body[end + 2 + n:end + 4 + n] != b"\r\n":
            raise ValueError("broken chunk")
        at = end + 4 + n


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return head.encode() + b"\r\n" + block


def record_id(page_id, digest: str) -> str:
    """Repeated rows of a page share it, different payloads of an id don't."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def records_of(page_id, url: str | None, text: str, digest: str, refers_to, chunk: int = CHUNK,
               segment: int = SEGMENT) -> list[bytes]:
    """The records of a page, without their ends."""
    payload, uid = text.encode(), record_id(page_id, digest)
    url = re.sub(r"\s", "%20", url or "urn:unknown")
    common_fields = [("WARC-Target-URI", url), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
                     ("WARC-X-Id", "" if page_id is None else page_id)]
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    if refers_to is not None:
        block = b"\r\n".join([*head, b"Content-Length: %d" % len(payload)]) + b"\r\n\r\n"
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", uid), *common_fields,
                         ("WARC-Refers-To", record_id(refers_to, digest)), ("Content-Type", "application/http; msgtype=response"),
                         ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")], block)]
    block = b"\r\n".join([*head, b"Transfer-Encoding: chunked"]) + b"\r\n\r\n" + chunked(payload, chunk)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", uid), *common_fields,
             ("Content-Type", "application/http; msgtype=response")]
    parts = list(_cuts(block, segment))
    if len(parts) == 1:
        return [_record(first, block)]
    out = [_record([*first, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{uid[:-1]}:{k}>"),
                            ("WARC-Target-URI", url), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", uid),
                            ("WARC-Segment-Number", k), *last], part))
    return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record of a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(fields["content-length"])
        block = data[end + 4:end + 4 + n]
        if len(block) != n or data[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
            raise ValueError("broken WARC record")
        yield fields, block
        at = end + 8 + n


def reassembled(parts: list[tuple[int, bytes, int | None]]) -> bytes:
    """The block of (segment number, block, total length or None) rows."""
    parts = sorted(parts, key=lambda p: p[0])
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1][2] is None:
        raise ValueError("a WARC segment is missing")
    block = b"".join(p[1] for p in parts)
    if len(block) != parts[-1][2]:
        raise ValueError("WARC segments do not have the total length")
    return block


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    return fields, unchunked(body) if fields.get("transfer-encoding") == "chunked" else body


# ------------------------------------------------------------------ writing
def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, refers_to. The thin (digest, id) rows
    give the responses; only payloads that occur again join back."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    big = p.where(F.octet_length("payload") >= min_bytes)
    seen = big.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = common.stored(seen, "warc-repeats")
    hot = [r[0] for r in seen.orderBy(F.desc("n")).limit(256).select("digest").collect()]
    out = common.salted_join(p, seen.drop("n"), "digest", hot, "page_id")
    other = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return out.withColumn("refers_to", F.when(other, F.col("response_id"))).drop("response_id")


def write_archives(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the output of ``with_revisits`` as ``.txt.gz`` WARC files."""
    common.prepare(pages.sparkSession)
    rows = pages.select("page_id", "url", "payload", "digest", "refers_to")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[str] = []
        size = 0
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for r in records_of(*row):
                out.append(r.decode())
                size += len(r)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    (common.map_batches(rows, run, "value string").write.option("lineSep", END).option("compression", compression)
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


# ------------------------------------------------------------------ reading
def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a WARC record of the archives under ``path``."""
    common.prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        names = ["rec_id", "rec_type", "x_id", "refers_to", "digest", "origin", "segment", "total", "block"]
        types = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows, size = [], 0
                for f, block in parse(data):
                    number = f.get("warc-segment-number")
                    total = f.get("warc-segment-total-length")
                    rows.append((f["warc-record-id"], f["warc-type"], f.get("warc-x-id") or None, f.get("warc-refers-to"),
                                 (f.get("warc-payload-digest") or "").removeprefix("sha1:"),
                                 f.get("warc-segment-origin-id") or (f["warc-record-id"] if number else None),
                                 int(number) if number else None, int(total) if total else None, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return files.mapInArrow(run, "rec_id string, rec_type string, x_id string, refers_to string, digest string, "
                                 "origin string, segment int, total long, block binary")


_PAGE = "x_id string, rec_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def referred_id(column: str) -> F.Column:
    """The page id inside a record id."""
    return F.regexp_extract(column, "^<urn:x-page:(.*):[0-9a-f]+>$", 1)


def read_pages(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a page from the archives: x_id, rec_type, refers_to,
    payload_bytes, payload_digest and (for responses) the payload. Only
    segmented records are shuffled: one block a segment of each origin."""
    records = read_records(spark, path)

    def page(kind: str, x_id, refers_to, digest: str, block: bytes) -> tuple:
        fields, payload = http_payload(block)
        if kind == "revisit":
            return x_id, kind, refers_to, int(fields["content-length"]), digest, None
        found = hashlib.sha1(payload).hexdigest()
        if found != digest:
            raise ValueError(f"payload digest of {x_id} differs")
        return x_id, kind, refers_to, len(payload), found, payload if payloads else None

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [page(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        types = [pa.string()] * 3 + [pa.int64(), pa.string(), pa.binary()]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          names=[x.split()[0] for x in _PAGE.split(", ")])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[pdf["rec_type"] != "continuation"]
        if not len(first):
            raise ValueError("segments without their first record")
        parts = [(int(n), bytes(b), None if pd.isna(t) else int(t)) for n, b, t in zip(pdf["segment"], pdf["block"], pdf["total"], strict=True)]
        f = first.iloc[0]
        row = page(f["rec_type"], f["x_id"], f["refers_to"], f["digest"], reassembled(parts))
        return pd.DataFrame([(*row, f["copies"])], columns=[*(x.split()[0] for x in _PAGE.split(", ")), "copies"])

    cols = ["rec_type", "x_id", "refers_to", "digest", "block"]
    single = common.map_batches(records.where("segment is null").select(*cols), whole, _PAGE)
    # Repeated rows of a page wrote equal segments: one set of them is grouped
    # for COPIES rows, counted before the shuffle, and the page repeated after.
    segments = (records.where("segment is not null").groupBy("origin", "segment")
                .agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("total"), *[F.min(c).alias(c) for c in cols]))
    sets = segments.withColumn("set", F.explode(F.expr(f"sequence(0, (n - 1) div {COPIES})")))
    sets = sets.withColumn("copies", F.least(F.lit(COPIES), F.col("n") - F.col("set") * COPIES)).drop("n")
    cut = sets.groupBy("origin", "set").applyInPandas(join, f"{_PAGE}, copies long")
    cut = cut.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_", "copies")
    return single.unionByName(cut)
