import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinsift.llm import common, queries, warc

PAGE = "page_id long, url string, html string"


@given(st.text(max_size=200), st.integers(4, 50))
@settings(max_examples=200, deadline=None)
def test_chunks(text, size):
    data = text.encode("utf-8", "replace")
    assert warc.unchunked(warc.chunked(data, size)) == data


@given(st.text(alphabet="aé漢\r\n0", max_size=400), st.integers(8, 200))
@settings(max_examples=100, deadline=None)
def test_segments(text, segment):
    digest = hashlib.sha1(text.encode()).hexdigest()
    records = warc.records_of(1, "http://x/ y", text, digest, None, chunk=16, segment=segment)
    for r in records:
        r.decode()
    found = list(warc.parse(b"".join(r + b"\r\n\r\n" for r in records)))
    if len(found) == 1:
        block = found[0][1]
    else:
        parts = [(int(f["warc-segment-number"]), b, int(t) if (t := f.get("warc-segment-total-length")) else None) for f, b in found]
        block = warc.reassembled(parts[::-1])
        assert all(f["warc-segment-origin-id"] == found[0][0]["warc-record-id"] for f, _ in found[1:])
        with pytest.raises(ValueError):
            warc.reassembled(parts[:-1])
        with pytest.raises(ValueError):
            warc.reassembled([*parts[:-1], (parts[-1][0], parts[-1][1] + b"x", parts[-1][2])])
    assert warc.http_payload(block)[1].decode() == text


def brute(rows):
    best = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            best[b] = i if best.get(b) is None else max(best[b], i if i is not None else best[b])
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        other = len(b) >= 1000 and best[b] != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if other else "response", best[b] if other else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a", "x" * 1000), (2, None, "x" * 1000), (3, "b c", "x" * 999), (4, "u", "x" * 999), (5, "u", None), (6, "u", ""),
        (7, "u", "漢é\r\n\r\nWARC/1.0\r\n" * 9000), (8, "u", "漢é\r\n\r\nWARC/1.0\r\n" * 9000), (8, "u", "漢é\r\n\r\nWARC/1.0\r\n" * 9000),
        (9, "u", "y" * 5000), (9, "u", "z" * 200_000), (None, "u", "x" * 1000), (None, "u", "q" * 2000)]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives(spark, frame, compression):
    path = common.shared_folder(spark, "w")
    warc.write_archives(warc.with_revisits(frame(ROWS, PAGE)), path, compression)
    out = warc.read_pages(spark, path)
    got = out.select(F.col("x_id").cast("long"), "payload_bytes", "payload_digest", "rec_type",
                     warc.referred_id("refers_to").cast("long")).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    for r in out.where("rec_type = 'response'").collect():
        assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    # Each reference is the id of a record that is there.
    records = warc.read_records(spark, path)
    ids = {r["rec_id"] for r in records.where("rec_type = 'response'").collect()}
    assert {r["refers_to"] for r in records.where("rec_type = 'revisit'").collect()} <= ids


def test_empty(spark, frame):
    path = common.shared_folder(spark, "w")
    warc.write_archives(warc.with_revisits(frame([], PAGE)), path)
    assert warc.read_pages(spark, path).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in queries.op10_warc(spark, sf).collect()), key=str) == brute(rows)


def test_many_repeated_rows_of_a_long_page(spark, frame, scratch):
    """More copies than one group takes: every row comes back, and the groups
    hold one block a segment."""
    long = "".join(f"<p>{i}</p>" for i in range(6000))
    rows = [(5, "u", long)] * 600 + [(None, "u", long)] * 300 + [(6, "u", long + "x"), (7, "u", "short")]
    path = f"{scratch}/warc-copies"
    warc.write_archives(warc.with_revisits(frame(rows, PAGE).repartition(5)), path)
    out = warc.read_pages(spark, path)
    n = {(r["x_id"], r["rec_type"]): r["n"] for r in out.groupBy("x_id", "rec_type").agg(F.count("*").alias("n")).collect()}
    assert n == {("5", "response"): 600, (None, "revisit"): 300, ("6", "response"): 1, ("7", "response"): 1}
    assert {bytes(r["payload"]).decode() for r in out.where("rec_type = 'response'").select("payload").distinct().collect()} == {long, long + "x", "short"}
