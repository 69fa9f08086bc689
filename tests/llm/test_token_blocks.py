import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twinsift.llm import common, queries
from twinsift.llm import token_blocks as B

TOK = queries.word_tokenizer()
DOC = "doc_id long, text string"


@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=700))
@settings(max_examples=150, deadline=None)
def test_segment_round_trip(ids):
    a = np.array(ids, np.uint32)
    image = B.encode_segment(a, [len(a)])
    out, lengths = B.decode_segment(image)
    assert (out == a).all() and lengths.tolist() == [len(a)]
    for k in range(-(-len(a) // B.BLOCK)):
        assert (B.read_block(image, k) == a[k * B.BLOCK:(k + 1) * B.BLOCK]).all()


def test_outliers_do_not_widen_a_block():
    a = np.arange(B.BLOCK, dtype=np.uint32) % 8
    b = a.copy()
    b[5] = 2**31
    assert len(B.encode_segment(b, [B.BLOCK])) == len(B.encode_segment(a, [B.BLOCK])) + 5


TEXTS = ["", "Hello, World! it's 2024", "a\tb\x0bc\x1cd\n\ne", "İstanbul ΣΑΣ", "x<|endoftext|>y <|ENDOFTEXT|>", "J̌ é Ǆ ŉ ſ ß ẞ",
         "日本語 テキスト", "DON'T you'll we've 1½ a_b", "\u0085   Å K", "É" * 50 + " " + "word " * 300]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_library(text):
    t = Tokenizer.from_file(TOK)
    assert np.frombuffer(B.encoder(TOK, "<u4").ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_of_latin_texts(text):
    t = B.encoder(TOK, "<u4")
    assert np.frombuffer(t.ids(text), "<u4").tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids


def brute(rows):
    t, out, start = Tokenizer.from_file(TOK), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, frame):
    rows = [(9 - i if i % 4 else 20 + i, t) for i, t in enumerate(TEXTS)] + [(77, None), (None, "no id"), (50, "twice"), (50, "twice")]
    path = common.shared_folder(spark, "t")
    B.write_blocks(frame(rows, DOC).repartition(3), path, TOK, segment_ids=16)
    got = [tuple(r) for r in B.read_blocks(spark, path).orderBy("start").collect()]
    assert got == brute(rows)
    ids = {r["start"]: r["ids"] for r in B.read_blocks(spark, path, checksum=False).collect()}
    assert all(zlib.crc32(ids[s]) == c for _, s, _, c in got)


def test_empty(spark, frame):
    path = common.shared_folder(spark, "t")
    B.write_blocks(frame([], DOC), path, TOK)
    assert B.read_blocks(spark, path).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in queries.op3_token_blocks(spark, sf).orderBy("doc_id").collect()] == brute(rows)
