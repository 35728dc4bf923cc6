"""Byte-level BPE: segments against the library on whole texts, ids back to bytes, odd rows."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from keepwell.llm import bpe, queries
from keepwell.llm.tokens import public

VOCAB = public("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(VOCAB, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


SMALL = bpe.Bpe(VOCAB, segment=4)
ALPHABET = "ab'sreZ09 \t\n\r\x1c\x85\xa0　.,-’。漢字語かなéß́👍🏽<|>"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_segments_change_no_id(plain, text):
    assert "".join(bpe.segments(text, 3)) == text
    assert SMALL.encode(text).tolist() == plain.encode_ordinary(text)
    assert SMALL.decode(SMALL.encode(text)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text_comes_back(plain, text):
    text = text.encode("utf-8", "replace").decode()
    assert SMALL.encode(text).tolist() == plain.encode_ordinary(text)
    assert SMALL.decode(SMALL.encode(text)) == text.encode()


def test_long_stretches_without_a_safe_place(plain):
    whole = bpe.loaded(VOCAB)
    for text in ("a" * 300_000, "好" * 200_000, "x " + " " * 250_000 + "y", "\n" * 200_000 + "z", "'s" * 150_000, "-" * 200_000):
        assert whole.encode(text).tolist() == plain.encode_ordinary(text), text[:3]
    blanks = "a" + " " * 2_000_000 + "b"  # the library's own splitter ends on this one
    assert whole.decode(whole.encode(blanks)) == blanks.encode()


def test_rows(spark, plain):
    texts = [(1, "Hello <|endoftext|> world", 5), (2, None, None), (3, "", 1), (None, "naïve 漢字 👍", 2), (1, "Hello <|endoftext|> world", 7),
             (4, "word " * 60_000 + "好" * 90_000, 0)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, n_tokens int")
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert len(rows) == 6
    want = sorted(((i, t or "") for i, t, _ in texts), key=str)
    got = sorted(((r["doc_id"], bytes(r["data"]).decode()) for r in rows), key=str)
    assert got == want
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids == plain.encode_ordinary(bytes(r["data"]).decode()) and r["n_tokens"] == len(ids)
    assert bpe.decode(bpe.encode(docs.limit(0))).collect() == []
    with pytest.raises(ValueError, match="named like a result"):
        bpe.encode(docs, id_col="n_tokens")
    with pytest.raises(ValueError, match="already"):
        bpe.decode(bpe.encode(docs), data_col="IDS")


def test_broken_utf8_and_ids(spark):
    from pyspark.sql import functions as F

    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(x'61ff62' as string)").alias("text"))
    assert bytes(bpe.decode(bpe.encode(docs)).first()["data"]).decode() == "a�b"
    for raw in (b"\1\0\0", b"\xff\xff\xff\x7f"):
        bad = spark.createDataFrame([(bytearray(raw),)], "ids binary")
        with pytest.raises(Exception, match="4 bytes each|[Ii]nvalid token|KeyError|2147483647"):
            bpe.decode(bad).collect()


def test_query_against_the_library(spark, plain):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op13_byte_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(plain.encode_ordinary(d["text"] or ""), dtype="<u4")
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
