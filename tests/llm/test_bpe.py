import hashlib

import numpy as np
import public_tokenizers
import pytest

from goldmart.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "word " * 30_000 + "ünïcode \U0001F600 tail\n\n  x's 12 345" + "a" * 5000
TEXTS = [None, "", " ", "hello world", "it's  we'll\t\n\n x", LONG, LONG, "\U0001F600" * 300, "\x1c\x1d a \x85 b c", "$$$%%% 1234567 don't"]


ENCODER = bpe.encoding(RANKS, public_tokenizers.PATTERN)


def whole(text):
    return ENCODER.encode_ordinary(text or "")


def test_ids_and_bytes_equal_the_plain_library(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = bpe.encode(df, RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = np.frombuffer(row["ids"], dtype="<u4").tolist()
        assert ids == whole(row["text"]) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_pieces_give_the_ids_of_the_whole_text(size):
    for text in TEXTS[1:]:
        parts = list(bpe.pieces(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in whole(p)] == whole(text)


def test_decode_keeps_raw_bytes(spark):
    ids = np.array(whole("é")[:1], dtype="<u4").tobytes()  # half of a character
    df = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "k int, ids binary")
    out = {r["k"]: bytes(r["decoded"]) for r in bpe.decode(df, RANKS, public_tokenizers.PATTERN).collect()}
    assert out[1] == ENCODER.decode_bytes(whole("é")[:1]) and out[2] == b""


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", 9, "keep")], "doc_id long, text string, N_Tokens int, Ids_ string")
    out = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "Ids_", "n_tokens", "ids"]
    assert out.first()["n_tokens"] == 2
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_registered_query_on_whole_small_table(spark):
    from goldmart.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op10_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(whole(docs[r["doc_id"]]), dtype="<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
