"""Byte-level BPE against the reference implementation of its rank files."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemill.llm import byte_bpe
from tidemill.llm.common import text_bytes

VOCABULARY = public_tokenizers.path(byte_bpe.VOCABULARY)
PIECES = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", " ", "　", "!", "é", "漢", "7", "²", "x",
          "'s", "\U0001f600", "\x1c", "'re", "\x85", "_", "'ve been", "don't", " '", "''", "<|endoftext|>"]


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.load_tokens(VOCABULARY)


@pytest.fixture(scope="module")
def other(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)})


def sample():
    draw = random.Random(5)
    mixed = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    return [*mixed, "", "a" * 3000, " " * 500, "'" * 100, "ab" * 2000 + " x", "word " * 5000]


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_ids(tokens, other, monkeypatch, block):
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    monkeypatch.setattr(byte_bpe, "CACHED_WORDS", 500)
    encoder, texts = byte_bpe.Encoder(tokens), sample()
    for start in range(0, len(texts), 400):
        part = texts[start: start + 400]
        ids, places, number = encoder.encode(*text_bytes(pa.array(part, pa.string())))
        for i, text in enumerate(part):
            own = ids[number[i]: number[i + 1]].tolist()
            assert own == other.encode_ordinary(text)
            at = places[number[i]: number[i + 1]].tolist()
            assert [text.encode()[a:b] for a, b in zip(at, [*at[1:], None], strict=False)] == [tokens[x] for x in own]


def test_round_trip(spark, other):
    rows = [(i, t) for i, t in enumerate(sample()[:200])] + [(None, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x"))
    found = byte_bpe.decode(byte_bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in found) == sorted((str(i), t or "") for i, t in rows)
    assert all(list(r.ids) == other.encode_ordinary(bytes(r.decoded).decode()) for r in found)
    assert byte_bpe.encode(docs.limit(0), VOCABULARY).collect() == []


def test_lost_tokens_are_noticed(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    cut = byte_bpe.encode(docs, VOCABULARY).withColumns({c: F.slice(c, 2, 9) for c in ("ids", "places")})
    with pytest.raises(Exception, match="out of place"):
        byte_bpe.decode(cut, VOCABULARY).collect()


def test_query(spark, small, other):
    texts = dict(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    found = byte_bpe.op9_byte_bpe(spark, small).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = other.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
