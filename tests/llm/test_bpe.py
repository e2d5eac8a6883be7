"""Encoding equals the tiktoken library on whole texts, and decoding restores the bytes."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cohortloom.llm import bpe, registry

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    None, "", " ", "\n", "a", "It's we'll 'S", "<|endoftext|>", "naïve café\u0085x y", "\x00\x1c\x1d z",
    "日本語テキスト" * 300, "x" * 70_000, "word " * 30_000, "é1!" * 30_000, "don't  stop\t\n \n" * 9_000,
]


@pytest.mark.parametrize("text", [t for t in TEXTS if t], ids=lambda t: repr(t[:12]))
def test_long_texts_encode_as_one_piece(text):
    assert bpe.Codec(RANKS, PATTERN).encode(text) == PLAIN.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", " \t", "a", "٣"])
def test_endless_runs_do_not_overflow(unit):
    codec = bpe.Codec(RANKS, PATTERN)
    text = "so " + unit * 200_000 + "end"
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    # The pieces' path gives what the library gives where the library still can.
    short = "so " + unit * 900 + "end"
    pieces = [i for m in codec.pieces.finditer(short) for i in PLAIN._encode_single_piece(m.group())]
    assert pieces == PLAIN.encode_ordinary(short)


def test_query_digests(spark, tmp_path):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(1, "", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in registry.op1_byte_bpe(spark, str(tmp_path)).collect())
    wanted = []
    for i, text, _ in rows:
        ids = PLAIN.encode_ordinary(text or "")
        packed = np.array(ids, dtype="<u4").tobytes()
        plain = (text or "").encode()
        wanted.append((i, len(ids), *(hashlib.sha256(x).hexdigest() for x in (packed, plain))))
    assert got == sorted(wanted)


def test_other_columns_stay_and_bytes_need_not_be_text(spark):
    df = spark.createDataFrame([(1, "é", "kept", "old")], "k int, text string, `a b` string, ids string")
    coded = bpe.encode(df, RANKS, PATTERN)
    assert coded.columns == ["k", "a b", "ids"]
    half = next(r for t, r in RANKS.items() if t == b"\xc3")
    packed = spark.createDataFrame([(bytearray(np.array([half], dtype="<u4").tobytes()),), (None,)], "ids binary")
    assert [bytes(r.decoded) for r in bpe.decode(packed, RANKS, PATTERN).collect()] == [b"\xc3", b""]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.round_trip(df, RANKS, PATTERN)).collect() == []
