"""Byte-level BPE against the tiktoken library and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def other():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def _texts():
    rng = random.Random(2)
    chars = [chr(rng.randrange(1, 0x2FFF)) for _ in range(200)] + list("   \t\n\x0b\x0c\r\x1c\x85\xa0 　'sll 12ab<|endoftext|>😀")
    texts = ["".join(rng.choices(chars, k=rng.randrange(0, 90))) for _ in range(1500)]
    return texts + ["", " ", "  ", " a", "a ", "a  b", "a \nb", "\n a", "it's we'll", "<|endoftext|>", "a" * 4000, " " * 2000, "日本語" * 300]


@pytest.mark.parametrize("lone_space_starts", [True, False])
def test_ids_equal_tiktoken(other, lone_space_starts):
    codec = byte_bpe.Codec(PATH, PATTERN, lone_space_starts)
    texts = _texts()
    decoder = byte_bpe.Decoder(PATH)
    for t, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(t)
        assert decoder.decode(ids) == t.encode()


def test_every_byte_has_a_character():
    assert len({byte_bpe.to_chars(bytes([b])) for b in range(256)}) == 256


def test_cache_generations_do_not_change_ids(other, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 5)
    codec = byte_bpe.Codec(PATH, PATTERN, True)
    for t in _texts()[:200]:
        assert np.frombuffer(codec.encode_all([t, t])[1], "<u4").tolist() == other.encode_ordinary(t)


def test_rows_nulls_repeats_and_clashing_columns(spark, other):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, "né", "y"), (2, None, "z"), (3, "", "z"), (4, "ab " * 50_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = byte_bpe.encode(df, PATH, PATTERN)
    both = byte_bpe.decode(ids, PATH, carry=("doc_id", "ids")).withColumn("text", F.col("decoded").cast("string"))
    got = sorted(((r.doc_id, r.text, np.frombuffer(r.ids, "<u4").tolist()) for r in both.collect()), key=str)
    assert got == sorted(((i, t or "", other.encode_ordinary(t or "")) for i, t, _ in rows), key=str)
    assert byte_bpe.encode(df.limit(0), PATH, PATTERN).collect() == []
