"""Byte-level BPE: against the tokenizer library, with many chunk borders, and round trips."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewater.llm.bpe import decode, encode
from tidewater.llm.q_bpe import PRODUCTION_BPE


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts() -> list[str | None]:
    rnd = random.Random(7)
    alphabet = "ab 'relvm\n\t  1é日𝒳!-"
    texts: list[str | None] = [None, "", " ", "a", "<|endoftext|> it's", "x" * 700, " " * 300 + "a", "'ll've're" * 60]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    return texts + texts[-5:]  # repeated rows


@pytest.mark.parametrize(("chunk", "overlap"), [(16, 8), (50, 20), (100_000, 64)])
def test_ids_match_the_library_and_round_trip(spark, library, chunk, overlap):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "kept", 1) for i, t in enumerate(texts)], "doc_id long, text string, k string, token_ids int")
    rows = decode(encode(docs, PRODUCTION_BPE, chunk, overlap), PRODUCTION_BPE).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.token_ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
        assert r.k == "kept"


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(docs, PRODUCTION_BPE), PRODUCTION_BPE).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert encode(docs, PRODUCTION_BPE, 2, 1).agg(F.count(F.lit(1))).first()[0] == 2
