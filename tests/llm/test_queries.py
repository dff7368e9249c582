"""The registered queries over the whole small tables: against their SQL, or brute force where SQL can't express them."""

from __future__ import annotations

import base64
import hashlib
import os
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer, models

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from oracle_check import digest  # noqa: E402

from tidewater.llm import fingerprints as fp  # noqa: E402
from tidewater.llm import registry  # noqa: E402
from tidewater.llm.q_chat import HOSTILE  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations")


@pytest.fixture(scope="module")
def rows(spark):
    """Rows of a query, as dictionaries."""
    made = {}

    def of(name):
        if name not in made:
            made[name] = [r.asDict() for r in registry.queries()[name](spark, SF).collect()]
        return made[name]

    return of


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_every_operator_has_one_query():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    cur = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, cur.fetchall())


def test_op2(rows, documents):
    got = rows("op2_language_id")
    assert {r["doc_id"] for r in got} == set(documents) and len(got) == len(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == documents[r["doc_id"]].lang for r in held) >= 0.95 * len(held)


def test_op4(rows, documents):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocab = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i)]
    library, pieces = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False)), {p for p, _ in vocab}
    got = {r["doc_id"]: r["n_tokens"] for r in rows("op4_token_counts")}
    for doc, n in got.items():
        tokens = library.encode("▁" + documents[doc].text.replace(" ", "▁")).tokens
        assert n == sum(1 if t in pieces else len(t.encode()) for t in tokens)
    assert len(got) == len(documents)


def test_op5(rows, documents):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows("op5_byte_bpe")
    assert {r["doc_id"] for r in got} == set(documents) and len(got) == len(documents)
    for r in got:
        ids = library.encode_ordinary(documents[r["doc_id"]].text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(documents[r["doc_id"]].text.encode()).hexdigest()


def test_op6(rows, spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], dtype=float)
    got = {}
    for r in rows("op6_nearest_neighbours"):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    queries = np.flatnonzero(ids % 20 == 0)
    assert set(got) == set(ids[queries].tolist()) and all(len(v) == 20 for v in got.values())
    hits = 0
    for q in queries:
        order = np.lexsort((ids, -(x @ x[q])))
        hits += len({int(ids[i]) for i in order if i != q} & set(got[ids[q]]) & {int(ids[i]) for i in order[order != q][:20]})
    assert hits / (20 * len(queries)) >= 0.9


def test_op7(rows, spark):
    by = {-1: [(0, "user", HOSTILE), (1, "assistant", HOSTILE)]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r["conv_id"]: r for r in rows("op7_chat_format")}
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        r, loss = got[conv], "".join(t for _, role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] > sum(len(t) for *_, t in turns)


def test_op9(rows, documents):
    got = {r["doc_id"]: r for r in rows("op9_fingerprints")}
    order = sorted(documents, reverse=True)
    assert sorted(got, reverse=True) == order
    for doc, after in zip(order, order[1:] + order[:1], strict=True):
        text, r = documents[doc].text, got[doc]
        edited = text[: len(text) - len(text) // 3] + documents[after].text[: len(text) // 3]
        p, q = fp.fingerprints([text, edited])
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), p, q)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == fp.likeness(p, q) and r["near_next"] == fp.likeness(p, got[after]["fingerprint"])
    long = [r for r in got.values() if r["n_chars"] > 1000]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5 > 0.2 > sum(r["near_next"] for r in long) / len(long)


def test_op10(rows, documents):
    got = rows("op10_shards")
    assert {r["doc_id"] for r in got} == set(documents) and len(got) == len(documents)
    shards: dict = {}
    for r in got:
        text = documents[r["doc_id"]].text.encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "rows", None)
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(shards) == list(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_op12(rows, spark):
    from test_repair import COLUMNS, by_conversation, damaged, expect

    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = by_conversation(damaged(given))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows("op12_conversation_repair")}
    assert set(got) == {r[0] for r in given}
    assert all(found == expect(after.get(conv, [])) for conv, found in got.items())


def test_op13(rows, documents):
    from test_alignment import COLUMNS, expected

    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows("op13_tokenizer_alignment")}
    assert len(got) == len(documents)
    want = expected([documents[d].text for d in documents])
    assert all(got[d] == w for d, w in zip(documents, want, strict=True))
