"""Alignment: against plain loops over bytes, parts of long texts, products, odd rows."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewater.llm import alignment as al
from tidewater.llm.q_alignment import PRODUCTION_FILES as FILES

SCHEMA = "doc_id long, text string, b_ids string"


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(FILES.bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES.pieces_path)
        self.vocab = {i: t for t, i in json.load(open(FILES.bytes_path))["model"]["vocab"].items()}

    def tokens(self, text):
        if not text:
            return None
        from tokenizers.pre_tokenizers import ByteLevel

        want = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        shown = "".join(p for p, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" " + text))
        if shown != "".join(self.vocab[i] for i in a):
            return None
        a = [(i, len(self.vocab[i])) for i in a]  # one character a byte
        b, joined = [], b""
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            data = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            b.append((i, len(data)))
            joined += data
        return (a, b) if joined == want else None

    def document(self, text):
        found = self.tokens(text)
        if not found:
            return 0, 0, 0, Counter(), ""
        owner = [[k for k, (_, n) in enumerate(t) for _ in range(n)] for t in found]
        links = sorted(set(zip(*owner, strict=True)))
        a, b = found
        groups, i, j = [], 0, 0
        ends = [[sum(n for _, n in t[: k + 1]) for k in range(len(t))] for t in found]
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(str(x) for x, _ in a[i:p]) + "|" + ",".join(str(x) for x, _ in b[j:q]))
            i, j = p, q
        pairs = Counter((a[x][0], b[y][0]) for x, y in links)
        return len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(texts):
    plain = Plain()
    docs = [plain.document(t) for t in texts]
    held = Counter(p for d in docs for p in d[3])
    most: dict = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    return [
        (na, nb, ng, sum(pairs.values()), sum(m for p, m in pairs.items() if held[p] == most[p[0]]), sum(m * held[p] for p, m in pairs.items()), digest)
        for na, nb, ng, pairs, digest in docs
    ]


def _texts():
    rnd = random.Random(9)
    words = ["the", "of", "Entschädigung", "naïve", "  ", "\n", "\t", "12345", "<|endoftext|>", "<s>", "▁", "日本語", "🙂", "don't", "x" * 40, "...", " ", "é", "<0x41>", "ﬁ"]
    texts = [None, "", " ", "  ", "a", " a", "a ", "▁", "\x00", "<unk>"]
    texts += ["".join(rnd.choice(words) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, 40))) for _ in range(120)]
    return texts + texts[-5:]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("links", [1, 500, 1 << 17])
def test_matches_plain_loops(spark, monkeypatch, links):
    monkeypatch.setattr(al, "CHUNK_LINKS", links)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in al.link_strengths(docs, FILES).collect()}
    want = expected(texts)
    assert len(got) == len(texts) and sum(w[0] > 0 for w in want) > 40
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]


def test_parts_of_long_texts(monkeypatch):
    texts = [t for t in _texts() if t] + [" ".join(["word"] * 500), "y" * 900, "a b" * 300, "a  b \n c" * 200]
    c = al.codec(FILES)
    whole = list(al.align_texts(texts, c))
    monkeypatch.setattr(al, "PART_CHARS", 7)
    monkeypatch.setattr(al, "SLICE_CHARS", 50)
    assert max(len(c.parts(t)) for t in texts) > 50
    for t, x, y in zip(texts, whole, al.align_texts(texts, c), strict=True):
        for name in al._ALIGN_COLUMNS.values():
            assert getattr(x, name).tolist() == getattr(y, name).tolist(), (t, name)


def test_ranks_encode_as_the_library_does():
    c = al.Codec(FILES)
    assert c.fast is not None
    parts = [t for t in _texts() if t] + ["x" * 5000, "ab" * 3000, " \n\t " * 300, "it's 'll 've 1²3", "\ud7ff\ue000"]
    by_ranks, c.fast = c.encode(parts), None
    assert by_ranks == c.encode(parts)
    described = json.load(open(FILES.bytes_path))
    described["model"]["merges"].reverse()
    assert al.ranked_encoding(described, c.a_bytes) is None


def test_products_against_dense_matrices():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, m, k = rng.integers(1, 9, 3)
        p, q = rng.random((n, m)) < 0.4, rng.random((m, k)) < 0.4
        csr = lambda d: al.Csr(np.concatenate([[0], np.cumsum(d.sum(1))]), np.nonzero(d)[1], d.shape[1])
        links, values = al.product(csr(p), csr(q))
        dense = np.zeros((n, k), int)
        dense[links.row_numbers(), links.col] = values
        assert (dense == p.astype(int) @ q.astype(int)).all() and (values > 0).all()
        back = csr(p).transposed()
        assert back.n_rows == m and sorted(zip(back.col, back.row_numbers(), strict=True)) == sorted(zip(*np.nonzero(p), strict=True))


def test_shared_group_links():
    links = al.shared_group_links(np.array([1, 3]), np.array([2, 3]))
    assert list(zip(links.row_numbers().tolist(), links.col.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (2, 2)]


def test_align_keeps_columns_and_defined_cases(spark):
    docs = spark.createDataFrame([(1, "the naïve end", "old"), (1, "the naïve end", "old"), (None, None, None), (2, "", None)], SCHEMA)
    rows = al.align(docs.withColumn("n", docs["doc_id"]), FILES).collect()
    assert [r.n for r in rows] == [r.doc_id for r in rows] and len(rows) == 4
    for r in rows:
        if r.text:
            assert r.link_ptr[-1] == len(r.link_b) == len(r.link_bytes) and sum(r.link_bytes) == len(" the naïve end".encode())
            assert (r.group_a[-1], r.group_b[-1]) == (len(r.a_ids), len(r.b_ids))
        else:
            assert (r.a_ids, r.b_ids, r.link_ptr, r.group_a) == ([], [], [0], [])
    got = al.link_strengths(docs, FILES, keep=("doc_id", "b_ids")).collect()
    assert sorted((r.doc_id or 0, r.b_ids or "", r.count_sum == 2 * r.n_links) for r in got) == [(0, "", True), (1, "old", True), (1, "old", True), (2, "", True)]
    assert al.link_strengths(docs.limit(0), FILES).collect() == []
    assert al.link_strengths(docs.filter("text is null or text = ''"), FILES).count() == 2
