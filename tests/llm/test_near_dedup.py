"""Near-duplicates: against all pairs on fixtures with hubs, chains and copies; parts; odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewater.llm import near_dedup as nd

SCHEMA = "doc_id long, text string, kept string"


def plain(rows):
    """(n_shingles, component) of each row, by all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows))


def _rows():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    texts = []
    for group in range(6):  # copies around a hub, many not linked to each other
        base = [word() for _ in range(60 + 40 * group)]
        texts.append(" ".join(base))
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, 8)):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(200)]
    for _ in range(12):  # each linked to the next only
        texts.append("\n".join(chain))
        chain = chain[12:] + [word() for _ in range(12)]
    texts += ["one two", "ONE\ttwo ", "one two three", "", " \n", "a b c d e", "a b c d e f", "É x y z w", "é x y z w"]
    texts += [" ".join([word() for _ in range(80)]) for _ in range(40)] + texts[:8]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("parts", [None, (6, 300)])
def test_components_match_all_pairs(spark, monkeypatch, parts):
    if parts:
        monkeypatch.setattr(nd, "BUCKET_ROWS", parts[0])
        monkeypatch.setattr(nd, "GROUP_SHINGLES", parts[1])
    rows = _rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = nd.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (1, None), (2, ""), (7, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (8, "x " * 30_000), (9, "X\u000bx")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect()}
    assert got == {(None, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (7, 2, 5, False), (5, 2, 5, True), (8, 1, 8, True), (9, 1, 9, True)}
    assert nd.near_duplicates(docs.limit(0)).collect() == []


def test_connected_over_long_chains(spark):
    ids = list(range(300))
    random.Random(3).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    assert {(r.node, r.label) for r in nd.connected(links).collect()} == {(i, 0) for i in range(1, 300)}


def test_sketch_estimates_high_similarities():
    rng = np.random.default_rng(1)
    for j in (0.75, 0.85, 0.95):
        n = 2000
        common = int(n * 2 * j / (1 + j))
        sets = rng.integers(0, 1 << 62, 2 * n, dtype=np.uint64)
        a, b = np.unique(sets[:n]), np.unique(np.concatenate([sets[:common], sets[n : 2 * n - common]]))
        estimate = nd.sketch_estimate(*(nd.odd_sketch(nd.samples_of(x)) for x in (a, b)))
        assert abs(estimate - j) < 0.15
