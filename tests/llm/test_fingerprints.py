"""Locally consistent parsing: windows, equal substrings, neighbours of every row, odd tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import fingerprints as fp


def _words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 9))) for _ in range(n))


def test_each_text_alone_and_windows(monkeypatch):
    rnd = random.Random(1)
    texts = ["", "a", "aaaa" * 500, "ab" * 300, _words(rnd, 400), _words(rnd, 3), "日本語" * 50, "", "x"]
    together = fp.fingerprints(texts)
    assert together == [fp.fingerprints([t])[0] for t in texts]
    monkeypatch.setattr(fp, "WINDOW", 100)
    assert fp.fingerprints(texts) == together


def test_equal_substrings_share_phrases_at_any_offset():
    rnd = random.Random(2)
    shared = _words(rnd, 300)
    names = []
    for before in ("", "x", "some other start ", _words(rnd, 40)):
        symbols = np.frombuffer((before + shared).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        text = np.zeros(len(symbols), dtype=np.int32)
        for _ in range(fp.FIRST_LEVEL):
            symbols, text = fp._level(symbols, text)
        names.append(set(symbols.tolist()))
    for other in names[1:]:
        assert len(names[0] & other) >= 0.9 * len(names[0])


MASK = (1 << 64) - 1


def plain_mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & MASK
    return x ^ (x >> 31)


def plain_level(symbols):
    """The phrases of one level, symbol by symbol."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    names = [s if n == 1 else plain_mix((s + n * 0xD6E8FEB86659FD93) & MASK) for s, n in runs]

    def toss(own, left):
        low = ((own ^ left) & -(own ^ left)).bit_length() - 1 if own != left else 0
        return 2 * low + ((own >> low) & 1)

    labels = list(names)
    for _ in range(4):
        labels = [0] + [toss(labels[i], labels[i - 1]) for i in range(1, len(labels))]
    starts = [0]
    for i in range(1, len(names)):
        if labels[i] > labels[i - 1] and (i == len(names) - 1 or labels[i] > labels[i + 1]):
            starts.append(i)
    out = []
    for a, b in zip(starts, [*starts[1:], len(names)], strict=True):
        power, total = 1, 0
        for k in range(a, b):
            power = (power * 0x9E3779B97F4A7C15) & MASK
            total += names[k] * power
        out.append(plain_mix(total & MASK))
    return out


def plain_fingerprint(text):
    if not text:
        return ""
    symbols, found = [ord(c) for c in text], set()
    for level in range(1, 7):
        symbols = plain_level(symbols)
        if level >= 2:
            found |= {s >> 32 for s in symbols}
    own = plain_mix(sum(plain_mix((s + k * 0x9E3779B97F4A7C15) & MASK) for k, s in enumerate(symbols)) & MASK)
    names = sorted(found)
    few = [n for n in names if n < (1 << 32) // 20]
    kept = few if len(few) > 40 else names[:40]
    return f"{own:016x}" + "".join(f"{n:08x}" for n in kept)


def test_fingerprints_match_a_plain_parse():
    rnd = random.Random(6)
    texts = ["", "a", "ab", "aaaa" * 50, "ab" * 90, "日本語🙂" * 30, *(_words(rnd, n) for n in (1, 2, 5, 30, 200, 1500))]
    assert fp.fingerprints(texts) == [plain_fingerprint(t) for t in texts]


def test_long_texts_that_differ_in_six_words():
    rnd = random.Random(8)
    for _ in range(20):
        words = _words(rnd, 36_000).split(" ")
        other = list(words)
        other[18_000:18_006] = _words(rnd, 6).split(" ")
        a, b, again = fp.fingerprints([" ".join(words), " ".join(other), " ".join(words)])
        assert a == again and a != b and 0.9 < fp.likeness(a, b) < 1


def test_a_passage_of_fifty_words_shows_in_long_texts():
    rnd, seen = random.Random(9), 0
    for _ in range(20):
        passage, before, after = _words(rnd, 50), _words(rnd, 3000), _words(rnd, 33_000)
        texts = [f"{_words(rnd, 20_000)} {passage} {_words(rnd, 16_000)}", f"{before} {passage} {after}", f"{before} {after}"]
        x, y, without = (set(fp.names_of(f)[0]) for f in fp.fingerprints(texts))
        seen += len(x & (y - without)) > 0
    assert seen >= 18


def test_likeness():
    rnd = random.Random(3)
    a, b = _words(rnd, 600), _words(rnd, 600)
    x, y, z = fp.fingerprints([a, b, fp.edit(a, b)])
    assert fp.likeness(x, x) == 1 and fp.likeness(x, y) < 0.1 and fp.likeness("", x) == 0
    assert 0.45 < fp.likeness(x, z) < 0.9


def test_neighbours_match_a_plain_walk(spark):
    rnd = random.Random(4)
    rows = [(i, _words(rnd, rnd.randint(0, 60))) for i in range(120)] + [(None, "no id"), (500, None), (501, ""), (502, "same"), (502, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = fp.edited_neighbours(docs).collect()
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t")).collect()
    plain = [(r.doc_id, r.t) for r in sorted(hashed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))]
    want = []
    for k, (i, t) in enumerate(plain):
        after = plain[(k + 1) % len(plain)][1]
        e = fp.edit(t, after)
        p, q, r = fp.fingerprints([t, e, after])
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), p, q, fp.likeness(p, q), fp.likeness(p, r)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[4])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "alone in the world")], "doc_id long, text string")
    (row,) = fp.edited_neighbours(docs).collect()
    assert row.near_next == 1.0 and row.n_chars == 18
    assert fp.edited_neighbours(docs.limit(0)).collect() == []
