"""License scans: against containment of every block by brute force, plan, odd rows."""

from __future__ import annotations

import contextlib
import io
import math
import random
import re
import time

from tidewater.llm.licenses import BASE_TEMPLATES, PRODUCTION_TEMPLATES, Template, scan_licenses

SCHEMA = "doc_id long, text string, labels string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, templates, threshold):
    words = WORD.findall((text or "").translate(LOWER))
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        seq, m = t.words, len(t.words)
        if t.phrase:
            at = [p for p in range(len(words) - m + 1) if words[p : p + m] == seq]
            places += at
            if at:
                base.add(t.label)
                labels.add(t.label)
                score = 1.0
            continue
        need = math.ceil(threshold * len(set(seq)) - 1e-9)
        for b in range(0, max(1, math.ceil(len(words) / m))):
            shared = len(set(seq) & set(words[b * m : b * m + 2 * m]))
            if shared >= need:
                labels.add(t.label)
                score = max(score, shared / len(set(seq)))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def _texts():
    rnd = random.Random(4)
    vocabulary = sorted({w for t in PRODUCTION_TEMPLATES for w in t.words}) + ["x", "é", "K", "İ", "ſ"]
    texts = [None, "", " \x00 ", "MIT LICENSE", "mit-license: Mit License!", "mit\nlicense cc by", "Kelvin mit licensé", "cc by " * 400]
    for _ in range(150):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            t = list(rnd.choice(PRODUCTION_TEMPLATES).words)
            if rnd.random() < 0.5:
                t[rnd.randrange(len(t))] = "other"
            at = rnd.randint(0, len(words))
            words[at:at] = t
        texts.append(rnd.choice([" ", ", ", "\n", "_"]).join(w.upper() if rnd.random() < 0.2 and w.isascii() else w for w in words))
    return texts + texts[-3:]


def test_matches_brute_force(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    for templates, threshold in ((PRODUCTION_TEMPLATES, 0.9), (PRODUCTION_TEMPLATES, 0.6), (BASE_TEMPLATES + (Template("t", "a b b c"),), 1.0)):
        rows = scan_licenses(docs, templates, threshold).collect()
        assert len(rows) == len(texts)
        for r in rows:
            want = brute(texts[r.doc_id], templates, threshold)
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == want, texts[r.doc_id]


def test_only_built_in_functions_and_no_shuffle_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        scan_licenses(docs).explain()
    plan = buf.getvalue()
    assert not re.search("Python|Pandas|InArrow|NestedLoop|Cartesian", plan)
    assert "Exchange" not in plan.split("Subquery")[0]


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "mit license", None)] * 2, SCHEMA)
    assert [r.base_labels for r in scan_licenses(docs).collect()] == ["mit", "mit"]
    assert scan_licenses(docs.limit(0)).collect() == []


def test_long_texts_of_hits_take_linear_work(spark):
    def seconds(words):
        docs = spark.createDataFrame([(1, "mit license " * (words // 2))], "doc_id long, text string")
        start = time.perf_counter()
        row = scan_licenses(docs).drop("license_blocks", "text").collect()[0]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (words, words // 2, 0, words - 2)
        return time.perf_counter() - start

    seconds(4000)
    few, many = seconds(4000), seconds(180_000)  # a text of 1 MB
    assert many < few + 45, (few, many)
